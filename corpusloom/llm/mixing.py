"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 8), in built-in functions only.

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating. They
share all sizes by weight; a target stops at three times its source's size and
the excess is shared again, which is one water level found over the sorted
sources.

A source is taken in whole epochs first. What is left of its target is filled
with documents in the order of exponential keys -ln(u)/w, where u comes from the
id's digest, so reruns agree, and w is the document's quality weight. Where the
budget ends is narrowed down in rounds: the keys of the part that holds the end
are binned, bins are summed before any shuffle, and the one bin with the end is
the next part, until it holds few rows; only these are ordered row by row. Rows
of one key, as all rows without an id have, are divided by a second number each.
So no task sorts more than ``bin_rows`` rows of a source, whatever the weights.
What comes out is one cut for each source, so documents are judged row by row and
never shuffled.

Null text has size 0; null ids hash as empty; a null source is one of its own.
Repeated rows are rows of their own in ``mix_sources``: as many of them are taken
once more as the budget still holds. An empty table gives an empty result, and
texts of any length are counted whole. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.native import count_symbols, count_words, free_name
from corpusloom.llm.storage import materialize

#: Rows of a source that one task may order, and bins of a round.
BIN_ROWS, BINS = 2000, 1024
MOST_EPOCHS = 3
_TIES, _ROUNDS = (1 << 52) - 1, 40


def quality_weight(text: Column) -> Column:
    """Between 0.1 and 1: a text full of symbols is sampled later."""
    return F.greatest(F.lit(0.1), 1 - 20.0 * count_symbols(text) / F.greatest(F.lit(1), F.length(F.coalesce(text, F.lit("")))))


def sampling_key(doc_id: Column, weight: Column) -> Column:
    """An exponential variate of rate weight, fixed by the id."""
    digest = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13)
    u = (F.conv(digest, 16, 10).cast("long") + 1) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = MOST_EPOCHS) -> DataFrame:
    """sizes: one row for each source with source_size. Adds weight and target, whose sum is that of the sizes."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    ranked = ranked.withColumns({"level": left / share, "place": F.row_number().over(by_ratio)})
    ranked = ranked.withColumn("free", F.col("cap") / F.col("weight") >= F.col("level"))
    level = F.min_by(F.col("level"), F.when(F.col("free"), F.col("place"))).over(everything)
    return ranked.withColumn("target", F.least(level * F.col("weight"), F.col("cap").cast("double"))).select("source", "source_size", "weight", "target")


def mixing_plan(keyed: DataFrame, bin_rows: int = BIN_ROWS, bins: int = BINS) -> DataFrame:
    """keyed: rows of source, key, tie, size. One row for each source: target, epochs, and the cut up to which rows are taken once more.

    Rows before ``first``, a struct of key and tie, and those up to ``cut`` are. Of
    the rows at ``split``, two or more of one key and tie that the budget's end
    divides, ``split_rows`` are; null where there is nothing to divide.
    """
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    sizes = materialize(sizes, "sources", compact=True)
    plan = source_targets(sizes.select("source", "source_size")).withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_EPOCHS))).otherwise(0))
    plan = materialize(plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size")), "plan", tiny=True)

    # the part of each source that holds the end of its budget: keys from lo to hi, and where they are one, ties from tie_lo to tie_hi
    part = sizes.join(plan.select(F.col("source").alias("p_source"), "budget"), F.col("source").eqNullSafe(F.col("p_source")))
    part = part.select("source", "budget", "n", "lo", "hi", F.lit(0.0).alias("tie_lo"), F.lit(float(_TIES)).alias("tie_hi"), F.lit(0).cast("long").alias("before"))
    for _ in range(_ROUNDS):
        wide = (F.col("n") > bin_rows) & ((F.col("lo") < F.col("hi")) | (F.col("tie_lo") < F.col("tie_hi")))
        if not part.filter(wide).limit(1).count():
            break
        part = materialize(narrowed(keyed, part, bins), "part", compact=True)

    p = part.select(F.col("source").alias("p_source"), "budget", "lo", "hi", "tie_lo", "tie_hi", "before")
    inside = keyed.join(p, F.col("source").eqNullSafe(F.col("p_source")) & F.col("key").between(F.col("lo"), F.col("hi")) & F.col("tie").between(F.col("tie_lo"), F.col("tie_hi")))
    units = inside.groupBy("source", "key", "tie", "before", "budget").agg(F.sum("size").alias("unit"), F.count(F.lit(1)).alias("rows"))
    ordered = Window.partitionBy("source").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, -1)
    units = units.withColumn("start", F.col("before") + F.coalesce(F.sum("unit").over(ordered), F.lit(0)))
    within = 2 * F.col("start") + F.col("unit") <= 2 * F.col("budget")
    here = F.struct("key", "tie")
    divided = (F.col("rows") > 1) & (F.col("start") < F.col("budget")) & (F.col("budget") < F.col("start") + F.col("unit"))
    share = F.round((F.col("budget") - F.col("start")) * F.col("rows") / F.col("unit")).cast("long")
    at = F.struct("key", "tie", share.alias("n"))
    cut = units.groupBy("source").agg(F.max(F.when(within & ~divided, here)).alias("cut"), F.min(here).alias("first"), F.max(F.when(divided, at)).alias("at")).withColumnRenamed("source", "c_source")
    cut = cut.withColumns({"split": F.when(F.col("at").isNotNull(), F.struct("at.key", "at.tie")), "split_rows": F.col("at.n")}).drop("at")
    plan = plan.join(cut, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")
    return materialize(plan, "cuts", compact=True)


def narrowed(keyed: DataFrame, part: DataFrame, bins: int) -> DataFrame:
    """One round: each source's part is cut to the bin in which its budget ends."""
    p = part.select(F.col("source").alias("p_source"), "budget", "lo", "hi", "tie_lo", "tie_hi", "before")
    inside = keyed.join(p, F.col("source").eqNullSafe(F.col("p_source")) & F.col("key").between(F.col("lo"), F.col("hi")) & F.col("tie").between(F.col("tie_lo"), F.col("tie_hi")))
    share = lambda x, lo, hi: F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1))
    # keys crowd at the low end, so they are binned by 1 - exp(lo - key) over its range
    of = lambda c: 1 - F.exp(F.col("lo") - c)
    by_key = F.when(F.exp(F.col("lo") - F.col("hi")) < 0.5, share(of(F.col("key")), F.lit(0.0), of(F.col("hi")))).otherwise(share(F.col("key"), F.col("lo"), F.col("hi")))
    by_tie = F.when(F.col("tie_lo") < F.col("tie_hi"), share(F.col("tie"), F.col("tie_lo"), F.col("tie_hi"))).otherwise(0)
    binned = inside.withColumn("bin", F.when(F.col("lo") < F.col("hi"), by_key).otherwise(by_tie).cast("int"))
    binned = binned.groupBy("source", "budget", "before", "bin").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"), *(f(c).alias(name) for f, c, name in ((F.min, "key", "lo"), (F.max, "key", "hi"), (F.min, "tie", "tie_lo"), (F.max, "tie", "tie_hi"))))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = binned.withColumn("before", F.col("before") + F.coalesce(F.sum("s").over(upto), F.lit(0)))
    ends = placed.filter((F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("s")))
    return ends.select("source", "budget", "n", "lo", "hi", F.col("tie_lo").cast("double").alias("tie_lo"), F.col("tie_hi").cast("double").alias("tie_hi"), "before")


def taken_times(key: Column, tie: Column, plan: str, place: Column | None = None) -> Column:
    """How often a row is taken; plan names the struct column with its source's plan, place the row's number among those at the split, from 1."""
    of = lambda c: F.col(f"{plan}.{c}")
    here = F.struct(key.alias("key"), tie.alias("tie"))
    before = F.coalesce((here < of("first")) | (here <= F.coalesce(of("cut"), F.struct(F.lit(-1.0).alias("key"), F.lit(0).cast("long").alias("tie")))), F.lit(False))
    if place is not None:
        before = before | F.coalesce((here == of("split")) & (place <= of("split_rows")), F.lit(False))
    return of("epochs") + before.cast("long")


def split_places(rows: DataFrame, plan: DataFrame, number: str) -> DataFrame:
    """Of the rows of one key and tie that a budget's end divides: their stored number (as its_number) and their place among them, from 1.

    Rows are equal there, so which of them come first changes nothing. Places are
    ranks inside a part of the table and the sizes of the parts before it.
    """
    at = plan.filter("split is not null").select(F.col("source").alias("p_source"), F.col("split.key").alias("p_key"), F.col("split.tie").alias("p_tie"))
    same = rows["source"].eqNullSafe(F.col("p_source")) & (rows["key"] == F.col("p_key")) & (rows["tie"] == F.col("p_tie"))
    rows = rows.join(at, same).select("source", F.col(number).alias("its_number"), F.shiftright(F.col(number), 33).alias("part"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("source", "part").orderBy("its_number")))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", before).select(F.col("source").alias("s_source"), F.col("part").alias("s_part"), "before")
    joined = ranked.join(sizes, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("part") == F.col("s_part")))
    return joined.select("its_number", (F.col("before") + F.col("rank")).alias("place"))


def tie_of(*values: Column) -> Column:
    return F.xxhash64(*values).bitwiseAND(F.lit(_TIES))


def keyed_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, quality: Column | None, tie: Column) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), count_words(text).alias("size"), sampling_key(F.col(id_col), quality_weight(text) if quality is None else quality).alias("key"), tie.alias("tie"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality: Column | None = None, bin_rows: int = BIN_ROWS, bins: int = BINS) -> DataFrame:
    """Per row: the id (as doc_id), size, source_size, target, and taken, the words that the mix takes with repeats."""
    text = F.col(text_col).cast("string")
    rows = materialize(keyed_rows(docs, id_col, text_col, source_col, quality, tie_of(F.col(id_col), text)).withColumn("number", F.monotonically_increasing_id()), "keyed")
    found = mixing_plan(rows.drop("doc_id", "number"), bin_rows, bins)
    plan = found.select(F.col("source").alias("__source"), F.struct("*").alias("__plan"))
    joined, place = rows.join(plan, rows["source"].eqNullSafe(plan["__source"])), None
    if found.filter("split is not null").limit(1).count():
        joined, place = joined.join(split_places(rows, found, "number"), F.col("number") == F.col("its_number"), "left"), F.col("place")
    times = taken_times(F.col("key"), F.col("tie"), "__plan", place)
    return joined.select("doc_id", "size", F.col("__plan.source_size"), F.col("__plan.target"), (times * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bin_rows: int = BIN_ROWS, bins: int = BINS) -> DataFrame:
    """docs with each row repeated as often as the mix takes it; columns as before.

    Rows are told apart by id and text, so docs is read twice and not written.
    Only where the cut would divide rows equal in both are docs written once with
    a number, and those rows divided by it.
    """
    text, source = F.col(text_col).cast("string"), F.col(source_col).cast("string")
    columns, tie = docs.columns, tie_of(F.col(id_col), text)

    plan = mixing_plan(materialize(keyed_rows(docs, id_col, text_col, source_col, None, tie).drop("doc_id"), "keyed"), bin_rows, bins)
    its, mine, times, copy, number, place = (free_name(docs, c) for c in ("its_source", "plan", "times", "copy", "number", "place"))
    places = None
    if plan.filter("split is not null").limit(1).count():
        docs = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
        key = sampling_key(F.col(id_col), quality_weight(text))
        rows = docs.select(source.alias("source"), key.alias("key"), tie.alias("tie"), F.col(number).alias("its"))
        places = split_places(rows, plan, "its").withColumnsRenamed({"place": place})
    plan = plan.select(F.col("source").alias(its), F.struct("*").alias(mine))
    joined = docs.join(plan, source.eqNullSafe(F.col(its)))
    if places is not None:
        joined = joined.join(places.withColumnRenamed("its_number", its + "_"), F.col(number) == F.col(its + "_"), "left")
    repeated = joined.withColumn(times, taken_times(sampling_key(F.col(id_col), quality_weight(text)), tie, mine, None if places is None else F.col(place))).filter(F.col(times) > 0)
    return repeated.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*columns)


MIXING_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
  greatest(0.1::DOUBLE, 1 - 20.0::DOUBLE * (len(coalesce(text, '')) - len(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g'))) / greatest(1, len(coalesce(text, '')))) AS q,
  coalesce(doc_id::VARCHAR, '') AS id FROM documents),
k AS (SELECT *, -ln((('0x' || substr(md5(id), 1, 13))::BIGINT + 1) / 4503599627370496::DOUBLE) / q AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
o AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w, 3 * source_size AS cap FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY cap / w, source ASC NULLS LAST) AS place FROM o),
l AS (SELECT *, ((SELECT sum(source_size) FROM r) - coalesce(sum(cap) OVER b, 0))::DOUBLE / ((SELECT sum(w) FROM r) - coalesce(sum(w) OVER b, 0)) AS level
  FROM r WINDOW b AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level FROM l WHERE cap / w >= level ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, least((SELECT level FROM f) * w, cap::DOUBLE) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS epochs FROM t),
g AS (SELECT k.doc_id, k.id, k.source, k.key, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS budget
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
u AS (SELECT *, sum(size) OVER (PARTITION BY source, key, id, size) AS unit, sum(size) OVER (PARTITION BY source ORDER BY key, id, size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM g)
SELECT doc_id, size, source_size, target, ((epochs + (2 * (upto - unit) + unit <= 2 * budget)::BIGINT) * size)::BIGINT AS taken FROM u
"""
