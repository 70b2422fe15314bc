"""A stored inverted index of tokenised rows: postings in blocks with bounds, top-k that skips blocks, changes by version.

A block holds the postings of one term whose ids lie in one range and whose
frequencies and lengths are of one class, so a common term is many blocks and no
task orders a whole list. Each block carries its least and largest frequency and
length; BM25 rises with the frequency and falls with the length, so they bound
its scores without a look at the postings. The ranking wanted here is the title
route's, which puts small BM25 values first.

Null ids and null token lists are not indexed. Repeated ids are an error of the
caller's: an index holds one version of a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.retrieval import B, K1, top
from corpusloom.sources.staging import materialize

#: Ids of a block's range, and frequencies from which on all are one class.
RANGE, FREQUENT = 4096, 8
_BLOCK = ["term", "range", "f_class", "size_class"]


def _blocks(postings: DataFrame) -> DataFrame:
    """postings: term, id, version, size, at (positions)."""
    f = F.size("at")
    keyed = postings.withColumns({"f": f, "range": F.floor(F.col("id") / RANGE), "f_class": F.least(f, F.lit(FREQUENT)), "size_class": F.floor(F.log2(F.col("size"))).cast("int")})
    entry = F.struct("id", "version", "size", "f", "at")
    bounds = [F.count(F.lit(1)).alias("n"), *(g(c).alias(f"{name}_{c}") for c in ("f", "size") for g, name in ((F.min, "min"), (F.max, "max")))]
    return keyed.groupBy(*_BLOCK).agg(*bounds, F.array_sort(F.collect_list(entry)).alias("entries"))


def _stored(blocks: DataFrame, label: str) -> DataFrame:
    """Written in ranges of terms, so a search reads the files and row groups of its terms."""
    return materialize(blocks.repartitionByRange("term").sortWithinPartitions("term", "range"), label)


def build(rows: DataFrame) -> DataFrame:
    """rows: id, version, tokens. The index as a table of blocks."""
    return _stored(_blocks(postings(rows)), "index")


def postings(rows: DataFrame) -> DataFrame:
    held = rows.filter("id is not null and tokens is not null")
    each = held.select("id", "version", F.size("tokens").alias("size"), F.posexplode("tokens").alias("at", "term"))
    return each.groupBy("term", "id", "version", "size").agg(F.sort_array(F.collect_list("at")).alias("at"))


def changed(index: DataFrame, removed: DataFrame, added: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index without the rows of removed (id, version) and with those of added (id, version, tokens), and the blocks that were written for it.

    Only blocks whose term and id range a change meets are written anew; the
    others are read from where they are.
    """
    gone = removed.select("id", "version").distinct()
    ranges = gone.select(F.floor(F.col("id") / RANGE).alias("range")).distinct()
    fresh = postings(added)
    # terms and ranges that a removed row stands in, and those that an added one comes to
    old = index.join(ranges, "range").select("term", "range", F.explode("entries").alias("e")).select("term", "range", F.col("e.id").alias("id"), F.col("e.version").alias("version"))
    met = old.join(gone, ["id", "version"]).select("term", "range").unionByName(fresh.select("term", F.floor(F.col("id") / RANGE).alias("range"))).distinct()
    met = materialize(met, "met", compact=True)
    kept = index.join(met, ["term", "range"], "left_anti")
    again = index.join(met, ["term", "range"]).select("term", F.explode("entries").alias("e")).select("term", "e.id", "e.version", "e.size", "e.at").join(gone, ["id", "version"], "left_anti")
    written = _stored(_blocks(again.unionByName(fresh)), "index-part")
    return kept.select(written.columns).unionByName(written), written


def weight(f: Column, size: Column, mean: float) -> Column:
    """BM25 without the rarity of the term."""
    return f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean))


def chosen_blocks(headers: DataFrame, k: int, mean: float) -> DataFrame:
    """headers: query_id and a block without entries. The blocks that may hold one of the k least weights of the query.

    Blocks in the order of the most that they can weigh: once those so far hold k
    rows, no block that weighs more at least can matter. Equal weights stay, ids
    decide between them.
    """
    least, most = weight(F.col("min_f"), F.col("max_size"), mean), weight(F.col("max_f"), F.col("min_size"), mean)
    # classes of equal bounds are summed up first: a row a query and class, however many blocks
    bounded = headers.withColumns({"least": F.round(least, 12), "most": F.round(most, 12)})
    sums = bounded.groupBy("query_id", "most").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("query_id").orderBy("most"))
    limit = sums.withColumn("upto", upto).filter(F.col("upto") >= k).groupBy("query_id").agg(F.min("most").alias("limit"))
    met = bounded.join(limit, "query_id", "left").filter(F.col("limit").isNull() | (F.col("least") <= F.col("limit") + 1e-9))
    return met.select("query_id", *_BLOCK)


def phrase_starts(parts: Column) -> Column:
    """parts: an array of (offset, positions). How often all stand at one start, without overlap, for a phrase of as many tokens."""
    shifted = F.transform(parts, lambda p: F.transform(p["at"], lambda x: x - p["offset"]))
    starts = F.array_sort(F.aggregate(F.slice(shifted, 2, F.size(shifted)), F.get(shifted, 0), lambda a, b: F.array_intersect(a, b)))
    first = F.struct(F.lit(0).alias("n"), F.lit(0).alias("free"))
    after = lambda s, x: F.when(x >= s["free"], F.struct((s["n"] + 1).alias("n"), (x + F.size(parts)).alias("free"))).otherwise(s)
    return F.aggregate(starts, first, after)["n"]


def search(index: DataFrame, queries: DataFrame, k: int, docs: int, mean: float) -> tuple[DataFrame, DataFrame]:
    """queries: query_id, tokens (one or more). The k best rows of each: query_id, id, score; and the blocks read.

    A phrase counts as one term. Queries of one token read the blocks that their
    bounds leave; of phrases all blocks of their tokens are read, since how many
    rows hold the phrase is not known before.
    """
    tokens = queries.select("query_id", F.size("tokens").alias("length"), F.posexplode("tokens").alias("offset", "term"))
    tokens = F.broadcast(tokens)  # a query table is bounded
    headers = index.drop("entries").join(tokens, "term")
    single = headers.filter("length = 1")
    wanted = chosen_blocks(single, k, mean).unionByName(headers.filter("length > 1").select("query_id", *_BLOCK)).distinct()
    read = materialize(wanted, "wanted", compact=True)
    # the rarity of a single token needs only the headers
    frequency = single.groupBy("query_id").agg(F.sum("n").alias("df"))
    met = index.select(*_BLOCK, "entries").join(read, _BLOCK).join(tokens, ["query_id", "term"]).select("query_id", "length", "offset", F.explode("entries").alias("e"))
    met = met.select("query_id", "length", "offset", "e.id", "e.size", "e.f", "e.at")
    alone = met.filter("length = 1").select("query_id", "id", "size", "f")
    parts = met.filter("length > 1").groupBy("query_id", "length", "id", "size").agg(F.array_sort(F.collect_list(F.struct("offset", "at"))).alias("parts"))
    phrases = parts.filter(F.size("parts") == F.col("length")).withColumn("f", phrase_starts(F.col("parts"))).filter("f > 0").select("query_id", "id", "size", "f")
    phrases = materialize(phrases, "phrases", compact=True)
    frequency = frequency.unionByName(phrases.groupBy("query_id").agg(F.count(F.lit(1)).alias("df")))
    rarity = F.greatest(F.log((docs - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    scored = alone.unionByName(phrases).join(frequency, "query_id").withColumn("score", F.round(1 / (1 + F.abs(rarity * weight(F.col("f"), F.col("size"), mean))), 6))
    return top(scored.select("query_id", "id", "score"), k, ["query_id"], F.desc("score"), F.asc("id")), read


def differences(index: DataFrame, rows: DataFrame) -> DataFrame:
    """One row of counts: rows and index entries (an id and version each), those missing from the index, orphans in it, and ids whose number of postings is not that of their tokens."""
    main = rows.filter("tokens is not null and size(tokens) > 0").select("id", "version", F.size("tokens").alias("tokens"))
    held = index.select(F.explode("entries").alias("e")).groupBy("e.id", "e.version").agg(F.sum("e.f").alias("held")).select(F.col("id").alias("i"), F.col("version").alias("v"), "held")
    both = main.join(held, (F.col("id") == F.col("i")) & F.col("version").eqNullSafe(F.col("v")), "full_outer")
    return both.agg(F.count("id").alias("main_rows"), F.count("i").alias("index_rows"), F.count_if(F.col("i").isNull()).alias("missing"), F.count_if(F.col("id").isNull()).alias("orphans"), F.count_if(F.col("tokens") != F.col("held")).alias("damaged"))
