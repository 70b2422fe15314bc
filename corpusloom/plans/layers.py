"""Queries of small operators that the larger chains use, each by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import let
from corpusloom.operators.events import CONFIDENCE, DECISION_CONFIDENCE, global_positions, lookup
from corpusloom.plans.registry import query
from corpusloom.sources.corpus import table
from corpusloom.sources.staging import materialize

ROLES = ["subject", "agent", "speaker", "object"]
_roles = "[" + ", ".join(f"'{r}'" for r in ROLES) + "]"


@query(f"WITH a AS (SELECT l_orderkey AS event_id, l_linenumber AS pos, {_roles}[(l_suppkey % 4 + 1)::INT] AS role, l_partkey AS value FROM lineitem) SELECT event_id, value AS first_value, role AS first_role FROM a QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY list_position({_roles}, role), pos, value) = 1")
def w16_first_role_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W16 the first value by a role's priority, then by position and value; one aggregate, no sort of whole groups."""
    roles = F.array(*map(F.lit, ROLES))
    a = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_linenumber").alias("pos"), F.get(roles, (F.col("l_suppkey") % 4).cast("int")).alias("role"), F.col("l_partkey").alias("value"))
    first = F.min(F.struct(F.array_position(roles, F.col("role")).alias("p"), "pos", "value", "role")).alias("f")
    return a.groupBy("event_id").agg(first).select("event_id", F.col("f.value").alias("first_value"), F.col("f.role").alias("first_role"))


@query("WITH c AS (SELECT l_orderkey AS event_id, l_linenumber AS pos, l_discount AS confidence, l_partkey AS candidate FROM lineitem) SELECT event_id, candidate, confidence FROM c QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY confidence DESC, pos, candidate) = 1")
def w15_best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W15 the most confident candidate; of equal ones the first."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_linenumber").alias("pos"), F.col("l_discount").alias("confidence"), F.col("l_partkey").alias("candidate"))
    best = F.min(F.struct((-F.col("confidence")).alias("c"), "pos", "candidate")).alias("b")
    return c.groupBy("event_id").agg(best).select("event_id", F.col("b.candidate").alias("candidate"), (-F.col("b.c")).alias("confidence"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END, chr(65535)), o_orderdate DESC, o_orderkey) AS place FROM orders")
def w17_export_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W17 an export's order over several keys, nulls as the last character; places are ranks inside a day of a priority plus the sizes before it."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")), F.lit("￿")).alias("p"), (-F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("late"))
    # a row a priority is numbered, and its days after it
    rank = o.select("p").distinct().withColumn("rank", F.row_number().over(Window.orderBy("p")))
    part = F.col("rank") * 1_000_000 + F.floor(F.col("late") / 86_400_000_000) + 500_000
    return global_positions(o.join(rank, "p"), part, "late", "o_orderkey").select("o_orderkey", F.col("position").alias("place"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 0.8 WHEN 1 THEN 0.5 WHEN 2 THEN 0.2 ELSE 0.5 END::DOUBLE AS score, CASE doc_id % 5 WHEN 0 THEN 0.25 WHEN 1 THEN 0.6 WHEN 2 THEN 0.9 WHEN 3 THEN 0.37 END::DOUBLE AS decision FROM documents")
def x43_confidence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X43 confidence words as scores, decisions as words or numbers in range."""
    i = F.col("doc_id")
    word = F.get(F.array(*map(F.lit, ["high", "medium", "low", "other"])), (i % 4).cast("int"))
    said = F.get(F.array(*map(F.lit, ["low", " Medium", "HIGH", "0.37", "1.7"])), (i % 5).cast("int"))
    number = let(F.trim(said), lambda v: F.coalesce(lookup(F.lower(v), DECISION_CONFIDENCE), v.try_cast("double")))
    return table(spark, sf_dir, "documents").select("doc_id", lookup(word, CONFIDENCE, 0.5).alias("score"), F.when(number.between(0.0, 1.0), number).alias("decision"))


@query("SELECT doc_id, try_cast(nullif(regexp_extract('ch_' || printf('%04d', doc_id) || '_p_0012_s_0003', '_p_([0-9]+)', 1), '') AS BIGINT) AS para_index, try_cast(nullif(regexp_extract('ch_' || printf('%04d', doc_id) || '_p_0012_s_0003', '_s_([0-9]+)', 1), '') AS BIGINT) AS sentence_index, CASE WHEN doc_id % 3 = 0 THEN 'chroma_vector' WHEN doc_id % 3 = 1 THEN 'sqlite_child_keyword' ELSE 'sqlite_title' END AS source FROM documents")
def x40_id_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X40 numbers in id suffixes, M3 coordinates from ids, X41 a hit's source by precedence."""
    i = F.col("doc_id")
    key = F.concat(F.lit("ch_"), F.lpad(i.cast("string"), 4, "0"), F.lit("_p_0012_s_0003"))
    part = lambda p: F.nullif(F.regexp_extract(key, p, 1), F.lit("")).cast("long")
    sources = F.when(i % 3 == 0, F.array(F.lit("sqlite_title"), F.lit("chroma_vector"))).when(i % 3 == 1, F.array(F.lit("sqlite_child_keyword"))).otherwise(F.array(F.lit("sqlite_title")))
    label = F.when(F.array_contains(sources, "chroma_vector"), "chroma_vector").when(F.array_contains(sources, "sqlite_child_keyword"), "sqlite_child_keyword").otherwise("sqlite_title")
    return table(spark, sf_dir, "documents").select("doc_id", part("_p_([0-9]+)").alias("para_index"), part("_s_([0-9]+)").alias("sentence_index"), label.alias("source"))


@query("SELECT a.doc_id, 'only_first' AS side FROM documents a WHERE a.doc_id % 3 <> 0 AND a.doc_id % 5 = 0 UNION ALL SELECT doc_id, 'only_second' FROM documents WHERE doc_id % 3 = 0 AND doc_id % 5 <> 0")
def o01_id_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 differences of two id sets in both directions from one full outer join."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    a, b = d.filter("doc_id % 3 <> 0").withColumnRenamed("doc_id", "a"), d.filter("doc_id % 5 <> 0").withColumnRenamed("doc_id", "b")
    side = F.when(F.col("b").isNull(), "only_first").when(F.col("a").isNull(), "only_second")
    return a.join(b, F.col("a") == F.col("b"), "full_outer").filter("a is null or b is null").select(F.coalesce("a", "b").alias("doc_id"), side.alias("side"))


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """df sorted and dealt by ranges of the order, written with its part and its place there: rows of one time are spread like any others."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return materialize(ordered, "ordered").withColumns({"part": F.shiftright("at", 33), "place": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("at")


def as_of(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both: event_id, t in microseconds. For each left row the id of the last right row at or before it, the larger of equal times; null where there is none.

    Both sides are sorted together in ranges; inside a range a window carries the
    last right row on, and the last one of earlier ranges is carried over, a row a range.
    """
    right = right.filter("t is not null").groupBy("t").agg(F.max("event_id").alias("r"))
    both = right.select("t", F.lit(0).alias("k"), "r", F.lit(None).cast("long").alias("event_id")).unionByName(left.select("t", F.lit(1).alias("k"), F.lit(None).cast("long").alias("r"), "event_id"))
    ordered = in_ranges(both, "t", "k", "event_id")
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = ordered.groupBy("part").agg(F.max_by("r", F.when(F.col("k") == 0, F.col("place"))).alias("z"))
    earlier = last.select("part", F.last("z", ignorenulls=True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    found = ordered.withColumn("here", F.last("r", ignorenulls=True).over(inside)).filter("k = 1").join(earlier, "part")
    return found.select("event_id", F.coalesce("here", "carried").alias("previous_id"))


@query("WITH o AS (SELECT event_id, ts FROM events WHERE event_id % 3 = 0) SELECT n.event_id, o.event_id AS previous_id FROM events n ASOF LEFT JOIN (SELECT max(event_id) AS event_id, ts FROM o GROUP BY ts) o ON n.ts >= o.ts")
def j25_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J25 as-of lookup for every event against every third one."""
    e = table(spark, sf_dir, "events").select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return as_of(e, e.filter("event_id % 3 = 0"))
