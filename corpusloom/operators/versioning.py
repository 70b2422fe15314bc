"""Versioned upserts and checks of stored keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def compare(stored: DataFrame, incoming: DataFrame, key: str = "chapter_id") -> DataFrame:
    """Current stored rows against incoming ones: action and both sides' columns as structs old and new."""
    old = stored.filter("is_current = 1").select(F.col(key).alias("__k"), F.struct("*").alias("old"))
    new = incoming.select(F.col(key).alias("__n"), F.struct("*").alias("new"))
    joined = old.join(new, F.col("__k") == F.col("__n"), "full_outer")
    action = F.when(F.col("__n").isNull(), "absent").when(F.col("__k").isNull(), "inserted").when(F.col("new.content_hash") == F.col("old.content_hash"), "unchanged").otherwise("new_version")
    return joined.select("old", "new", action.alias("action"))


def upsert(stored: DataFrame, incoming: DataFrame, key: str = "chapter_id") -> DataFrame:
    """All versions after the delivery, with is_current and the action that led there: one full outer join, exploded."""
    fields = [c for c in stored.columns if c != "is_current"]
    row = lambda side, current: F.struct(*(F.col(f"{side}.{c}").alias(c) for c in fields), F.lit(current).alias("is_current"))
    kept, demoted, added = row("old", 1), row("old", 0), row("new", 1)
    rows = F.when(F.col("action") == "inserted", F.array(added)).when(F.col("action") == "new_version", F.array(demoted, added)).otherwise(F.array(kept))
    history = stored.filter("is_current <> 1").withColumn("action", F.lit("history")).select(*stored.columns, "action")
    return compare(stored, incoming, key).select(F.explode(rows).alias("r"), "action").select(*(f"r.{c}" for c in stored.columns), "action").unionByName(history)


def registry(stored: DataFrame, incoming: DataFrame, key: str = "chapter_id") -> DataFrame:
    both = compare(stored, incoming, key)
    pick = lambda c: F.coalesce(f"new.{c}", f"old.{c}")
    return both.select(pick(key).alias(key), pick("chapter_num").alias("chapter_num"), pick("version_id").alias("latest_version_id"))


def new_rows(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    return incoming.join(stored.select(*keys), keys, "left_anti")


def missing_numbers(df: DataFrame, column: str, bucket: int = 1 << 16) -> DataFrame:
    """Numbers between the least and the largest of column that it lacks.

    Neighbours are found inside buckets of the number line; only each bucket's
    edges meet in one window. A gap is listed by the buckets that it meets, then
    inside each, so no row holds more than bucket numbers of it.
    """
    n = df.select(F.col(column).cast("long").alias("n")).distinct().withColumn("b", F.floor(F.col("n") / bucket))
    inside = n.withColumn("next", F.lead("n").over(Window.partitionBy("b").orderBy("n")))
    edges = n.groupBy("b").agg(F.min("n").alias("lo"), F.max("n").alias("n")).withColumn("next", F.lead("lo").over(Window.orderBy("b")))
    pairs = inside.filter("next is not null").select("n", "next").unionByName(edges.filter("next is not null").select("n", "next"))
    gaps = pairs.filter("next > n + 1").select((F.col("n") + 1).alias("a"), (F.col("next") - 1).alias("z"))
    gaps = gaps.withColumn("b", F.explode(F.sequence(F.floor(F.col("a") / bucket), F.floor(F.col("z") / bucket))))
    first, last = F.greatest(F.col("a"), F.col("b") * bucket), F.least(F.col("z"), (F.col("b") + 1) * bucket - 1)
    return gaps.select(F.explode(F.sequence(first, last)).alias(column))


def scoped(df: DataFrame, column: str, wanted: list[int]) -> DataFrame:
    """Rows of the wanted keys in order; a key without a row is an error. wanted is a short list of the caller's."""
    rows = df.filter(F.col(column).isin(wanted))
    found = {r[0] for r in rows.select(column).distinct().collect()}
    if lacking := sorted(set(wanted) - found):
        raise ValueError(f"no rows for {column} in {lacking}")
    return rows.orderBy(column)
