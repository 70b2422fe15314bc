"""A stored tree of hashes over a table: its root is the table's fingerprint, and two trees are compared downwards, only where they differ.

A row's place is a range of the SHA-256 of its key, so ranges hold about as many rows
whatever the keys are, and two stores are cut alike without agreeing on borders. A row's
digest covers its key and columns. A leaf is the digest of its rows' number and of the
sums of their digests, which are added up before they move, so a key that many rows
share is no large group; a node is the digest of its at most sixteen children in order.
Rows that change, appear, go, or move to another key change the root; the order in which
a table is read does not, unless a column of the digest states it.

Null keys are a key of their own, null and empty values differ, equal rows count as often
as they occur, and an empty table has no nodes. Beside the nodes only keys and digests are
stored, in a folder for each of the first digits of a leaf, and sorted by leaf there.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import sha256
from corpusloom.sources.files import exists

#: Digits of a row's digest in each of the sums; a sum of 60-bit numbers fits 38 decimal digits for any table.
PIECES, DIGITS = 4, 15
#: Nodes or leaves up to which the scan itself is told them.
LISTED = 500


def encoded(columns: list[str], df: DataFrame) -> Column:
    """Values joined so that no two rows read alike: a bar for null, else length, colon, value; nested ones as JSON."""
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")}
    texts = [F.to_json(F.col(c)) if c in nested else F.col(c).cast("string") for c in columns]
    return F.concat(*(F.when(t.isNull(), "|").otherwise(F.concat(F.length(t).cast("string"), F.lit(":"), t)) for t in texts))


def keyed_digests(rows: DataFrame, key: str, columns: list[str], levels: int) -> DataFrame:
    """key, leaf, and the digest's pieces d0 to d3 as longs."""
    digest, place = sha256(encoded([key, *columns], rows)), sha256(encoded([key], rows))
    hashed = rows.select(F.col(key).alias("key"), F.substring(place, 1, levels).alias("leaf"), digest.alias("h"))
    pieces = (F.conv(F.substring("h", 1 + DIGITS * i, DIGITS), 16, 10).cast("long").alias(f"d{i}") for i in range(PIECES))
    return hashed.select("key", "leaf", *pieces)


def summed(rows: DataFrame, *by: str) -> DataFrame:
    """Number of rows and digest of their sums, by any columns."""
    totals = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *(F.sum(F.col(f"d{i}").cast("decimal(38,0)")).cast("string").alias(f"s{i}") for i in range(PIECES)))
    return totals.select(*by, "n_rows", sha256(F.concat_ws("|", F.col("n_rows").cast("string"), *(f"s{i}" for i in range(PIECES)))).alias("digest"))


def stored_index(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
    return spark.read.schema(schema).parquet(f"{path}/index")


def write_tree(rows: DataFrame, key: str, path: str, columns: list[str] | None = None, levels: int = 3, folders: int = 1) -> None:
    """Write a table's tree of 16 ** levels leaves over the named columns, all by default, with its index in 16 ** folders folders. path must not exist."""
    spark = rows.sparkSession
    if not 1 <= folders <= levels:
        raise ValueError("a tree has a level at least, and no more digits of folders than levels")
    if exists(spark, path):
        raise ValueError(f"{path} exists")
    columns = sorted(c for c in columns or rows.columns if c != key)
    index = keyed_digests(rows, key, columns, levels).withColumn("part", F.substring("leaf", 1, folders))
    # a rebalance splits a folder that a hot key fills
    index.hint("rebalance", "part").sortWithinPartitions("part", "leaf").write.partitionBy("part").parquet(f"{path}/index")
    spark.createDataFrame([(index.schema.json(),)], "value string").coalesce(1).write.text(f"{path}/schema")
    stored = stored_index(spark, path)
    level = summed(stored, "leaf").withColumnRenamed("leaf", "node")
    for depth in range(levels, -1, -1):
        level.write.parquet(f"{path}/nodes/level={depth}")
        below = spark.read.schema(level.schema).parquet(f"{path}/nodes/level={depth}")
        children = F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda c: F.concat(c["node"], F.lit(":"), c["digest"]))
        parent = F.substring("node", 1, depth - 1) if depth > 1 else F.lit("")
        level = below.groupBy(parent.alias("node")).agg(F.sum("n_rows").alias("n_rows"), sha256(F.array_join(children, "|")).alias("digest"))


def nodes(spark: SparkSession, path: str) -> DataFrame:
    """level, node (its digits), n_rows, digest."""
    return spark.read.schema("node string, n_rows long, digest string, level int").parquet(f"{path}/nodes").select("level", "node", "n_rows", "digest")


def among(rows: DataFrame, column: Column, values: list[str]) -> DataFrame:
    """Rows whose column is one of the values: few of them are told to the scan, more are joined."""
    if len(values) <= LISTED:
        return rows.filter(column.isin(values))
    wanted = rows.sparkSession.createDataFrame([(v,) for v in values], "__wanted string")
    return rows.join(wanted, column == F.col("__wanted"), "left_semi")


def differing_leaves(spark: SparkSession, left: str, right: str) -> tuple[list[str], int]:
    """Leaves that differ, and how many nodes of the two trees were compared on the way: at each level only children of nodes that differ."""
    a, b = nodes(spark, left), nodes(spark, right)
    deepest = [t.agg(F.max("level")).first()[0] for t in (a, b)]
    if None not in deepest and deepest[0] != deepest[1]:
        raise ValueError(f"the trees have {deepest[0]} and {deepest[1]} levels")
    met, compared = [""], 0
    for depth in range((deepest[0] or deepest[1] or 0) + 1):
        parent = F.substring("node", 1, depth - 1) if depth > 1 else F.lit("")
        one, two = (among(t.filter(F.col("level") == depth), parent, met).select("node", F.col("digest").alias(d)) for t, d in ((a, "l"), (b, "r")))
        # bounded by the tree's size, which is a parameter, and no more than the differing branches
        found = one.join(two, "node", "full_outer").select("node", F.col("l").eqNullSafe(F.col("r")).alias("equal")).collect()
        compared += len(found)
        met = sorted(r["node"] for r in found if not r["equal"])
        if not met:
            break
    return met, compared


def differing_keys(spark: SparkSession, left: str, right: str) -> DataFrame:
    """key, state (missing on the right, extra there, or changed), left_rows and right_rows of every key whose rows differ; only ranges that differ are read."""
    leaves, _ = differing_leaves(spark, left, right)
    # a store's folders have names of one length, so the others match none
    parts = sorted({n[:digits] for n in leaves for digits in range(1, len(n) + 1)})

    def side(path: str, prefix: str) -> DataFrame:
        rows = among(stored_index(spark, path).filter(F.col("part").isin(parts)), F.col("leaf"), leaves)
        return summed(rows, "key").select(F.col("key").alias(f"{prefix}_key"), F.col("n_rows").alias(f"{prefix}_rows"), F.col("digest").alias(f"{prefix}_digest"))

    pairs = side(left, "left").join(side(right, "right"), F.col("left_key").eqNullSafe(F.col("right_key")), "full_outer")
    state = F.when(F.col("right_rows").isNull(), "missing").when(F.col("left_rows").isNull(), "extra").otherwise("changed")
    rows = pairs.filter(~F.col("left_digest").eqNullSafe(F.col("right_digest")))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.select(F.when(F.col("left_rows").isNull(), F.col("right_key")).otherwise(F.col("left_key")).alias("key"), state.alias("state"), zero("left_rows"), zero("right_rows"))
