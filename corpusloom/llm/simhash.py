"""SimHash near-duplicates through sharded vantage-point trees (operator 4).

Fingerprints: ASCII lower case, words between ASCII white space, word shingles
with repeats (the whole sequence where it is shorter), XXH64 with seed 42; a bit
is set if it is set in over half of the shingles' hashes. A text without words,
null included, has fingerprint zero and is linked like any other.

Distinct fingerprints, each with its least id, are dealt to shards by trees whose
upper levels come from a bounded sample (``sample_rows``); the sample decides
only how work is divided, never which pairs are found. Shards that hold too many
rows all the same are dealt again, each by a tree from a sample of its own that a
task grows, and again until all are small; fingerprints that share a half are
split by the quarters of the other one. Shards emit stars, not pairs, so a large
group costs as many rows as it has fingerprints.

Repeated rows share a component. Null ids share their texts' components but are
never a component's id unless it has no other, when it is null. Of equal least
ids there is nothing to choose. Texts of any length are hashed whole, in blocks.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import vptree
from corpusloom.llm.components import star_components
from corpusloom.llm.storage import materialize, ship_package

SEED = 42
#: Least sample rows of a tree's leaf, most sample rows of a tree that a task grows, and rounds of dealing.
_LEAST, _TREE_ROWS, _ROUNDS = 16, 16_384, 40
_DEALT = "part int, shard long, fp long, guest boolean"
_ARROW = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("fp", pa.int64()), ("guest", pa.bool_())])
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCK = 1 << 15


def fingerprint(text: str | None, width: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one whole text."""
    words = (text or "").encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    digest, space = xxhash.xxh64_intdigest, b" "
    total, ones = max(1, len(words) - width + 1), np.zeros(64, np.int64)
    for at in range(0, total, _BLOCK):
        part = words[at : at + _BLOCK + width - 1]
        shingles = map(space.join, zip(*(part[k:] for k in range(width)), strict=False)) if len(words) >= width else (space.join(words),)
        hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """The id and ``fp``, the fingerprint as a signed long, for every row."""
    ship_package(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType(), False)])

    def hash_rows(batches):
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64), pa.int64())], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(hash_rows, schema)


def shards(prints: DataFrame, n_prints: int, shard_rows: int, sample_rows: int) -> DataFrame:
    """Rows of part, shard, fp and guest, such that any two near fingerprints meet in a shard, one of them at home.

    prints: distinct longs ``fp``. No shard of more than 8 * shard_rows rows
    stays while a tree can still split it.
    """
    spark = prints.sparkSession
    ship_package(spark)
    share = min(1.0, sample_rows / max(1, n_prints))
    chosen = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = chosen.select("fp").limit(2 * sample_rows).collect() if n_prints > shard_rows else []
    sample = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    leaf = max(_LEAST, int(len(sample) * shard_rows / max(1, n_prints)))
    trees = [vptree.grow(vptree.take(sample, part), leaf) if len(sample) else [] for part in (0, 1)]

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for part in (0, 1):
                for shard, at, guest in vptree.route(values.view(np.uint64), part, trees[part]):
                    yield _rows(part, shard, values[at], guest)

    dealt = prints.select("fp").mapInArrow(deal, _DEALT)
    most, ready = 8 * shard_rows, []
    for _ in range(_ROUNDS):
        sizes = materialize(dealt.filter("part >= 0").groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("guest")).alias("homes")).filter(f"n > {most}"), "heavy", compact=True)
        if not sizes.limit(1).count():
            return reduce(DataFrame.unionByName, ready, dealt)
        ready.append(dealt.join(sizes, ["part", "shard"], "left_anti"))
        # a shard of guests alone has no pair to find
        heavy = materialize(dealt.join(sizes.filter("homes > 0"), ["part", "shard"]), "redealt")
        dealt = materialize(deal_again(heavy, sizes, shard_rows, most), "shards")
    raise RuntimeError(f"shards did not settle in {_ROUNDS} rounds")


def _rows(part: int, shard: int, values: np.ndarray, guest: np.ndarray) -> pa.RecordBatch:
    n = len(values)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, shard, np.int64)), pa.array(values), pa.array(guest)], names=["part", "shard", "fp", "guest"])


def deal_again(heavy: DataFrame, sizes: DataFrame, shard_rows: int, most: int) -> DataFrame:
    """The rows of too large shards in smaller ones; a negative part marks those that no tree can split.

    heavy: rows with n and homes of their shard. Each shard's tree is grown in one
    task from a sample of at most about ``_TREE_ROWS`` of its own fingerprints and
    meets the shard's rows in slices of at most about ``most`` rows.
    """
    wanted = F.least(F.lit(_TREE_ROWS), 2 * _LEAST * F.ceil(F.col("n") / shard_rows))
    picked = F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < F.least(F.lit(1.0), wanted / F.col("homes")) * (1 << 30)
    slices = F.ceil(F.col("n") / most)

    def grow(table: pa.Table) -> pa.Table:
        part, shard = table.column("part")[0].as_py(), table.column("shard")[0].as_py()
        sample = np.sort(table.column("fp").to_numpy().astype(np.int64)).view(np.uint64)
        nodes = vptree.grow(vptree.take(sample, part), _LEAST)
        return pa.table({"part": pa.array([part], pa.int32()), "shard": [shard], "nodes": pa.array([[x for node in nodes for x in node]], pa.list_(pa.int64()))})

    def route(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], f.type) for f in _ARROW], schema=_ARROW)
        if not left.num_rows:
            return empty
        part, shard = left.column("part")[0].as_py(), left.column("shard")[0].as_py()
        values, guest = left.column("fp").to_numpy().astype(np.int64), left.column("guest").to_numpy(zero_copy_only=False).astype(bool)
        flat = right.column("nodes")[0].as_py() if right.num_rows else []
        nodes = list(zip(*(flat[i::4] for i in range(4)), strict=True))
        name = lambda p, leaf: xxhash.xxh64_intdigest(f"{part} {shard} {p} {leaf}") >> 1  # noqa: E731  two shards of one name would only be compared as one
        if nodes:
            out = [_rows(part, name(part, leaf), values[at], visiting) for leaf, at, visiting in vptree.route(values.view(np.uint64), part, nodes, guest)]
        elif part in vptree.BEYOND:
            out = [_rows(p, name(p, 0), values, guest) for p in vptree.BEYOND[part]]
        else:
            out = [_rows(~part, shard, values, guest)]
        return pa.Table.from_batches(out).cast(_ARROW) if out else empty

    trees = heavy.filter(~F.col("guest") & picked).groupBy("part", "shard").applyInArrow(grow, "part int, shard long, nodes array<long>")
    trees = trees.join(sizes, ["part", "shard"]).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))).select("part", "shard", "slice", "nodes")
    rows = heavy.select("part", "shard", F.pmod(F.xxhash64("fp", "guest"), slices).alias("slice"), "fp", "guest")
    keys = ["part", "shard", "slice"]
    return rows.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInArrow(route, _DEALT)


def fingerprint_links(prints: DataFrame, n_prints: int, shard_rows: int = 8192, sample_rows: int = 100_000) -> DataFrame:
    """Star edges (u, v) that connect exactly the fingerprints of each component.

    prints: distinct longs ``fp``. shard_rows: aimed-at items of a shard at home;
    sample_rows: about as many, and never twice as many, fingerprints reach the
    driver, picked by their hash in each task.
    """

    def join_shard(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        values = table.column("fp").to_numpy().astype(np.int64)
        order = np.argsort(values, kind="stable")
        values, guest = values[order], table.column("guest").to_numpy(zero_copy_only=False)[order].astype(bool)
        root = vptree.components(values.view(np.uint64), guest, part if part >= 0 else ~part)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"u": pa.array(values[linked], pa.int64()), "v": pa.array(values[root[linked]], pa.int64())})

    return shards(prints, n_prints, shard_rows, sample_rows).groupBy("part", "shard").applyInArrow(join_shard, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, shard_rows: int = 8192, sample_rows: int = 100_000) -> DataFrame:
    """Per row: the id, its fingerprint (16 hex digits) and component_id, the least id reachable over links of up to 3 bits."""
    hashed = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = materialize(hashed.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct", compact=True)
    stars = star_components(fingerprint_links(distinct, distinct.count(), shard_rows, sample_rows))
    rooted = distinct.join(stars.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = materialize(rooted.join(heads, "root").select("fp", "component_id"), "components", compact=True)
    joined = hashed.join(by_print, "fp")
    return joined.select(F.col(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
