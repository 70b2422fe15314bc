"""A Merkle manifest of a dataset by superblock reduction (operator 11).

Rows are leaves, ordered by id inside their group. Leaves are numbered by their
place in a range-partitioned sort and the sizes of the parts before it. Indices
are cut into buckets of fanout ** levels; a task collapses a bucket by that many
levels to one node, and the buckets' nodes are reduced likewise until each group
is one subroot; the subroots, in the order of their groups, are then the leaves of
the top tree. On the way back each bucket's lower proofs are put before the one
proof that its node has got from above. No task sees more than a bucket.

Null groups are a group, the first one; null ids come first; rows of one id are
ordered by their leaves, so equal rows can't be told apart and needn't be. Null
and empty fields hash differently. Texts of any length are hashed whole inside
the JVM and only digests move. A group of one leaf is that leaf; an empty table
gives an empty result. Only the named columns are read, so other names can't clash.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.storage import materialize, release, ship_package
from corpusloom.operators.events import global_positions

FANOUT, LEVELS = 8, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PROOF = "left array<string>, right array<string>, subroot string, root string"


def leaf_hash(*fields: Column) -> Column:
    """The digest of the fields, each as its UTF-8 byte count, a colon and its value, or a dash where it is null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def height(n: int, fanout: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def collapse(nodes: list[str], levels: int, fanout: int) -> list[list[str]]:
    """The nodes, and the levels above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([sha256("".join(below[i : i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)])
    return out


def siblings(levels: list[list[str]], at: int, fanout: int) -> tuple[list[str], list[str]]:
    """What stands left and right of a node in its run, level by level upwards."""
    left, right = [], []
    for nodes in levels[:-1]:
        first = at // fanout * fanout
        left.append("".join(nodes[first:at]))
        right.append("".join(nodes[at + 1 : first + fanout]))
        at //= fanout
    return left, right


def ascend(nodes: DataFrame, fanout: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """nodes: tree, idx from 0, n nodes of the tree, node. Returns the tables of each round from the leaves upwards, and a row for each tree, its root."""
    block, rounds = fanout**levels, []

    def to_root(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values("idx")
        n, at = int(bucket["n"].iloc[0]), int(bucket["idx"].iloc[0]) // block
        top = collapse(bucket["node"].tolist(), min(levels, height(n, fanout)), fanout)[-1]
        return pd.DataFrame({"tree": bucket["tree"].iloc[:1], "idx": [at], "n": [-(-n // block)], "node": top})

    while nodes.filter("n > 1").limit(1).count():
        rounds.append(nodes)
        above = nodes.select("tree", "idx", "n", "node", F.floor(F.col("idx") / block).alias("bucket")).groupBy("tree", "bucket").applyInPandas(to_root, "tree long, idx long, n long, node string")
        nodes = materialize(above, "superblocks", compact=True)
    return rounds, nodes


def descend(rounds: list[DataFrame], above: DataFrame, fanout: int, levels: int, *carried: str) -> DataFrame:
    """The proofs of the lowest round's nodes: tree, idx, node, left, right, subroot, root and the carried string columns.

    above: tree, idx, left, right, subroot and root of the rounds' roots.
    """
    block = fanout**levels

    def prove(bucket: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        bucket, top = bucket.sort_values("idx").reset_index(drop=True), upper.iloc[0]
        tree = collapse(bucket["node"].tolist(), min(levels, height(int(bucket["n"].iloc[0]), fanout)), fanout)
        found = [siblings(tree, at, fanout) for at in range(len(bucket))]
        over = list(top["left"]), list(top["right"])
        more = {"left": [x + over[0] for x, _ in found], "right": [x + over[1] for _, x in found], "subroot": top["subroot"], "root": top["root"]}
        return bucket.drop(columns=["n", "bucket"]).assign(**more)

    for nodes in reversed(rounds):
        extra = [c for c in carried if c in nodes.columns]
        columns = ["tree", "idx", "node", *extra]
        rows = nodes.select("tree", "idx", "node", *extra, "n", F.floor(F.col("idx") / block).alias("bucket")).groupBy("tree", "bucket")
        schema = ", ".join([*(f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in columns), _PROOF])
        above = rows.cogroup(above.withColumnRenamed("idx", "bucket").groupBy("tree", "bucket")).applyInPandas(prove, schema)
    return above


def numbered(leaves: DataFrame) -> DataFrame:
    """leaves: grp, id, node and more. With tree (the place of the group, from 0), idx (the leaf's place there) and n (leaves there)."""
    ordered = leaves.repartitionByRange("grp", "id", "node").sortWithinPartitions("grp", "id", "node")
    ordered = materialize(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ordered = ordered.withColumns({"part": part, "place": place}).drop("at")
    # a row for each part and each group inside it
    sizes = materialize(ordered.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first")), "sizes", compact=True)
    groups = sizes.groupBy("grp").agg(F.sum("rows").alias("n"), F.min("part").alias("opens"))
    groups = global_positions(groups, F.col("opens"), "grp").select("grp", "n", (F.col("position") - 1).alias("tree"))
    earlier = F.coalesce(F.sum("rows").over(Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("shift", earlier - F.col("first")).alias("s").join(groups.alias("g"), F.col("s.grp").eqNullSafe(F.col("g.grp")))
    sizes = sizes.select(F.col("s.grp").alias("in_grp"), F.col("part").alias("in_part"), "shift", "n", "tree")
    found = ordered.join(sizes, (F.col("part") == F.col("in_part")) & F.col("grp").eqNullSafe(F.col("in_grp")))
    return found.withColumn("idx", F.col("place") + F.col("shift")).drop("in_grp", "in_part", "part", "place", "shift")


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...], id_col: str = "doc_id", group_col: str = "lang", claimed: Column | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row: the id, leaf, subroot, root, the proof (left and right, a string of digests for each level from the leaf up) and claimed.

    fields: columns that a leaf covers, in order. claimed: the leaf of what
    someone says the row is, null where nobody says anything; it only passes
    through. fold() tells which root it leads to.
    """
    ship_package(docs.sparkSession)
    says = F.lit(None).cast("string") if claimed is None else claimed
    leaves = materialize(docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), leaf_hash(*map(F.col, fields)).alias("node"), says.alias("claimed")), "leaves")
    # ids pass through pandas as text: nulls would make floats of numbers
    nodes = materialize(numbered(leaves).select("tree", "idx", "n", "node", F.col("id").cast("string").alias("id"), "claimed"), "numbered")
    release(leaves)
    rounds, subroots = ascend(nodes, fanout, levels)
    # the top tree's leaves are the subroots; each keeps its number as its place
    tops, root = ascend(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(subroots.count()).cast("long").alias("n"), "node"), fanout, levels)
    none = F.array().cast("array<string>")
    start = root.select("tree", "idx", none.alias("left"), none.alias("right"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"), "node")
    over = descend(tops, start, fanout, levels).select(F.col("idx").alias("tree"), F.lit(0).cast("long").alias("idx"), "left", "right", F.col("node").alias("subroot"), "root")
    over = materialize(over, "upper-proofs", compact=True)
    if rounds:
        proved = descend(rounds, over, fanout, levels, "id", "claimed")
    else:  # every group is a single leaf
        proved = nodes.join(over.drop("idx"), "tree")
    return proved.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("node").alias("leaf"), "subroot", "root", "left", "right", "claimed")


def fold(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    steps = F.arrays_zip(left.alias("l"), right.alias("r"))
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def proof_text(left: Column, right: Column) -> Column:
    """All siblings, level by level upwards and from left to right."""
    return F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verified_documents(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, and what becomes of them where texts have been lower-cased: every row whose id's CRC-32 is divisible by three."""
    tampered = leaf_hash(*(ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in FIELDS))
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, tampered)
    proved = merkle_manifest(docs, FIELDS, claimed=claimed)
    digests = proved.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("left"), F.col("right")), 256).alias("proof_sha256"), fold(F.coalesce("claimed", "leaf"), F.col("left"), F.col("right")).alias("folded_root"))
    return digests.withColumn("verified", F.col("folded_root") == F.col("root"))


def _levels_sql(key: str, first: str, name: str, levels: int) -> str:
    """SQL of the levels above a table of (key, idx, n, node): each as runs of eight with their nodes in order."""
    out, below = [], first
    for k in range(levels):
        out.append(f"{name}r{k} AS (SELECT {key} AS g, idx // 8 AS run, max(n) AS n, list(node ORDER BY idx) AS nodes FROM {below} GROUP BY ALL)")
        out.append(f"{name}{k} AS (SELECT g AS {key}, run AS idx, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(nodes, '')) ELSE nodes[1] END AS node FROM {name}r{k})")
        below = f"{name}{k}"
    return ",\n".join(out)


def _proofs_sql(name: str, first: str, levels: int, group: str, at: str) -> tuple[str, str]:
    """SQL that carries proof and folded (of the table first) through the levels, and the last table's name."""
    out, below = [], first
    for k in range(levels):
        place = f"(b.{at} // {8**k}) % 8"
        out.append(
            f"{name}p{k} AS (SELECT b.* REPLACE (CASE WHEN r.n > 1 THEN b.proof || array_to_string(list_concat(r.nodes[:{place}], r.nodes[{place} + 2:]), '') ELSE b.proof END AS proof, "
            f"CASE WHEN r.n > 1 THEN sha256(array_to_string(r.nodes[:{place}], '') || b.folded || array_to_string(r.nodes[{place} + 2:], '')) ELSE b.folded END AS folded) "
            f"FROM {below} b JOIN {name}r{k} r ON r.g IS NOT DISTINCT FROM {group} AND r.run = b.{at} // {8 ** (k + 1)})"
        )
        below = f"{name}p{k}"
    return ",\n".join(out), below


def _manifest_sql(levels: int = 7, top: int = 2) -> str:
    """Up to 8 ** levels leaves a group and 8 ** top groups."""
    field = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(text if c == "text" else field(c) for c in FIELDS) + ")"
    crc = "xor(list_reduce([ord(c) FOR c IN string_split(doc_id::VARCHAR, '')], lambda a, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(a, b)), 4294967295::BIGINT), 4294967295)"
    lower = f"coalesce(octet_length(encode(text)) || ':' || translate(text, '{_UPPER}', '{_LOWER}'), '-')"
    lower_part, last = _proofs_sql("l", "start", levels, "b.lang", "idx")
    upper_part, final = _proofs_sql("u", "moved", top, "0", "rank")
    return f"""
WITH h AS (SELECT doc_id, lang, {leaf(field("text"))} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS claimed FROM documents),
i AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM h),
b AS (SELECT lang, idx, n, leaf AS node FROM i),
{_levels_sql("lang", "b", "l", levels)},
s AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank FROM l{levels - 1}),
t AS (SELECT 0 AS z, rank AS idx, (SELECT count(*) FROM s) AS n, subroot AS node FROM s),
{_levels_sql("z", "t", "u", top)},
start AS (SELECT doc_id, lang, leaf, idx, '' AS proof, coalesce(claimed, leaf) AS folded FROM i),
{lower_part},
moved AS (SELECT b.*, s.subroot, s.rank FROM {last} b JOIN s ON s.lang IS NOT DISTINCT FROM b.lang),
{upper_part}
SELECT doc_id, leaf, subroot, u{top - 1}.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u{top - 1}.node AS verified FROM {final}, u{top - 1}
"""


MANIFEST_SQL = _manifest_sql()
