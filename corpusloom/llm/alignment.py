"""Alignment of two tokenizers' tokens over the same bytes (operator 13).

A task tokenises its texts and gives ids and byte ends, nothing else. Column
functions over the end arrays find each side's own ends, those that the other side
lacks (array_except); all others are shared and cut both sides into groups. What the
groups say of their ids, the digest and the pairs, is listed by numpy a stretch of rows
at a time, as a lambda over arrays is interpreted element by element. Every pair inside
a group is a link. An id pair's count is the number of rows that hold it linked,
wherever they are.

Null and empty texts, and texts that either side does not give back byte for byte,
have no tokens. Every row counts by itself, repeated rows too, and ids may be null.
Groups of many tokens give each pair of distinct ids once with its multiplicity, so
a long stretch without a shared end stays small. Texts of any length are tokenised
whole, one at a time. An empty table gives an empty result. Other columns are not
read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.packing import _LONG_GAP, _PLAIN, Encoder
from corpusloom.llm.storage import materialize, ship_package
from corpusloom.llm.token_counts import byte_symbols

#: Pairs of a group that are listed one by one; larger groups list distinct pairs with their multiplicity.
LISTED = 64
#: Most rows of pair counts that are broadcast (some 50 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Tokens of both sides that are worked on and go to the JVM at once, a text more at most.
_TOKENS = 400_000
#: Most rows and bytes of an Arrow batch while tokens go to the workers: a batch of 10,000 rows of token arrays is over 100 MB, in the JVM and again in the worker.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}
_SIDES = [T.StructField(c, T.ArrayType(T.IntegerType(), False), False) for c in ("a_ids", "a_ends", "b_ids", "b_ends")]


class ByteTokens:
    """Ids and byte ends of a byte-level vocabulary; special strings are plain text."""

    class _Plain(Encoder):
        @cached_property
        def library(self):
            from tokenizers import Tokenizer

            found = Tokenizer.from_file(self.path)
            found.encode_special_tokens = True
            return found

        def ids(self, text: str) -> np.ndarray:
            if self.fast is None or not _PLAIN.fullmatch(text) or _LONG_GAP.search(text):
                return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)
            return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int32)

    def __init__(self, path: str):
        self.coder = self._Plain(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {symbol: b for b, symbol in enumerate(byte_symbols())}
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (1 + max([*spec["model"]["vocab"].values(), *added]))
        for token, i in spec["model"]["vocab"].items():
            self.bytes[i] = token.encode() if i in added else bytes(byte[c] for c in token)
        self.sizes = np.array([len(b) for b in self.bytes], np.int32)
        #: Every byte has a token and nothing changes the text, so tokens always join to it.
        self.lossless = spec["normalizer"] is None and all(s in spec["model"]["vocab"] for s in byte)


class PieceTokens:
    """Ids and byte ends of a sentencepiece model, which puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        piece = self.model.id_to_piece
        self.bytes = [bytes([int(piece(i)[3:5], 16)]) if self.model.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self.model.get_piece_size())]
        self.sizes = np.array([len(b) for b in self.bytes], np.int32)


class Sides:
    """Both sides' ids of whole texts, by the libraries, a text at a time."""

    def __init__(self, a: str | None, b: str | None):
        import public_tokenizers

        self.a, self.b = ByteTokens(a or public_tokenizers.path("byte_bpe_50k.json")), PieceTokens(b or public_tokenizers.path("piece_bpe_32k.model"))

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """None on both sides where a side does not give the text back."""
        if text:
            a, b, whole = self.a.coder.ids(" " + text), self.b.model.encode(text, num_threads=1), b" " + text.encode()
            if b"".join(map(self.b.bytes.__getitem__, b)) == whole and (self.a.lossless or b"".join(map(self.a.bytes.__getitem__, a.tolist())) == whole):
                return a, np.array(b, np.int32)
        return np.zeros(0, np.int32), np.zeros(0, np.int32)


@lru_cache(maxsize=2)
def _sides(a: str | None, b: str | None) -> Sides:
    return Sides(a, b)


def tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None) -> DataFrame:
    """Per row: the id, and ids and byte ends of both sides; all empty where either side does not give the text back."""
    ship_package(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], *_SIDES])

    def run(batches):
        sides = _sides(a, b)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                first, held, found = at, 0, ([], [], [], [])
                while at < batch.num_rows and held < _TOKENS:
                    ids = sides.encode(batch.column(1)[at].as_py())
                    for k, side in enumerate((sides.a, sides.b)):
                        found[2 * k].append(ids[k])
                        found[2 * k + 1].append(np.cumsum(side.sizes[ids[k]], dtype=np.int32))
                    at, held = at + 1, held + len(ids[0]) + len(ids[1])
                lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, column)]), pa.int32()), pa.array(np.concatenate(column), pa.int32())) for column in found]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, at - first), *lists], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


#: What follows an id in a row's groups: in its group, after the last id of a, after the last id of b.
_AFTER = (b",", b"|", b";")
_said: list[bytes] = []


def _ids_said(most: int) -> list[bytes]:
    """The ids up to most with what may follow them, at 3 * id + its place in _AFTER; each worker writes them once."""
    for i in range(len(_said) // 3, most + 1):
        _said.extend(b"%d%s" % (i, after) for after in _AFTER)
    return _said


def _values(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values, and where each row's begin, with their end."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy()[at[0] : at[-1]], (at - at[0]).astype(np.int64)


class Groups:
    """The groups of some rows' tokens, one row after another: no group passes a row's end, which both sides share."""

    def __init__(self, batch: pa.RecordBatch):
        self.rows = batch.num_rows
        for s in "ab":
            ids, at = _values(batch.column(f"{s}_ids"))
            ends, own = (self._keys(batch.column(f"{s}_{kind}")) for kind in ("ends", "own"))
            last = np.ones(len(ids), bool)
            last[np.searchsorted(ends, own)] = False
            stop = np.flatnonzero(last) + 1
            start = np.concatenate([np.zeros(1, np.int64), stop])[:-1]
            setattr(self, s, (ids.astype(np.int64), at, last, start, stop))
        #: The first group of each row, and their number.
        self.first = np.searchsorted(self.a[4], self.a[1], "right")
        self.pairs = (self.a[4] - self.a[3]) * (self.b[4] - self.b[3])

    @staticmethod
    def _keys(column: pa.ListArray) -> np.ndarray:
        """Ends that rise over all rows."""
        ends, at = _values(column)
        return ends + (np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at)) << 32)

    def digests(self) -> list[str]:
        (a_ids, a_at, a_last, _, a_stop), (b_ids, b_at, b_last, b_start, _) = self.a, self.b
        of = lambda last: np.cumsum(last) - last
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[np.arange(len(a_ids)) + b_start[of(a_last)]] = 3 * a_ids + a_last
        order[np.arange(len(b_ids)) + a_stop[of(b_last)]] = 3 * b_ids + 2 * b_last
        said, at = _ids_said(int(order.max()) // 3 if len(order) else -1), a_at + b_at
        words = [list(map(said.__getitem__, order[m:n].tolist())) for m, n in zip(at[:-1], at[1:], strict=True)]
        return [hashlib.sha256(b"".join(w)[:-1]).hexdigest() if w else "" for w in words]

    def listed(self, width: int) -> pa.ListArray:
        """The pairs of all groups of at most LISTED pairs."""
        n = np.where(self.pairs > LISTED, 0, self.pairs)
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        k = np.repeat(np.arange(len(n)), n)
        x, y = np.divmod(np.arange(upto[-1]) - upto[k], (self.b[4] - self.b[3])[k])
        pairs = self.a[0][self.a[3][k] + x] * width + self.b[0][self.b[3][k] + y]
        return pa.ListArray.from_arrays(pa.array(upto[self.first], pa.int32()), pa.array(pairs))

    def heavy(self, width: int) -> pa.ListArray:
        """The distinct pairs of larger groups with their multiplicity."""
        rows: list[list[dict]] = [[] for _ in range(self.rows)]
        for g in np.flatnonzero(self.pairs > LISTED):
            (x, n), (y, m) = (np.unique(side[0][side[3][g] : side[4][g]], return_counts=True) for side in (self.a, self.b))
            pairs, times = (x[:, None] * width + y).ravel().tolist(), (n[:, None] * m).ravel().tolist()
            rows[np.searchsorted(self.first, g, "right") - 1] += ({"p": p, "n": t} for p, t in zip(pairs, times, strict=True))
        return pa.array(rows, pa.list_(pa.struct([("p", pa.int64()), ("n", pa.int64())])))


def aligned(sides: DataFrame, width: int) -> DataFrame:
    """sides: rows as tokens() gives them, and more. With n_a, n_b, n_groups, groups_sha256 (of the groups as a1,a2|b1;...), p (a link's ids as a id * width + b id) and heavy (p and n, the links of groups of many)."""
    ship_package(sides.sparkSession)
    size = lambda c: F.size(c).cast("long")
    cut = sides.withColumns({"a_own": F.array_except("a_ends", "b_ends"), "b_own": F.array_except("b_ends", "a_ends")})
    cut = cut.withColumns({"n_a": size("a_ids"), "n_b": size("b_ids"), "n_groups": size("a_ends") - size("a_own")})
    kept = [f for f in cut.schema if f.name not in ("a_ids", "a_ends", "b_ids", "b_ends", "a_own", "b_own")]
    pairs = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in "pn"]), False)
    schema = T.StructType([*kept, T.StructField("groups_sha256", T.StringType(), False), T.StructField("p", T.ArrayType(T.LongType(), False), False), T.StructField("heavy", pairs, False)])

    def run(batches):
        for batch in batches:
            held, at = np.add(*(batch.column(f"{s}_ids").offsets.to_numpy().astype(np.int64) for s in "ab")), 0
            while at < batch.num_rows:
                end = min(batch.num_rows, int(np.searchsorted(held, held[at] + _TOKENS)))
                part = batch.slice(at, max(1, end - at))
                groups, at = Groups(part), at + part.num_rows
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), pa.array(groups.digests(), pa.string()), groups.listed(width), groups.heavy(width)], names=schema.names)

    return cut.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """The session's Arrow batches are at most _BATCHES inside, and as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in _BATCHES}
    try:
        for k, v in _BATCHES.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def held_pairs() -> Column:
    """The pairs that a row holds linked, each once."""
    return F.array_distinct(F.concat("p", F.transform("heavy", lambda s: s["p"])))


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """linked: rows with p and heavy. Each pair with docs, the rows that hold it, and best, whether no pair of the same a id has more."""
    counts = materialize(linked.select(F.explode(held_pairs()).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("docs")), "pair-counts", compact=True)
    counts = counts.withColumn("a_id", F.floor(F.col("p") / width))
    best = counts.groupBy("a_id").agg(F.max("docs").alias("most"))
    return counts.join(best, "a_id").select("p", "docs", (F.col("docs") == F.col("most")).alias("best"))


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str | None = None, b: str | None = None, width: int = 1 << 20, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per row: the id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    a, b: paths of the vocabularies, the installed public ones by default. width:
    over every id of b. n_best: links whose pair no other pair of the same a id
    exceeds in count; count_sum: counts summed over links. Counts go to the rows by
    a broadcast where there are at most broadcast_rows of them, else by a shuffle.
    """
    linked = aligned(tokens(docs, id_col, text_col, a, b), width)
    linked = linked.select(
        F.col(id_col).alias("id"), "n_a", "n_b", "n_groups", "groups_sha256",
        (F.size("p").cast("long") + F.aggregate("heavy", F.lit(0).cast("long"), lambda acc, s: acc + s["n"])).alias("n_links"), "p", "heavy", F.monotonically_increasing_id().alias("row"),
    )
    with small_batches(docs.sparkSession):
        linked = materialize(linked, "linked")
    rated = materialize(pair_counts(linked, width), "rated-pairs", compact=True)
    if rated.count() <= broadcast_rows:
        rated = F.broadcast(rated)
    links = linked.select("row", F.explode("p").alias("p"), F.lit(1).cast("long").alias("n")).unionAll(linked.select("row", F.explode("heavy").alias("h")).select("row", "h.p", "h.n"))
    sums = links.join(rated, "p").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return linked.drop("p", "heavy").join(sums, "row", "left").select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
