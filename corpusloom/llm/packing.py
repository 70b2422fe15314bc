"""Packing token sequences by best-fit decreasing (operator 10).

A document's ids, with the end id after them, are first cut into full windows;
those are sequences of their own. The remainders, one a document at most, are
dealt into groups of bounded size by their row numbers, whatever they hold, and
each group is packed by itself: longest first, into the open window with the
least room that still holds the piece. A segment tree over remaining capacities
finds that window. Of equal lengths the smaller id goes first, null ids last, then
the lower row number.

Null text counts as empty: its only id is the end id. Repeated rows are packed
each by itself. Texts of any length are encoded whole, one at a time. Other
columns are neither read nor returned. An empty table gives an empty result.
"""

from __future__ import annotations

import importlib.util
import json
import re
import struct
import zlib
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.native import free_name
from corpusloom.llm.storage import materialize, ship_package
from corpusloom.llm.token_counts import PRETOKEN, byte_symbols, default_vocabulary

#: Rows of the table per packing group: large enough for little padding, small enough for one task.
GROUP_ROWS = 40_000


#: Texts of these characters only are pre-tokenized alike by both libraries, whatever Unicode version they carry.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-\u024f\u2010-\u2027\u20ac]*")
_LONG_GAP = re.compile(r"\s{500}")


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, as the tokenizers library gives them.

    The library encodes texts outside the plain character range. For the rest, and
    where the file's ids follow its merge order, the same ranks are run by
    tiktoken, which is four times as fast; tests hold the two against each other.
    """

    def __init__(self, path: str):
        self.path, self.fast, self.special = path, None, set()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        order = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        byte = {symbol: b for b, symbol in enumerate(byte_symbols())}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} and spec["normalizer"] is None
        if importlib.util.find_spec("tiktoken") and plain and all(a < b for a, b in zip(order, order[1:], strict=False)) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            import tiktoken

            ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in added}
            self.fast, self.special = tiktoken.Encoding("ranks", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens=added), set(added)

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def by_library(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if self.fast is None or not _PLAIN.fullmatch(text) or _LONG_GAP.search(text):
            return self.by_library(text)
        return self.fast.encode_to_numpy(text, allowed_special=self.special).astype("<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class CapacityTree:
    """Open windows by remaining capacity, with a segment tree over the capacities in use."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.used = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, sequence: int) -> None:
        if capacity <= 0:
            return
        self.open[capacity].append(sequence)
        node = capacity + self.leaves
        while node and not self.used[node]:
            self.used[node] = 1
            node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the least capacity of at least length."""
        node = length + self.leaves
        if not self.used[node]:
            while node > 1 and not (node & 1 == 0 and self.used[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.used[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        sequence = self.open[capacity].pop()
        if not self.open[capacity]:
            self.used[node] = 0
            node >>= 1
            while node:
                self.used[node] = self.used[2 * node] | self.used[2 * node + 1]
                node >>= 1
        return capacity, sequence


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """For lengths in falling order: each one's sequence number and offset there."""
    tree, out, n = CapacityTree(window), [], 0
    for length in lengths:
        found = tree.tightest(length)
        if found is None:
            found, n = (window, n), n + 1
        capacity, sequence = found
        out.append((sequence, window - capacity))
        tree.put(capacity - length, sequence)
    return out


def token_pieces(docs: DataFrame, id_col: str, text_col: str, window: int, vocabulary: str | None, end_id: int) -> DataFrame:
    """One row for each window-sized cut of each document: id, start, length, ids_crc32, doc_tokens."""
    ship_package(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], *(T.StructField(c, T.LongType(), False) for c in ("start", "length", "ids_crc32", "doc_tokens"))])
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        coder = encoder(vocabulary or default_vocabulary())
        for batch in batches:
            rows, starts, lengths, sums, totals = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = memoryview(coder.encode(text.as_py() or "") + end)
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(total)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(cut, schema)


def dealt_rows(rest: DataFrame, row: str, groups: int) -> DataFrame:
    """rest with ``__group``, by a hash of the stored row number: repeated rows are spread like any others."""
    return rest.withColumn("__group", F.pmod(F.xxhash64(F.col(row)), F.lit(groups)))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 1024, vocabulary: str | None = None, end_id: int = 0, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pack every document's ids into sequences of at most window tokens.

    Returns a row for each piece: the id column, start, length, ids_crc32,
    doc_tokens, sequence_id and offset. Sequence ids are unique but not dense:
    full windows have odd ones, packed ones even ones.
    """
    row = free_name(docs.select(id_col), "row")
    pieces = token_pieces(docs, id_col, text_col, window, vocabulary, end_id)
    columns = pieces.schema.fields
    pieces = materialize(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == window
    alone = pieces.filter(full).withColumns({"sequence_id": F.col(row) * 2 + 1, "offset": F.lit(0).cast("long")}).drop(row)
    rest = pieces.filter(~full)
    groups = max(1, -(-rest.count() // group_rows))
    schema = T.StructType([*columns, T.StructField("sequence_id", T.LongType(), False), T.StructField("offset", T.LongType(), False)])

    def pack(table: pa.Table) -> pa.Table:
        group = table.column("__group")[0].as_py()
        table = table.drop_columns("__group").sort_by([("length", "descending"), (id_col, "ascending"), (row, "ascending")]).drop_columns(row)
        placed = best_fit_decreasing(table.column("length").to_pylist(), window)
        table = table.append_column("sequence_id", pa.array([(group << 33 | s) * 2 for s, _ in placed], pa.int64()))
        return table.append_column("offset", pa.array([o for _, o in placed], pa.int64())).cast(pa.schema([(f.name, table.schema.field(f.name).type if f.name in table.schema.names else pa.int64()) for f in schema.fields]))

    packed = dealt_rows(rest, row, groups).groupBy("__group").applyInArrow(pack, schema)
    return alone.unionByName(packed)
