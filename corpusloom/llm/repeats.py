"""Removal of repeated passages by a distributed sort of suffixes (operator 12).

A byte goes if a string of ``WINDOW`` bytes over it also starts in a document of a
smaller id. Texts are packed into blocks of bounded size, which are written once and
whose rows are never parted again:

1. Every block gives the hashes of its anchors (see suffixes.py), each once. In
   buckets of hashes those of a single text are told apart; the rest go back.
2. Every block sorts its suffixes under the remaining anchors into one run, each
   distinct suffix once with the least and the largest id that holds it, and sends it
   front-coded in ranges of keys.
3. A range merges its runs by a loser tree that never compares a known prefix again.
   Equal suffixes give the least id of all; suffixes of one anchor that differ (edges
   of passages) are compared window by window. What a smaller id covers goes back to
   the blocks as pieces of their runs.
4. Every block removes what is covered.

An anchor of more than ``hot`` different suffixes is not a key: its windows are, each under its
own hash, so no range grows with one passage. A run holds a suffix once however many
documents repeat it. Nothing is gathered on the driver but two numbers.

Null and empty texts have no bytes and nothing to remove. Equal ids never remove from
each other; a null id counts as larger than any other. Copies in one block are looked
at once. Texts of any length are handled whole, a long one in a block of its own, and
bytes of any value may occur. An empty table gives an empty result. Other columns are
not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm import suffixes as sx
from corpusloom.llm.storage import bucketed, materialize, ship_package

#: Bytes of text in a block, suffixes in a bucket of anchors, bytes of text a range of keys, different suffixes of an anchor that make it hot.
BLOCK_BYTES, BUCKET_ROWS, RANGE_BYTES, HOT = 4 << 20, 400_000, 4 << 20, 8192
_UPPER = np.uint64(((1 << 48) - 1) << 16)
_NO_ID = np.iinfo(np.int64).max


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as stream:
        return stream.read_next_batch()


def _narrow(keys: np.ndarray) -> bytes:
    """The upper 48 bits of each key. More would tell a little more apart, but only ever which suffixes need no sorting."""
    return (keys >> np.uint64(32)).astype(np.uint32).tobytes() + (keys >> np.uint64(16)).astype(np.uint16).tobytes()


def _wide(data: bytes) -> np.ndarray:
    n = len(data) // 6
    return (np.frombuffer(data[: 4 * n], np.uint32).astype(np.uint64) << np.uint64(16)) | np.frombuffer(data[4 * n :], np.uint16).astype(np.uint64)


def _small(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _full(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


class Block:
    """The distinct texts of a block, and which of them each row has."""

    def __init__(self, texts: bytes, rows: bytes):
        column, self.rows = _unpacked(texts).column(0), _unpacked(rows)
        sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[: len(column) + 1])
        self.ends = np.cumsum(sizes)
        self.buffer = (column.buffers()[2].to_pybytes()[: int(self.ends[-1])] if len(sizes) else b"") + sx.PAD
        self.number = self.rows.column("number").to_numpy()
        # nulls count as the largest id
        self.ids = self.rows.column("id").cast(pa.int64()).fill_null(_NO_ID).to_numpy()
        self.least, self.most = np.full(len(sizes), _NO_ID), np.full(len(sizes), -_NO_ID)
        np.minimum.at(self.least, self.number, self.ids)
        np.maximum.at(self.most, self.number, self.ids)

    def suffixes(self) -> sx.Suffixes:
        return sx.suffixes(self.buffer, self.ends)

    def shared(self, keys: np.ndarray, hot: np.ndarray) -> sx.Suffixes:
        """The suffixes under some anchors; keys in order. Under hot ones each window by itself."""
        every = self.suffixes()
        short = every.key >> np.uint64(16)
        at = np.searchsorted(keys, short)
        at[at == len(keys)] = 0
        kept = keys[at] == short if len(keys) else np.zeros(len(at), bool)
        burning = kept & hot[at] if len(keys) else kept
        plain = sx.Suffixes(*(x[kept & ~burning] for x in every))
        return sx.Suffixes(*map(np.concatenate, zip(plain, sx.spread_windows(self.buffer, sx.Suffixes(*(x[burning] for x in every))), strict=True)))


def packed_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Rows of block, bytes, texts and rows: as many rows of docs as have about block_bytes of text."""
    ship_package(docs.sparkSession)

    def pack(batches):
        task, count = TaskContext.get().partitionId() << 33, 0
        seen: dict[str, int] = {}
        ids, numbers, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seen, ids, numbers, held, count
            texts = pa.record_batch([pa.array(map(str.encode, seen), pa.large_binary())], ["text"])
            rows = pa.record_batch([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32())], ["id", "number"])
            out = pa.record_batch([pa.array([task + count], pa.int64()), pa.array([held], pa.int64()), pa.array([_packed(texts)], pa.binary()), pa.array([_packed(rows)], pa.binary())], ["block", "bytes", "texts", "rows"])
            seen, ids, numbers, held, count = {}, [], [], 0, count + 1
            return out

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                if text not in seen:
                    size = len(text.encode())
                    if held and held + size > block_bytes:
                        yield flush()
                    seen[text], held = len(seen), held + size
                ids.append(i)
                numbers.append(seen[text])
                if len(ids) >= 500_000:
                    yield flush()
        if ids:
            yield flush()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").alias("__text")).mapInArrow(pack, "block long, bytes long, texts binary, rows binary")


def anchors(blocks: DataFrame, buckets: int) -> DataFrame:
    """A row for each block and bucket of hashes: hashes, whether two texts of the block hold each, and how many different suffixes it has there (65,535 at most)."""
    edges = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)

    def run(batches):
        for block, found in _blocks(batches):
            s = found.suffixes()
            key = s.key & _UPPER
            order = np.argsort(key, kind="stable")
            key, text = key[order], s.text[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            last = np.concatenate([first[1:], [len(key)]]).astype(np.int64) - 1 if len(key) else first
            several = (text[first] != text[last]).astype(np.uint8)
            # suffixes of one anchor are alike if their first and last windows are
            count, often = np.ones(len(first), np.int64), np.flatnonzero(last > first)
            at = np.repeat(first[often], (last - first + 1)[often])
            at += np.arange(len(at)) - np.repeat(np.cumsum((last - first + 1)[often]) - (last - first + 1)[often], (last - first + 1)[often])
            start, group = s.start[order[at]], np.repeat(often, (last - first + 1)[often])
            look = sx.window_keys(found.buffer, start) ^ (sx.window_keys(found.buffer, start + s.windows[order[at]] - 1) << np.uint64(1))
            by_look = np.lexsort((look, group))
            group, look = group[by_look], look[by_look]
            np.add.at(count, group[1:][(group[1:] == group[:-1]) & (look[1:] != look[:-1])], 1)
            count, key = np.minimum(count, 65_535).astype(np.uint16), key[first]
            cuts = [0, *np.searchsorted(key, edges).tolist(), len(key)]
            yield from _rows(block, [(b, (_narrow(key[x:y]), several[x:y].tobytes(), count[x:y].tobytes())) for b, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y], ("bucket", "hashes", "several", "counts"))

    return blocks.select("block", "texts", "rows").mapInArrow(run, "block long, bucket long, hashes binary, several binary, counts binary")


def _blocks(batches) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        for block, texts, rows in zip(*(batch.column(c) for c in ("block", "texts", "rows")), strict=True):
            yield block.as_py(), Block(texts.as_py(), rows.as_py())


def _rows(block: int, rows: list[tuple[int, tuple[bytes, ...]]], names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 1000):
        part = rows[at : at + 1000]
        yield pa.record_batch([pa.array([block] * len(part), pa.int64()), pa.array([k for k, _ in part], pa.int64()), *(pa.array(c, pa.binary()) for c in zip(*(v for _, v in part), strict=True))], ["block", *names])


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def shared_anchors(found: DataFrame, hot: int) -> DataFrame:
    """Of each block the hashes that two texts or more hold anywhere (kind 0: data the hashes, more whether each is hot)."""

    def meet(table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        lists = [_wide(h) for h in table.column("hashes").to_pylist()]
        hashes, several, counts = np.concatenate(lists), _joined(table.column("several"), np.uint8), _joined(table.column("counts"), np.uint16)
        of = np.repeat(np.arange(len(block)), [len(h) for h in lists])
        order = np.argsort(hashes, kind="stable")
        first = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
        group, opens = np.cumsum(first) - 1, np.flatnonzero(first)
        size, inside = np.diff(np.concatenate([opens, [len(order)]])), np.maximum.reduceat(several[order], opens)
        weight = np.add.reduceat(counts[order].astype(np.int64), opens)
        kept = ((size > 1) | (inside > 0))[group]
        at, burning = order[kept], (weight > hot)[group][kept]
        by_row = np.argsort(of[at], kind="stable")
        at, burning = at[by_row], burning[by_row].astype(np.uint8)
        cuts = np.searchsorted(of[at], np.arange(len(block) + 1))
        rows = [(int(block[k]), _narrow(hashes[at[x:y]] << np.uint64(16)), burning[x:y].tobytes()) for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y]
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([0] * len(rows), pa.int32()), "data": pa.array([r[1] for r in rows], pa.binary()), "more": pa.array([r[2] for r in rows], pa.binary())})

    return found.groupBy("bucket").applyInArrow(meet, "block long, kind int, data binary, more binary")


def _told(notes) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of a block that others share, in order, and which are hot; notes: its rows of kind 0."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(_wide(n["data"]) for n in notes)])
    order = np.argsort(keys)
    return keys[order], np.frombuffer(b"".join(n["more"] for n in notes), np.uint8)[order].astype(bool)


def with_notes(blocks: DataFrame, notes: DataFrame) -> DataFrame:
    """blocks with what is said of each; blocks of which nothing is said stay."""
    said = notes.groupBy("block").agg(F.collect_list(F.struct("kind", "data", "more")).alias("notes"))
    return blocks.select("block", "texts", "rows").join(said, "block", "left")


def _noted(batches) -> Iterator[tuple[int, Block, list]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            for block, found in _blocks([row]):
                yield block, found, row.column("notes")[0].as_py() or []


def runs(blocks: DataFrame, notes: DataFrame, ranges: int) -> DataFrame:
    """A row for each block and range of keys: a front-coded run of distinct suffixes, the place of its first one, and the least and largest id of each."""
    edges = [((k << 64) // ranges).to_bytes(8) for k in range(1, ranges)]

    def run(batches):
        from bisect import bisect_left

        for block, found, said in _noted(batches):
            s = found.shared(*_told(said))
            distinct, place = sx.sorted_run(found.buffer, s)
            least, most = np.full(len(distinct), _NO_ID), np.full(len(distinct), -_NO_ID)
            np.minimum.at(least, place, found.least[s.text])
            np.maximum.at(most, place, found.most[s.text])
            shared = sx.common_prefixes(distinct)
            cuts = [0, *(bisect_left(distinct, e) for e in edges), len(distinct)]
            yield from _rows(block, [(r, _sent(x, sx.front_coded(distinct[x:y], shared[x:y]), least[x:y], most[x:y])) for r, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if x < y], ("range", "first", "shared", "sizes", "rest", "least", "most"))

    return with_notes(blocks, notes).mapInArrow(run, "block long, range long, first binary, shared binary, sizes binary, rest binary, least binary, most binary")


def _sent(first: int, coded: tuple[bytes, bytes, bytes], least: np.ndarray, most: np.ndarray) -> tuple[bytes, ...]:
    shared, sizes, rest = coded
    return first.to_bytes(8), shared, sizes, _small(rest), _small(least.tobytes()), _small((most - least).tobytes())


def covered(sent: DataFrame, at_once: int = 200_000) -> DataFrame:
    """What smaller ids cover, by block (kind 1): data has the places of suffixes in its run, more the first window, the windows and the least id of each piece."""

    def merge(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).to_pylist()
        lists = [sx.decoded(shared, sizes, _full(rest, sum(sizes))) for shared, sizes, rest in zip(column("shared"), column("sizes"), column("rest"), strict=True)]
        ids = lambda c: np.frombuffer(b"".join(_full(x, 8 * len(run)) for x, run in zip(column(c), lists, strict=True)), np.int64)
        order, common = sx.merged(lists, column("shared"))
        run = np.array(order, np.int64)
        nth = np.empty(len(run), np.int64)  # its place in its run
        opens = np.cumsum([0, *map(len, lists)])[:-1]
        by_run = np.argsort(run, kind="stable")
        nth[by_run] = np.arange(len(run)) - opens[run[by_run]]
        flat = opens[run] + nth
        least = ids("least")[flat]
        most = least + ids("most")[flat]
        length = np.fromiter((len(lists[r][k]) for r, k in zip(order, nth.tolist(), strict=True)), np.int64, len(run))
        common = np.array(common)
        new = np.concatenate([[True], (common[1:] < length[1:]) | (length[1:] != length[:-1])])
        which, heads = np.cumsum(new) - 1, np.flatnonzero(new)
        smallest = np.minimum.reduceat(least, heads)
        anchor = np.concatenate([[True], common[heads][1:] < 8])  # a new key among the distinct suffixes
        alone = np.diff(np.concatenate([np.flatnonzero(anchor), [len(heads)]]))[np.cumsum(anchor) - 1] == 1
        windows = length[heads] - 8 - sx.WINDOW + 1
        # pieces of equal least ids: suffix, first window, windows, least id
        pieces = [(np.flatnonzero(alone), np.zeros(alone.sum(), np.int64), windows[alone], smallest[alone])]
        mixed = np.flatnonzero(~alone)
        if len(mixed):
            # whole keys at a time, of about at_once windows
            key = np.cumsum(anchor)[mixed]
            total = np.cumsum(windows[mixed])
            part = total // at_once
            part = np.maximum.accumulate(part[np.searchsorted(key, key)])
            for p in np.unique(part):
                chosen = mixed[part == p]
                found = sx.window_minima([lists[run[heads[d]]][nth[heads[d]]] for d in chosen], smallest[chosen])
                of, values = np.repeat(chosen, windows[chosen]), np.concatenate(found)
                at = np.concatenate([np.arange(len(v)) for v in found])
                cut = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (values[1:] != values[:-1])]))
                pieces.append((of[cut], at[cut], np.diff(np.concatenate([cut, [len(of)]])), values[cut]))
        suffix, start, count, value = map(np.concatenate, zip(*pieces, strict=True))
        by_suffix = np.argsort(suffix, kind="stable")
        suffix, start, count, value = suffix[by_suffix], start[by_suffix], count[by_suffix], value[by_suffix]
        has = np.bincount(suffix, minlength=len(heads))
        first_piece = np.cumsum(has) - has
        # every run's entry meets the pieces of its suffix
        entry = np.repeat(np.arange(len(run)), has[which])
        piece = first_piece[which][entry] + np.arange(len(entry)) - np.repeat(np.cumsum(has[which]) - has[which], has[which])
        needed = value[piece] < most[entry]
        entry, piece = entry[needed], piece[needed]
        firsts = np.array([int.from_bytes(x) for x in column("first")], np.int64)
        rows = []
        by_run = np.argsort(run[entry], kind="stable")
        cuts = np.searchsorted(run[entry][by_run], np.arange(len(lists) + 1))
        for r, block in enumerate(column("block")):
            e, p = entry[by_run[cuts[r] : cuts[r + 1]]], piece[by_run[cuts[r] : cuts[r + 1]]]
            if len(e):
                rows.append((block, (firsts[r] + nth[e]).tobytes(), start[p].astype(np.uint8).tobytes() + count[p].astype(np.uint8).tobytes() + value[p].tobytes()))
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([1] * len(rows), pa.int32()), "data": pa.array([r[1] for r in rows], pa.binary()), "more": pa.array([r[2] for r in rows], pa.binary())})

    return sent.groupBy("range").applyInArrow(merge, "block long, kind int, data binary, more binary")


def _mask(found: Block, said: list) -> np.ndarray:
    """Which bytes of a block's texts smaller ids cover, for each text as its least id has it."""
    s = found.shared(*_told([n for n in said if n["kind"] == 0]))
    _, place = sx.sorted_run(found.buffer, s)
    total = int(found.ends[-1]) if len(found.ends) else 0
    begins, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    occurrence = np.argsort(place, kind="stable")
    of = place[occurrence]
    for note in (n for n in said if n["kind"] == 1):
        at, n = np.frombuffer(note["data"], np.int64), len(note["data"]) // 8
        start, count = np.frombuffer(note["more"][:n], np.uint8).astype(np.int64), np.frombuffer(note["more"][n : 2 * n], np.uint8).astype(np.int64)
        value = np.frombuffer(note["more"][2 * n :], np.int64)
        low, high = np.searchsorted(of, at), np.searchsorted(of, at, side="right")
        k = np.repeat(np.arange(n), high - low)
        which = occurrence[low[k] + np.arange(len(k)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]
        k, which = (x[value[k] < found.least[s.text[which]]] for x in (k, which))
        begin = s.start[which] + start[k]
        begins.append(begin)
        ends.append(begin + count[k] + sx.WINDOW - 1)
    opened = np.zeros(total + 1, np.int32)
    np.add.at(opened, np.concatenate(begins), 1)
    np.subtract.at(opened, np.concatenate(ends), 1)
    return np.cumsum(opened[:total]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, bucket_rows: int = BUCKET_ROWS, range_bytes: int = RANGE_BYTES, hot: int = HOT) -> DataFrame:
    """Per row: the id, n_bytes, starts and ends of the removed runs of bytes, and kept, the remaining bytes. The id must be integral."""
    kind = docs.schema[id_col].dataType
    blocks = bucketed(packed_blocks(docs, id_col, text_col, block_bytes), "block", "blocks")
    total = blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    # an anchor stands for some 14 windows
    notes = materialize(shared_anchors(anchors(blocks, max(1, total // (14 * bucket_rows))), hot), "shared", compact=True)
    pieces = covered(runs(blocks, notes, max(1, total // range_bytes)))
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("n_bytes", T.LongType(), False), *(T.StructField(c, T.ArrayType(T.LongType(), False), False) for c in ("starts", "ends")), T.StructField("kept", T.BinaryType(), False)])

    def apply(batches):
        for _, found, said in _noted(batches):
            gone, opens = _mask(found, said), np.concatenate([[0], found.ends])
            whole = memoryview(found.buffer)
            ids, results, held = [], [], 0
            for i, own, number in zip(found.rows.column("id").to_pylist(), found.ids.tolist(), found.number.tolist(), strict=True):
                a, b = int(opens[number]), int(opens[number + 1])
                if own > found.least[number] and b - a >= sx.WINDOW:  # a copy of a text that this block has under a smaller id
                    spans = np.array([0, b - a])
                else:
                    inside = gone[a:b]
                    spans = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))) if inside.any() else np.zeros(0, np.int64)
                x, y = spans[0::2].tolist(), spans[1::2].tolist()
                kept = b"".join(whole[a + p : a + q] for p, q in zip([0, *y], [*x, b - a], strict=True))
                ids.append(i)
                results.append((b - a, x, y, kept))
                held += len(kept) + 200
                if held > 4 << 20:
                    yield _result(schema, ids, results)
                    ids, results, held = [], [], 0
            if ids:
                yield _result(schema, ids, results)

    done = with_notes(blocks, notes.unionByName(pieces)).mapInArrow(apply, schema)
    return done.withColumn(id_col, F.col(id_col).cast(kind))


def _result(schema: T.StructType, ids: list, results: list[tuple]) -> pa.RecordBatch:
    n, x, y, kept = zip(*results, strict=True)
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(x, pa.list_(pa.int64())), pa.array(y, pa.list_(pa.int64())), pa.array(kept, pa.binary())], schema.names)
