"""ISO media containers as columns (operator 7).

Payloads are stored losslessly as samples of a one-track file: ftyp, moov with
its sample tables, and mdat. The reader walks the nested boxes and decodes each
track's own sample tables (stsd, mdhd, stts, stss, stsz, stsc, stco), which give
codec, duration and keyframe byte ranges without touching the payload bytes. Of a
file with several tracks each is a ``Track`` of its own; features are those of
the first.

Null and empty texts are an empty payload, which still pads to one full unit.
Texts of any length are stored whole; a file is held in memory one at a time, and
one beyond 4 GB gets 64-bit sizes. Equal texts and repeated rows give equal
values, a row each; there are no ties. An empty table gives an empty result.
Columns other than id and text are neither read nor returned, so their names
can't clash.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.storage import materialize, ship_package

UNIT = 64
#: Payload bytes of a sample, and samples from one keyframe to the next.
SAMPLE, KEY_EVERY = 1024, 8
TIMESCALE = 8000
_CONTAINERS = frozenset((b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta"))
_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def full_box(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def pad(data: bytes) -> bytes:
    """Bytes 0 up to a positive multiple of the unit."""
    return data + bytes(-len(data) % UNIT or (0 if data else UNIT))


def write_container(payload: bytes) -> bytes:
    """A file whose single audio track holds the payload as 8-bit samples."""
    sizes = [min(SAMPLE, len(payload) - at) for at in range(0, len(payload), SAMPLE)]
    full, tail = divmod(len(payload), SAMPLE)
    runs = [(full, SAMPLE)] * bool(full) + [(1, tail)] * bool(tail)
    keys = range(1, len(sizes) + 1, KEY_EVERY)
    duration = len(payload)
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, TIMESCALE << 16))

    def moov(offset: int) -> bytes:
        table = box(
            b"stbl",
            full_box(b"stsd", struct.pack(">I", 1), entry),
            full_box(b"stts", struct.pack(">I", len(runs)), *(struct.pack(">II", *r) for r in runs)),
            full_box(b"stss", struct.pack(f">{len(keys) + 1}I", len(keys), *keys)),
            full_box(b"stsc", struct.pack(">IIII", 1, 1, len(sizes), 1)),
            full_box(b"stsz", struct.pack(f">{len(sizes) + 2}I", 0, len(sizes), *sizes)),
            full_box(b"co64", struct.pack(">IQ", 1, offset)),
        )
        media = box(
            b"mdia",
            full_box(b"mdhd", struct.pack(">QQIQHH", 0, 0, TIMESCALE, duration, 0x55C4, 0), version=1),
            full_box(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"text payload\0"),
            box(b"minf", full_box(b"smhd", bytes(4)), box(b"dinf", full_box(b"dref", struct.pack(">I", 1), full_box(b"url ", flags=1))), table),
        )
        head = full_box(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, duration), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), _MATRIX, bytes(8), version=1, flags=3)
        movie = full_box(b"mvhd", struct.pack(">QQIQIH", 0, 0, TIMESCALE, duration, 0x10000, 0x100), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2), version=1)
        return box(b"moov", movie, box(b"trak", head, media))

    brand = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    wide = len(payload) + 8 >= 1 << 32
    lead = struct.pack(">I4sQ", 1, b"mdat", len(payload) + 16) if wide else struct.pack(">I4s", len(payload) + 8, b"mdat")
    start = len(brand) + len(moov(0)) + len(lead)  # the box's size does not depend on the offset
    return b"".join((brand, moov(start), lead, payload))


def walk(data: memoryview, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """Every box with its path and the byte range of its body; damaged sizes are errors."""
    end = len(data) if end is None else end
    at = start
    while at < end:
        if end - at < 8:
            raise ValueError(f"cut box header at byte {at}")
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise ValueError(f"box {kind!r} at byte {at} overruns its parent")
        yield (*path, kind), at + head, at + size
        if kind in _CONTAINERS:
            yield from walk(data, at + head, at + size, (*path, kind))
        at += size


def tracks(container: bytes) -> list[Track]:
    """The tracks of a file in order, each with the tables inside its own box."""
    data, found, end = memoryview(container), [], 0
    for path, a, b in walk(data):
        if path[-1] == b"trak":
            found.append({})
            end = b
        elif found and a < end and path[-1] not in found[-1]:
            found[-1][path[-1]] = (a, b)
    return [Track(data, tables) for tables in found]


class Track:
    """What the sample tables of one track say; tables: the byte range of each box's body."""

    def __init__(self, data: memoryview, tables: dict[bytes, tuple[int, int]]):
        self.data = data
        at = lambda kind: tables[kind][0] + 4  # noqa: E731  past version and flags
        self.codec = bytes(data[at(b"stsd") + 8 : at(b"stsd") + 12]).decode("latin-1").strip()
        a = at(b"mdhd")
        self.timescale, self.duration = struct.unpack_from(">IQ", data, a + 16) if data[a - 4] else struct.unpack_from(">II", data, a + 8)
        runs = self.numbers(at(b"stts"), 2)
        self.ticks = sum(n * d for n, d in zip(runs[::2], runs[1::2], strict=True))
        a = at(b"stsz")
        same, n = struct.unpack_from(">II", data, a)
        self.sizes = [same] * n if same else list(struct.unpack_from(f">{n}I", data, a + 8))
        chunks = self.numbers(at(b"co64"), 1, "Q") if b"co64" in tables else self.numbers(at(b"stco"), 1)
        spans = self.numbers(at(b"stsc"), 3)
        firsts, counts = (*spans[::3], len(chunks) + 1), spans[1::3]
        self.offsets: list[int] = []
        for k, per_chunk in enumerate(counts):
            for offset in chunks[firsts[k] - 1 : firsts[k + 1] - 1]:
                for size in self.sizes[len(self.offsets) : len(self.offsets) + per_chunk]:
                    self.offsets.append(offset)
                    offset += size
        self.keys = list(self.numbers(at(b"stss"), 1)) if b"stss" in tables else list(range(1, len(self.sizes) + 1))

    def numbers(self, at: int, width: int, kind: str = "I") -> tuple[int, ...]:
        """A table's entries of width numbers each, after their count."""
        n = struct.unpack_from(">I", self.data, at)[0]
        return struct.unpack_from(f">{width * n}{kind}", self.data, at + 4)

    def key_ranges(self) -> list[tuple[int, int]]:
        """Byte range in the file of each keyframe, end exclusive."""
        return [(self.offsets[k - 1], self.offsets[k - 1] + self.sizes[k - 1]) for k in self.keys]

    def payload(self) -> bytes:
        """The samples' bytes in order; only for checking, features never need it."""
        if not self.sizes:
            return b""
        lead, size = self.offsets[0], sum(self.sizes)
        if all(a + n == b for a, n, b in zip(self.offsets, self.sizes, self.offsets[1:], strict=False)):
            return bytes(self.data[lead : lead + size])
        return b"".join(bytes(self.data[a : a + n]) for a, n in zip(self.offsets, self.sizes, strict=True))


def feature(track: Track) -> str:
    ranges = ",".join(f"{a}-{b}" for a, b in track.key_ranges())
    return f"codec={track.codec};timescale={track.timescale};duration={track.duration};ticks={track.ticks};samples={len(track.sizes)};keyframes={ranges}"


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The media table: id, n_bytes of the text, and the container as a binary column, written to the shared folder."""
    ship_package(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def store(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = [(t or "").encode("utf-8") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(d) for d in data], pa.int64()), pa.array([write_container(pad(d)) for d in data], pa.binary())], names=schema.names)

    return materialize(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(store, schema), "media")


def media_features(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per stored file: codec, duration and keyframe ranges, with checks of the payload read back."""
    ship_package(media.sparkSession)
    fields = [("n_bytes", T.LongType()), ("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]
    schema = T.StructType([media.schema[id_col], *(T.StructField(*f) for f in fields)])

    def read(batches):
        for batch in batches:
            rows = []
            for n, stored in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = stored.as_py()
                track = tracks(data)[0]
                payload = track.payload()
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(), feature(track)))
            columns = list(zip(*rows, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string() if isinstance(k, T.StringType) else pa.int64()) for c, (_, k) in zip(columns, fields, strict=True))], names=schema.names)

    return media.select(id_col, "n_bytes", "media").mapInArrow(read, schema)
