"""Offset-preserving segmentation, greedy blocks and overlapping segments.

Each operator makes one pass over the chapters' texts in Arrow batches and gives
flat rows, in time in proportion to a text's length: packing is a fold with state,
which array expressions can only do by copying their result at every step. No unit
is shuffled to find its neighbours, and no row carries its chapter's text. Offsets
are code points, end exclusive, and always cut the unit's text out of the chapter
again.

Null and empty texts have no units. Chapters that are there twice give their rows
twice. Of a chapter only the columns of ``KEYS`` and the content are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.functions.text import sha256
from corpusloom.sources.staging import materialize, ship_package

SPECIAL_KINDS = ("separator", "author_note", "promo", "noise")
BLOCK_MAX = 3000
SEGMENT_MIN, SEGMENT_MAX, SEGMENT_HARD = 400, 900, 1200
KEYS = ("chapter_num", "chapter_id", "version_id", "lang")
#: A segment's sentences: offsets, paragraph and number there.
SENTENCES = "array<struct<s:int,e:int,para:int,i:int>>"

#: White space as the column expressions know it.
_BLANK = " \t\n\x0b\f\r\x85\xa0\u3000"
_SENTENCE_END = re.compile(r"(?<=[.!?]) ")
_SEPARATOR = re.compile(r"[-*=_~ ]{3,}")
_ADDRESS = re.compile(r"https?://|www[.]")
#: Rows and characters after which a batch is handed on.
_ROWS, _CHARS = 16_384, 1 << 22


class Unit(NamedTuple):
    """A paragraph or sentence: its paragraph's number, its own number there, offsets, kind and text."""

    para: int
    i: int
    s: int
    e: int
    kind: str
    text: str


class Block(NamedTuple):
    first: int
    last: int
    s: int
    e: int
    kind: str
    reason: str


def located(pieces: Iterable[str], start: int) -> Iterator[tuple[int, int, int, str]]:
    """Number, start, end and text of the pieces that hold more than white space; pieces stood one character apart."""
    i = 0
    for piece in pieces:
        if piece.strip(_BLANK):
            i += 1
            yield i, start, start + len(piece), piece
        start += len(piece) + 1


def paragraph_kind(text: str) -> str:
    """What a paragraph is by its surface; everything else is a body."""
    if _SEPARATOR.fullmatch(text):
        return "separator"
    if not any(map(str.isalpha, text)):
        return "noise"
    lower = text.lower()
    if "license" in lower or "copyright" in lower:
        return "author_note"
    return "promo" if _ADDRESS.search(lower) else "body"


def paragraph_units(content: str) -> list[Unit]:
    return [Unit(i, i, s, e, paragraph_kind(t), t) for i, s, e, t in located(content.split("\n"), 0)]


def sentence_units(paragraphs: list[Unit]) -> Iterator[Unit]:
    """Sentences end at . ! or ? before a space; numbered within their paragraph, whose number they carry."""
    for p in paragraphs:
        for i, s, e, t in located(_SENTENCE_END.split(p.text), p.s):
            yield Unit(p.i, i, s, e, p.kind, t)


def block_units(paragraphs: Iterable[Unit], longest: int = BLOCK_MAX) -> Iterator[Block]:
    """Greedy blocks: special kinds and overlong paragraphs stand alone, others are gathered while the span with the next one stays within longest."""
    run: Block | None = None
    for p in paragraphs:
        special, overlong = p.kind in SPECIAL_KINDS, p.e - p.s > longest
        full = run is not None and run.e - run.s + 1 + p.e - p.s > longest
        if run and (special or overlong or full):
            yield run._replace(reason="strong_separator_trigger" if special else "target_max_reached")
            run = None
        if special or overlong:
            yield Block(p.i, p.i, p.s, p.e, p.kind if special else "normal", "strong_separator_block" if special else "single_long_paragraph")
        else:
            run = run._replace(last=p.i, e=p.e) if run else Block(p.i, p.i, p.s, p.e, "normal", "chapter_end")
    if run:
        yield run


def segment_ranges(sentences: list[Unit], least: int = SEGMENT_MIN, most: int = SEGMENT_MAX, hard: int = SEGMENT_HARD) -> Iterator[tuple[int, int]]:
    """Greedy runs of sentences: first and last, one-based places in the list."""
    first = 1
    for place in range(2, len(sentences) + 1):
        start = sentences[first - 1].s
        now, then = sentences[place - 2].e - start, sentences[place - 1].e - start
        if now > hard or (now >= least and then > most) or then > hard:
            yield first, place - 1
            first = place
    if sentences:
        yield first, len(sentences)


def blocks_with_sentences(content: str, longest: int) -> Iterator[tuple[Block, int, list[Unit]]]:
    """Blocks in order, each with the running number of the sentence before its first one, and its sentences."""
    paragraphs = paragraph_units(content)
    sentences = list(sentence_units(paragraphs))
    at = 0
    for block in block_units(paragraphs, longest):
        end = at
        while end < len(sentences) and sentences[end].para <= block.last:
            end += 1
        yield block, at, sentences[at:end]
        at = end


def expand(chapters: DataFrame, fields: list[tuple[str, str]], rows_of: Callable[[str, int | None], Iterable[tuple]]) -> DataFrame:
    """chapters' keys beside the rows that rows_of gives for each content and chapter number; fields: names and Spark types."""
    ship_package(chapters.sparkSession)
    schema = T.StructType([chapters.schema[k] for k in KEYS] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    kinds, names = [to_arrow_type(f.dataType) for f in schema.fields[len(KEYS) :]], schema.names
    texts = [k for k, (_, t) in enumerate(fields) if t == "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.columns[: len(KEYS)]
            at, rows, chars = [], [], 0

            def batch_of(at: list[int], rows: list[tuple], keys: list = keys) -> pa.RecordBatch:
                columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
                return pa.RecordBatch.from_arrays([c.take(pa.array(at, pa.int64())) for c in keys] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

            for place, (num, content) in enumerate(zip(keys[0], batch.column(len(KEYS)), strict=True)):
                for row in rows_of(content.as_py() or "", num.as_py()):
                    at.append(place)
                    rows.append(row)
                    chars += sum(len(row[k]) for k in texts if row[k])
                    if len(rows) >= _ROWS or chars >= _CHARS:
                        yield batch_of(at, rows)
                        at, rows, chars = [], [], 0
            yield batch_of(at, rows)

    return chapters.select(*KEYS, "content").mapInArrow(run, schema)


def number(value: Column | str) -> Column:
    """Four digits at least, and never cut."""
    return F.format_string("%04d", value)


def paragraphs(chapters: DataFrame) -> DataFrame:
    """One row a paragraph: coordinates, kind, text and hash."""
    fields = [("para_index", "long"), ("start_offset", "long"), ("end_offset", "long"), ("char_length", "long"), ("para_kind", "string"), ("para_text", "string")]
    rows = expand(chapters, fields, lambda content, _: ((p.i, p.s, p.e, p.e - p.s, p.kind, p.text) for p in paragraph_units(content)))
    return rows.withColumn("para_hash", sha256(F.col("para_text")))


def paragraph_id(chapter_id: Column | str, para: Column | str) -> Column:
    return F.concat_ws("_", chapter_id, F.lit("p"), number(para))


def sentence_id(chapter_id: Column | str, para: Column | str, i: Column | str) -> Column:
    return F.concat_ws("_", paragraph_id(chapter_id, para), F.lit("s"), number(i))


def sentences(chapters: DataFrame) -> DataFrame:
    """One row a sentence: coordinates, running number in the chapter, text and hash."""
    fields = [("para_index", "long"), ("sentence_index", "long"), ("global_sentence_index", "long"), ("start_offset", "long"), ("end_offset", "long"), ("sentence_text", "string")]
    rows = expand(chapters, fields, lambda content, _: ((u.para, u.i, g, u.s, u.e, u.text) for g, u in enumerate(sentence_units(paragraph_units(content)), 1)))
    return rows.select(*KEYS, paragraph_id("chapter_id", "para_index").alias("para_id"), sentence_id("chapter_id", "para_index", "sentence_index").alias("sentence_id"), *(n for n, _ in fields), sha256(F.col("sentence_text")).alias("sentence_hash"))


def scene_key() -> Column:
    return F.concat_ws(":", "chapter_id", "version_id", F.lit("scene"), F.col("scene_index").cast("string"))


def blocks(chapters: DataFrame, longest: int = BLOCK_MAX) -> DataFrame:
    """One row a block, with the running number of its first sentence and a hash of its text."""
    fields = [("scene_index", "long"), ("start_para_index", "long"), ("end_para_index", "long"), ("start_offset", "long"), ("end_offset", "long"), ("scene_kind", "string"), ("split_reason", "string"), ("source_hash", "string"), ("first_sentence", "long")]

    def rows_of(content: str, _: int | None) -> Iterator[tuple]:
        for k, (b, before, inside) in enumerate(blocks_with_sentences(content, longest), 1):
            yield k, b.first, b.last, b.s, b.e, b.kind, b.reason, hashlib.sha256(content[b.s : b.e].encode("utf-8")).hexdigest(), before + 1 if inside else None

    rows = expand(chapters, fields, rows_of)
    return rows.select(*KEYS, scene_key().alias("scene_key"), *(n for n, _ in fields[:5]), (F.col("end_offset") - F.col("start_offset")).alias("length"), "scene_kind", "split_reason", "source_hash", "first_sentence")


def segments(chapters: DataFrame, longest: int = BLOCK_MAX, least: int = SEGMENT_MIN, most: int = SEGMENT_MAX, hard: int = SEGMENT_HARD, overlap: int = 1) -> DataFrame:
    """One row a segment: its sentences' offsets with the overlap before them, ids, boundary status and text."""
    fields = [("scene_index", "long"), ("segment_index", "long"), ("start_offset", "long"), ("end_offset", "long"), ("sentence_count", "long"), ("overlap_sentences", "long"), ("boundary_status", "string"), ("sentences", SENTENCES), ("segment_text", "string")]

    def rows_of(content: str, _: int | None) -> Iterator[tuple]:
        for k, (_, _, inside) in enumerate(blocks_with_sentences(content, longest), 1):
            for g, (first, last) in enumerate(segment_ranges(inside, least, most, hard), 1):
                lead = max(1, first - overlap) if g > 1 else first
                held = inside[lead - 1 : last]
                start, end = held[0].s, held[-1].e
                status = "oversized_sentence_warning" if any(u.e - u.s > hard for u in held) else "over_hard_max_warning" if end - start > hard else "ok"
                yield k, g, start, end, len(held), first - lead, status, [{"s": u.s, "e": u.e, "para": u.para, "i": u.i} for u in held], content[start:end]

    rows = expand(chapters, fields, rows_of).withColumn("scene_key", scene_key())
    token = F.substring(sha256(F.concat_ws("|", F.col("chapter_num").cast("string"), "scene_key")), 1, 12)
    child = lambda k: F.concat(F.lit("l3cs_"), number("chapter_num"), F.lit("_"), token, F.lit("_"), number(k))
    previous = F.when(F.col("segment_index") > 1, child(F.col("segment_index") - 1))
    return rows.select(*KEYS, "scene_key", "scene_index", "segment_index", child("segment_index").alias("child_segment_id"), previous.alias("previous_child_id"), *(n for n, _ in fields[2:]), sha256(F.col("segment_text")).alias("segment_hash"))


#: Characters of a chapter whose spans are gathered together.
STRETCH = 1 << 20


def cut_again(spans: DataFrame, chapters: DataFrame, id_col: str, key: str = "chapter_num") -> DataFrame:
    """For each span (key, id, start_offset, end_offset) the text between the offsets of the chapter with its key.

    Gives the key, the id as a string, has_chapter, and cut, null where the
    offsets are missing, crossed or outside the text. Spans that have a chapter and
    offsets in order are gathered by stretches of it, so a text is joined once a
    stretch and cut in one pass; all others are never gathered, however many
    share a key. Repeated and null ids give a row each.
    """
    ship_package(chapters.sparkSession)
    has = chapters.select(F.col(key).alias("of_key")).distinct()
    narrow = spans.select(key, F.col(id_col).cast("string").alias("id"), F.col("start_offset").cast("long").alias("s"), F.col("end_offset").cast("long").alias("e"))
    narrow = narrow.join(has, F.col(key) == F.col("of_key"), "left").withColumn("has_chapter", F.col("of_key").isNotNull()).drop("of_key")
    narrow = materialize(narrow.withColumn("sound", F.coalesce(F.col("has_chapter") & (F.col("s") >= 0) & (F.col("s") < F.col("e")), F.lit(False))), "spans")
    gathered = narrow.filter("sound").groupBy(key, F.floor(F.col("s") / STRETCH).alias("stretch")).agg(F.collect_list(F.struct("id", "s", "e")).alias("spans"))
    text = chapters.select(F.col(key).alias("of_text"), "content")
    joined = gathered.join(text, F.col(key) == F.col("of_text")).select(key, "spans", "content", F.lit(True).alias("has_chapter"))
    rest = narrow.filter("not sound").select(key, F.col("id").alias(id_col), "has_chapter", F.lit(None).cast("string").alias("cut"))
    schema = T.StructType([spans.schema[key], T.StructField(id_col, T.StringType()), T.StructField("has_chapter", T.BooleanType()), T.StructField("cut", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                content, listed = batch.column(2)[place].as_py(), batch.column(1)[place].as_py()
                inside = lambda s, e, n=len(content or ""): s is not None and e is not None and 0 <= s < e <= n
                cuts = [content[x["s"] : x["e"]] if inside(x["s"], x["e"]) else None for x in listed]
                at = pa.array([place] * len(listed), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([x["id"] for x in listed], pa.string()), batch.column(3).take(at), pa.array(cuts, pa.string())], names=schema.names)

    return joined.mapInArrow(run, schema).unionByName(rest)
