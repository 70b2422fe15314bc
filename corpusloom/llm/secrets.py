"""Secret scan with corpus-wide ownership frequency (operator 6).

One pass over the texts finds candidates: assigned values, access keys and long
hex runs, which are always reported, and further shapes (provider tokens, private
key blocks, passwords in addresses, mixed-class tokens). Only digests of their
values, of 128 bits, leave that pass. Over the corpus each digest is counted by
distinct repositories and by distinct owners. A value that many repositories or
several owners carry is a copied example; one that stays with few looks live. Of
the further shapes only live-looking values become spans. Where no repository is
named, a document is one.

Null and empty texts have no spans; an empty table gives an empty result. Texts of
any length are searched whole, in time in proportion to their length. Repeated
rows each get a row, and count as one repository where they share the id. Null
repositories and owners count as one each. Of base spans at one start the kinds go
in the order of ``KINDS``; a further span that overlaps a span found before it, by
kind and then by start, is left out. Offsets are code points, end exclusive.
Columns other than those named are not read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from functools import reduce
from operator import or_

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.native import free_name
from corpusloom.llm.storage import materialize, ship_package

#: Kinds in the order in which spans at the same start are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "token", "pem", "url", "mixed")
BASE = KINDS[:3]
#: A value carried by more distinct owners, or by more distinct repositories, than this is a copied example.
MOST_OWNERS, MOST_REPOSITORIES = 2, 50

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_KEYWORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Published shapes of provider credentials. A signed token begins where its run of characters does, else each place in a long run would be tried.
_TOKEN = re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_TOKEN_SIGNS = ("gh", "xox", "k_", "AIza", "eyJ")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )*PRIVATE KEY-----")
_URL = re.compile(r"(?<=[a-z0-9+.-])://[^\s/:@]+:([^\s/@]{6,})@")
_MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_=-])")
_PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your[-_]?|xxxx|(.)\1{7}|0123456789|123456789|abcdefgh", re.I)


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """The base spans as (start, place of the kind, end, value)."""
    found = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def further_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Candidates of the other kinds that no base span holds."""
    found = []
    if any(s in text for s in _TOKEN_SIGNS):
        found += [(m.start(), 3, m.end(), m[0]) for m in _TOKEN.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [(m.start(), 4, m.end(), m[0]) for m in _PEM.finditer(text)]
    if "://" in text and "@" in text:
        found += [(m.start(1), 5, m.end(1), m[1]) for m in _URL.finditer(text)]
    for m in _MIXED.finditer(text):
        value = m[0]
        if any(c.isupper() for c in value) and any(c.islower() for c in value) and sum(c.isdigit() for c in value) >= 3:
            found.append((m.start(), 6, m.end(), value))
    held, out = Covered(), []
    for span in base:
        held.add(span[0], span[2])
    for span in sorted(found, key=lambda s: (s[1], s[0])):
        if not _PLACEHOLDER.search(span[3]) and not held.meets(span[0], span[2]):
            held.add(span[0], span[2])
            out.append(span)
    return out


class Covered:
    """Offsets that spans hold, as sorted disjoint intervals."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end

    def add(self, start: int, end: int) -> None:
        i, j = bisect_left(self.ends, start), bisect_right(self.starts, end)
        if i < j:
            start, end = min(start, self.starts[i]), max(end, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [start], [end]


def span_text(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, *_ in spans)


def scan(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    """The pass over the texts: per row counts, the base digest and the candidates with their values' digests."""
    ship_package(docs.sparkSession)
    kind = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("value", pa.binary())])
    candidate = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("value", T.BinaryType())])
    schema = T.StructType([docs.schema[id_col], T.StructField("repo", T.StringType()), T.StructField("owner", T.StringType()), *(T.StructField(f"n_{k}", T.LongType()) for k in BASE), T.StructField("base_sha256", T.StringType()), T.StructField("candidates", T.ArrayType(candidate)), T.StructField("text_hash", T.LongType())])

    def digest(value: str) -> bytes:
        return hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:16]

    def find(batches):
        for batch in batches:
            counts, shas, found = ([], [], []), [], []
            for text in batch.column(3):
                text = text.as_py() or ""
                base = base_spans(text)
                for k, column in enumerate(counts):
                    column.append(sum(s[1] == k for s in base))
                shas.append(hashlib.sha256(span_text(base).encode()).hexdigest())
                found.append([{"start": s, "kind": k, "end": e, "value": digest(v)} for s, k, e, v in sorted(base + further_spans(text, base))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string()), pa.array(found, pa.list_(kind)), batch.column(4)], names=schema.names)

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col), F.coalesce(repo.cast("string"), F.lit("")).alias("repo"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"), text.alias("__text"), F.xxhash64(text).alias("text_hash"))
    return rows.mapInArrow(find, schema)


def ownership(scanned: DataFrame) -> DataFrame:
    """Per value digest: distinct repositories and owners that carry it. Pre-aggregated by value, repository and owner."""
    seen = scanned.select("repo", "owner", F.explode("candidates.value").alias("value")).distinct()
    return seen.groupBy("value").agg(F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES) -> DataFrame:
    """Per row: the id, n_assign, n_access, n_hex, base_sha256, spans, n_live and n_copied candidates, found (the spans as an array), and text_hash.

    repo: by default the document, by its id. owner: by default the part of ``source`` before a slash, or all of it.
    """
    repo = F.col(id_col) if repo is None else repo
    owner = F.substring_index(F.col("source").cast("string"), "/", 1) if owner is None else owner
    scanned = materialize(scan(docs, id_col, text_col, repo, owner).withColumn("row", F.monotonically_increasing_id()), "secrets")
    carried = ownership(scanned)
    each = scanned.select("row", F.explode("candidates").alias("c")).withColumn("value", F.col("c.value")).join(carried, "value")
    live = (F.col("owners") <= most_owners) & (F.col("repos") <= most_repositories)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("c.kind") + 1)
    span = F.struct(F.col("c.start").alias("start"), F.col("c.kind").alias("kind"), F.col("c.end").alias("end"), F.concat_ws(":", name, F.col("c.start"), F.col("c.end")).alias("name"), live.alias("live"))
    found = each.groupBy("row").agg(F.array_sort(F.collect_list(F.when(live | (F.col("c.kind") < len(BASE)), span))).alias("found"), F.count_if(live).alias("n_live"), F.count_if(~live).alias("n_copied"))
    some = scanned.filter(F.size("candidates") > 0).join(found, "row")
    none = scanned.filter(F.coalesce(F.size("candidates"), F.lit(0)) <= 0).withColumns({"found": F.lit(None).cast(found.schema["found"].dataType), "n_live": F.lit(0).cast("long"), "n_copied": F.lit(0).cast("long")})
    kept = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "n_live", "n_copied", "found", "text_hash"]
    both = some.select(kept).unionByName(none.select(kept))
    return both.withColumn("spans", F.coalesce(F.array_join(F.col("found.name"), ","), F.lit("")))


#: A text without any of these, an address with a password, a hex run, or a long run of token characters that holds a digit or an underscore can hold no candidate.
_SIGNS = ("AKIA", "xox", "eyJ", "PRIVATE KEY-----")
_HEX_RUN, _LONG_RUN = r"[0-9a-f]{16}", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24}"


def may_hold_secrets(text: Column) -> Column:
    """A cheap test that holds for every text with a candidate and for few others."""
    text = F.coalesce(text, F.lit(""))
    lower = F.lower(text)
    test = reduce(or_, (lower.contains(k) for k in ("passw", "secret", "token", "api_key", "apikey")))
    for sign in _SIGNS:
        test = test | text.contains(sign)
    # mixed tokens hold digits, provider tokens an underscore or AIza: most texts have none of these
    odd = text.contains("_") | text.contains("AIza") | text.rlike("[0-9]")
    return test | (text.contains("://") & text.contains("@")) | text.rlike(_HEX_RUN) | odd & text.rlike(_LONG_RUN)


def _blanked(texts: pd.Series, spans: pd.Series, mark: str) -> pd.Series:
    def one(text: str | None, listed: str | None) -> str | None:
        if text is None or not listed:
            return text
        out, at = [], 0
        for start, end in (map(int, s.split(":")) for s in listed.split(",")):
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]])

    return pd.Series([one(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)


def redacted_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None, mark: str = "[secret]") -> DataFrame:
    """docs with every reported span's text replaced; all rows stay, and n_chars follows where docs has it.

    Overlapping spans are replaced as one. Texts without a trace of any pattern
    pass through untouched; only the others are written apart, scanned, and joined
    with their spans on the id and the text's hash.
    """
    ship_package(docs.sparkSession)
    suspect = may_hold_secrets(F.col(text_col).cast("string"))
    clean, docs = docs.filter(~suspect), materialize(docs.filter(suspect), "suspects")
    spans = secret_spans(docs, id_col, text_col, repo, owner).filter(F.size("found") > 0)
    listed = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    same_id, same_text, found = (free_name(docs, c) for c in ("same_id", "same_text", "found"))
    spans = spans.select(F.col(id_col).alias(same_id), F.col("text_hash").alias(same_text), listed.alias(found)).dropDuplicates([same_id, same_text])
    text = F.col(text_col).cast("string")
    joined = docs.join(spans, F.col(id_col).eqNullSafe(F.col(same_id)) & (F.xxhash64(text) == F.col(same_text)), "left")

    @F.pandas_udf("string")
    def blank(texts: pd.Series, listed: pd.Series) -> pd.Series:
        return _blanked(texts, listed, mark)

    out = joined.withColumn(text_col, F.when(F.col(found).isNull(), F.col(text_col)).otherwise(blank(text, F.col(found))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType)))
    return clean.unionByName(out.select(*docs.columns))
