"""Content-addressed WARC archive (operator 3).

Two tables make the archive: ``payloads`` holds each distinct payload once under
its SHA-256, and ``headers`` holds every record's exact header bytes, that is the
WARC named fields and the HTTP head that opens its block. Nothing else is kept of
a record: reading parses those bytes, verifies each stored payload against its
digest once, and rebuilds the records by a join on the digest.

All decisions are made on digests. Payload bytes move once, to the task that
stores them, and copies of one payload collapse in each task before they move, so
a payload that a third of all pages share costs one copy a task. The digest is
computed in both passes over the pages, which costs less than a copy of them.

Of records with equal payloads of at least ``least_revisit`` bytes, the one with
the smallest page id is the response and the others revisit it; shorter payloads
are responses all. Null html is an empty payload; a null url leaves out the
target field and comes back as null. Null ids come after all others and leave out
their field. Of rows that tie for the smallest page id, the least by url, then by
place in the written index, is the response and the others revisit that id. Line
breaks in a url are stored as %0D and %0A. An empty table makes an empty archive,
which reads as no rows. Payloads of any length are stored whole. Columns other
than id, url and html are neither read nor stored.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.storage import new_path

_CRLF = "\r\n"
#: Fixed value: the profile of revisits by equal payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: Column, digest: Column, row: Column) -> Column:
    """A name for a record that no other one has; rows of the index differ in row."""
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest, row.cast("string")))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))


def record_header(kind: Column, page_id: Column, url: Column, digest: Column, size: Column, own_id: Column, first_id: Column, first_page: Column, date: str) -> Column:
    """The named fields of a WARC/1.1 record, the blank line after them, and the HTTP head of its block."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF)), F.lit(""))
    urn = lambda i: F.concat(F.lit("<urn:uuid:"), i, F.lit(">"))
    text = lambda v: F.url_encode(v.cast("string"))
    revisit = lambda v: F.when(kind == "revisit", v)
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), size.cast("string"), F.lit(_CRLF * 2))
    block = F.length(http) + F.when(kind == "revisit", 0).otherwise(size)
    fields = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", urn(own_id)),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        line("WARC-Profile", revisit(F.lit(PROFILE))),
        line("WARC-Refers-To", revisit(urn(first_id))),
        line("WARC-Refers-To-Date", revisit(F.lit(date))),
        line("X-Page-ID", text(page_id)),
        line("X-Refers-To-Page-ID", revisit(text(first_page))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(_CRLF),
    )
    return F.encode(F.concat(fields, http), "UTF-8")


def write_archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_revisit: int = 100, date: str | None = None) -> str:
    """Write the two tables under path (a new folder of the shared one by default); returns the path.

    date: the records' WARC-Date, the time of writing by default.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("digest"), F.monotonically_increasing_id().alias("row"))
    slim.write.parquet(f"{path}/index")
    index = spark.read.schema(slim.schema).parquet(f"{path}/index")

    # the least row a digest, pre-aggregated in each task; the row number makes it one
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.coalesce("url", F.lit("")).alias("url"), "row")
    first = index.groupBy("digest").agg(F.min(order).alias("f")).select("digest", F.col("f.page_id").alias("first_page"), F.col("f.row").alias("first_row"))
    records = index.join(first, "digest")
    kind = F.when((F.col("size") < least_revisit) | (F.col("row") == F.col("first_row")), "response").otherwise("revisit")
    header = record_header(F.col("kind"), F.col("page_id"), F.col("url"), F.col("digest"), F.col("size"), record_id(F.col("page_id"), F.col("digest"), F.col("row")), record_id(F.col("first_page"), F.col("digest"), F.col("first_row")), F.col("first_page"), date)
    records.withColumn("kind", kind).select(header.alias("header"), F.lit(slim.schema["page_id"].dataType.simpleString()).alias("id_type")).write.parquet(f"{path}/headers")

    stored = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    stored.groupBy("digest").agg(F.any_value("payload").alias("payload")).write.parquet(f"{path}/payloads")
    return path


def parsed_headers(headers: DataFrame, id_type: T.DataType) -> DataFrame:
    """What the stored header bytes say: page_id, url, record_type, refers_to and payload_digest beside the bytes."""
    head = F.decode("header", "UTF-8")
    field = lambda name: F.nullif(F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))
    absent = lambda name: ~head.contains(f"{_CRLF}{name}: ")
    identity = lambda name: F.url_decode(F.when(~absent(name), F.coalesce(field(name), F.lit("")))).cast(id_type)
    url = F.when(~absent("WARC-Target-URI"), F.coalesce(field("WARC-Target-URI"), F.lit("")))
    return headers.select("header", identity("X-Page-ID").alias("page_id"), url.alias("url"), field("WARC-Type").alias("record_type"), identity("X-Refers-To-Page-ID").alias("refers_to"), F.regexp_replace(field("WARC-Payload-Digest"), r"\Asha256:", "").alias("payload_digest"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records again, from header and payload bytes alone: page_id, url, record_type, refers_to, header, payload, payload_bytes, payload_digest.

    A payload that doesn't hash to the digest it is stored under, and a record
    whose payload is lost, are errors.
    """
    stored = spark.read.parquet(f"{path}/payloads").withColumn("found", F.sha2("payload", 256))
    damaged = F.raise_error(F.concat(F.lit("stored payload is damaged: "), F.col("digest")))
    stored = stored.select(F.when(F.col("digest") == F.col("found"), F.col("digest")).otherwise(damaged).alias("digest"), "payload", F.octet_length("payload").cast("long").alias("payload_bytes"))
    headers = spark.read.parquet(f"{path}/headers")
    id_type = headers.select("id_type").first()
    records = parsed_headers(headers, T._parse_datatype_string(id_type[0] if id_type else "long"))
    lost = F.raise_error(F.concat(F.lit("stored payload is lost: "), F.col("payload_digest")))
    joined = records.join(stored, F.col("payload_digest") == F.col("digest"), "left")
    return joined.withColumn("payload_digest", F.when(F.col("digest").isNotNull(), F.col("payload_digest")).otherwise(lost)).drop("digest")


def warc_bytes(records: DataFrame) -> Column:
    """A record as it stands in a .warc file; the block of a revisit is its HTTP head alone."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(F.col("header"), body, F.encode(F.lit(_CRLF * 2), "UTF-8"))
