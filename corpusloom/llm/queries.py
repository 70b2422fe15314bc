"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.alignment import alignments
from corpusloom.llm.media import media_features, store_media
from corpusloom.llm.merkle import FIELDS, MANIFEST_SQL, verified_documents
from corpusloom.llm.mixing import MIXING_SQL, mix_sources
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.passages import quality_scores
from corpusloom.llm.quality_rules import QUALITY_SQL, quality_rules
from corpusloom.llm.repeats import remove_repeats
from corpusloom.llm.secrets import secret_spans
from corpusloom.llm.simhash import near_duplicates
from corpusloom.llm.token_counts import token_counts
from corpusloom.llm.toxicity import toxicity_scores
from corpusloom.llm.warc import read_archive, write_archive
from corpusloom.sources.corpus import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Ids and texts of all documents; a scan of fewer splits than cores is dealt out first."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *more))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(texts(spark, sf_dir), into="q")
    return judged.select("doc_id", "q.*").drop("clean_text")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(texts(spark, sf_dir))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = read_archive(spark, write_archive(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(texts(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(texts(spark, sf_dir), table(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(texts(spark, sf_dir, "source"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(store_media(texts(spark, sf_dir)))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(texts(spark, sf_dir, "source"))


def op9_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(texts(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(texts(spark, sf_dir))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_documents(spread(table(spark, sf_dir, "documents").select(*FIELDS)))


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(texts(spark, sf_dir))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda acc, n: acc + n)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(texts(spark, sf_dir))


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op6_secrets that SQL can say."""
    return op6_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


def media_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7_media that SQL can say."""
    return op7_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def packed_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of op10_packing's pieces, by document: they are there from the first id to the last without gap, in sequences without overlap."""
    p = op10_packing(spark, sf_dir)
    sequence = Window.partitionBy("sequence_id").orderBy("offset")
    p = p.withColumns({"follows": F.col("offset") == F.coalesce(F.lag(F.col("offset") + F.col("length")).over(sequence), F.lit(0)), "fits": F.col("offset") + F.col("length") <= 1024})
    document = Window.partitionBy("doc_id").orderBy("start")
    p = p.withColumn("goes_on", F.col("start") == F.coalesce(F.lag(F.col("start") + F.col("length")).over(document), F.lit(0)))
    whole = F.bool_and(F.col("follows") & F.col("fits") & F.col("goes_on")) & (F.sum("length") == F.max("doc_tokens")) & (F.min("doc_tokens") == F.max("doc_tokens"))
    return p.groupBy("doc_id").agg(whole.alias("whole"))


#: Over documents whose ids are unique, as the tables' are.
PART_SQL = {
    "secret_counts": r"""
WITH a AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, len(list_filter(regexp_extract_all(t, '(?i)(?:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1), lambda v: len(v) >= 12))::BIGINT AS n_assign,
  len(list_filter(regexp_extract_all(t, 'AKIA[A-Z0-9]+'), lambda v: len(v) >= 18))::BIGINT AS n_access, len(list_filter(regexp_extract_all(t, '[0-9a-f]+'), lambda v: len(v) >= 16))::BIGINT AS n_hex FROM a
""",
    "media_payloads": r"""
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS d FROM documents), n AS (SELECT *, octet_length(d)::BIGINT AS n_bytes FROM b),
p AS (SELECT *, (greatest(1, (n_bytes + 63) // 64) * 64)::BIGINT AS payload_bytes FROM n)
SELECT doc_id, n_bytes, payload_bytes, sha256(d || repeat('\x00'::BLOB, payload_bytes - n_bytes)) AS payload_sha256 FROM p
""",
    "packed_whole": "SELECT doc_id, true AS whole FROM documents",
}


WARC_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_token_counts, op3_warc, op4_simhash, op5_toxicity, op6_secrets, op7_media, op8_mixing, op9_quality_mil, op10_packing, op11_merkle, op12_repeats, op13_alignment, secret_counts, media_payloads, packed_whole)}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": QUALITY_SQL, "op3_warc": WARC_SQL, "op8_mixing": MIXING_SQL, "op11_merkle": MANIFEST_SQL, **PART_SQL}
