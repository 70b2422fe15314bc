"""Corpus preparation: quality rules, near-duplicates, secrets, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet in the shared folder and gives it to the next. All
but the last return the columns of docs, whatever their names; only text and
n_chars ever change. An empty table stays empty, and texts of any length are
worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.mixing import mixed_documents
from corpusloom.llm.native import free_name
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.quality_rules import quality_rules
from corpusloom.llm.secrets import redacted_documents
from corpusloom.llm.simhash import near_duplicates
from corpusloom.llm.storage import materialize, release, scratch
from corpusloom.sources.corpus import spread


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; of the others the failing lines go, and n_chars follows where it was the text's length.

    A text without failing lines stays as it is. Null, empty and blank texts are
    rejected. Repeated rows share one fate.
    """
    into = free_name(docs, "quality")
    judged = quality_rules(docs, into=into).filter(f"{into}.kept")
    cleaned = F.col(f"{into}.clean_text")
    changed = cleaned != F.col("text")
    new = {"text": F.when(changed, cleaned).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(cleaned).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return judged.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))


def row_keys(docs: DataFrame, name: str) -> DataFrame:
    """The text, and under name whether the id is null, the id, and a digest of all columns, in the order in which rows are preferred; only rows equal in every column share one."""
    digest = F.unhex(F.sha2(F.to_json(F.struct(*docs.columns)), 256))
    return docs.withColumn(name, F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), digest.alias("digest")))


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, that of the least id and then of the least digest; null ids come last.

    Rows are settled, not ids: rows of one id with different texts, and rows
    without an id, go only where a link says so. Null and empty texts are near
    each other. Rows equal in every column are copies.
    """
    row, head = free_name(docs, "row"), free_name(docs, "head")
    keyed = row_keys(docs, row)
    links = near_duplicates(keyed.select(row, "text"), row)
    heads = links.filter(F.col(f"{row}.digest") == F.col("component_id.digest")).groupBy(F.col(f"{row}.digest").alias(head)).agg(F.count(F.lit(1)).alias("rows"))
    heads = materialize(heads, "heads", compact=True)
    # heads grow with the corpus, so they are never broadcast, however few they are
    first = keyed.join(heads.select(head).hint("merge"), F.col(f"{row}.digest") == F.col(head))
    if heads.filter("rows > 1").limit(1).count():  # rows equal in every column
        first = first.dropDuplicates([head])
    return first.select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark, and n_chars follows.

    A document is a repository, the part of its source before a slash the owner.
    Null and empty texts stay as they are. Repeated rows are changed alike, and
    of overlapping spans one mark remains.
    """
    return redacted_documents(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document.

    A null source is one of its own, null and empty texts have size 0, and null
    ids hash as empty. Of repeated rows as many are taken as the budget holds.
    """
    return mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens.

    Null and empty texts are their end id alone. Each repeated row is packed by
    itself; of equal lengths the smaller id goes first.
    """
    return pack_documents(docs)


STAGES = [
    ("quality_rules", keep_quality),
    ("near_duplicates", keep_one_of_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_to_weights),
    ("packing", pack_windows),
]

#: Fingerprints, secret spans and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; what a stage wrote on its way goes when its result is written, and that when the next one's is."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES:
        with scratch("stage"):
            result = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        release(docs)
        docs = result
    return docs
