"""The corpus tables as chapters: raw markdown, versions, and the registry's static ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import sha256

#: Last chapter of the main text; later ones are appendices.
LAST_MAIN = 1922
#: First and last chapter, volume code and book code of each registered range.
RANGES = (
    (1, 160, "V01", "B01"), (161, 319, "V01", "B02"), (320, 458, "V02", "B03"), (459, 593, "V02", "B04"), (594, 724, "V02", "B05"), (725, 851, "V03", "B06"),
    (852, 1005, "V03", "B07"), (1006, 1148, "V03", "B08"), (1149, 1288, "V04", "B09"), (1289, 1470, "V04", "B10"), (1471, 1700, "V05", "B11"), (1701, 1922, "V06", "B12"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than the cluster has cores is dealt out before costly row-wise work; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def chapters(docs: DataFrame) -> DataFrame:
    """Documents as current chapters: chapter_num, chapter_id, version_id, lang, source, content, content_length."""
    docs = spread(docs.select("doc_id", "text", "lang", "source"))
    content = F.coalesce(F.col("text"), F.lit(""))
    num = F.col("doc_id") + 1
    return docs.select(
        num.alias("chapter_num"), F.concat(F.lit("ch_"), F.format_string("%04d", num)).alias("chapter_id"), F.concat(F.lit("ver_"), sha256(content)).alias("version_id"),
        "lang", "source", content.alias("content"), F.length(content).cast("long").alias("content_length"),
    )


def raw_markdown(docs: DataFrame) -> DataFrame:
    """Documents as the markdown files an importer meets: front matter, heading, body with stray blanks."""
    num = (F.col("doc_id") + 1).cast("string")
    head = F.concat(F.lit('---\ntitle: "第'), num, F.lit("章 "), F.substring("text", 1, 20), F.lit('"\norder: '), num, F.lit("\nchar_count: 0\n---\n\n# 第"), num, F.lit("章 "), F.col("lang"), F.lit("\n"))
    return docs.select("doc_id", F.col("text"), F.concat(head, F.lit("\t"), F.replace("text", F.lit(". "), F.lit(".\n\n\n "))).alias("raw"))


def version_ranges(spark: SparkSession) -> DataFrame:
    """The registered ranges with one for everything after them; a constant table, so joins may broadcast it."""
    rows = [*RANGES, (LAST_MAIN + 1, 1 << 62, "EXTRA", "EXTRA")]
    return spark.createDataFrame(rows, "first_chapter long, last_chapter long, volume_code string, book_code string")
