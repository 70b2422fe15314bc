"""File sources and sinks: texts of unknown encoding, seeds, review workbooks, partitions, reports."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.rules import fingerprint
from corpusloom.sources.staging import materialize, ship_package

#: Encodings in the order in which they are tried.
ENCODINGS = ("utf-8-sig", "utf-8", "gb18030", "gbk")


def _decode(contents: pd.Series) -> pd.DataFrame:
    def one(data: bytes) -> tuple[str | None, str | None]:
        for encoding in ENCODINGS:
            try:
                return data.decode(encoding).replace("\r\n", "\n").replace("\r", "\n"), encoding
            except UnicodeDecodeError:
                continue
        return None, None

    return pd.DataFrame([one(c) for c in contents], columns=["text", "encoding"])


def read_texts(spark: SparkSession, path: str, pattern: str = "*.{md,txt}") -> DataFrame:
    """Files as rows of path, filename, text and the encoding that fitted; a file that none fits is an error when its text is read."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    rows = files.select("path", F.substring_index("path", "/", -1).alias("filename"), F.pandas_udf(_decode, "text string, encoding string")("content").alias("d"))
    failed = F.raise_error(F.concat(F.lit(f"none of {', '.join(ENCODINGS)} fits "), "path"))
    return rows.select("path", "filename", F.when(F.col("d.encoding").isNotNull(), F.col("d.text")).otherwise(failed).alias("text"), "d.encoding")


def seed_items(seed: Any, marks: tuple[str, ...], path: str = "$") -> Iterator[tuple[str, dict]]:
    """Every object in a JSON seed that has one of the marking fields, with its path. Seeds are small configuration of the caller's."""
    if isinstance(seed, dict):
        if any(m in seed for m in marks):
            yield path, seed
        for key, value in seed.items():
            yield from seed_items(value, marks, f"{path}.{key}")
    elif isinstance(seed, list):
        for i, value in enumerate(seed):
            yield from seed_items(value, marks, f"{path}[{i}]")


def flatten(value: Any) -> list[str]:
    """All scalars of a nested value as text, in order."""
    if value is None:
        return []
    if isinstance(value, dict):
        return [x for v in value.values() for x in flatten(v)]
    if isinstance(value, list):
        return [x for v in value for x in flatten(v)]
    return [str(value)]


def seed_frame(spark: SparkSession, seed: Any, marks: tuple[str, ...]) -> DataFrame:
    rows = [(p, json.dumps(item, ensure_ascii=False, sort_keys=True), flatten(item)) for p, item in seed_items(seed, marks)]
    return spark.createDataFrame(rows, "item_path string, item string, scalars array<string>")


def write_review(df: DataFrame, path: str) -> None:
    """A review workbook as CSV with header; nested columns go in as JSON."""
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_review(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A filled workbook under its schema; a missing column is an error."""
    return spark.read.option("header", True).option("escape", '"').option("enforceSchema", False).option("mode", "FAILFAST").schema(schema).csv(path)


def replace_scope(df: DataFrame, path: str, partition: str) -> None:
    """Idempotent rebuild: only the partitions that df holds are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def first_compatible(spark: SparkSession, names: list[str], columns: set[str]) -> DataFrame | None:
    """The first existing table of names that has all the columns."""
    for name in names:
        if spark.catalog.tableExists(name):
            table = spark.table(name)
            if columns <= set(table.columns):
                return table
    return None


def missing_sources(spark: SparkSession, names: list[str]) -> list[str]:
    return [n for n in names if not spark.catalog.tableExists(n)]


def markdown_report(title: str, metrics: dict[str, Any], table: DataFrame | None = None, rows: int = 20) -> str:
    """A stage's report: metrics as a list and the first rows of a table; the row limit is the report's size."""
    lines = [f"# {title}", "", *(f"- {k}: {v}" for k, v in metrics.items())]
    if table is not None:
        cell = lambda v: str(v).replace("|", "\\|").replace("\n", " ")
        lines += ["", "| " + " | ".join(table.columns) + " |", "|" + "-|" * len(table.columns)]
        lines += ["| " + " | ".join(cell(v) for v in row) + " |" for row in table.limit(rows).collect()]
    return "\n".join(lines) + "\n"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = {f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "struct", "map")}
    return df.select(*(F.to_json(c).alias(c) if c in nested else F.col(c) for c in df.columns))


def write_texts(texts: DataFrame, path: str, name_col: str = "filename", text_col: str = "text", encoding: str = "utf-8") -> int:
    """One file a row, written by the tasks; returns how many. path must be one that all executors see.

    A file appears under its name only when it is whole, so a task that runs again
    replaces it. Null texts are empty files; rows without a name, and names with a
    slash, are an error. Of rows of one name any one stays.
    """
    ship_package(texts.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        # Hadoop also writes local paths with one slash
        fs, root = FileSystem.from_uri(re.sub(r"\Afile:(?=/[^/])", "", path))
        fs.create_dir(root)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not name or "/" in name:
                    raise ValueError(f"no file name: {name!r}")
                part = f"{root}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as f:
                    f.write((text or "").encode(encoding))
                fs.move(part, f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows = texts.select(F.col(name_col).cast("string"), F.col(text_col).cast("string"))
    return rows.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_chapters(chapters: DataFrame, path: str) -> None:
    """Chapters as markdown files, and their index as CSV that opens with a byte order mark.

    chapters: chapter_order, chapter_id, title, filename, markdown, char_count.
    The index carries each markdown's MD5. Null markdown is an empty file.
    """
    text = F.coalesce("markdown", F.lit(""))
    write_texts(chapters, f"{path}/chapters", "filename", "markdown")
    index = chapters.select(F.col("chapter_order").alias("﻿chapter_order"), "chapter_id", "title", "filename", "char_count", F.md5(F.encode(text, "UTF-8")).alias("md5"))
    index.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/index")


def append_rows(df: DataFrame, path: str) -> None:
    """Insert rows into a table by name; columns that the table lacks are an error, those that df lacks become null."""
    spark = df.sparkSession
    if exists(spark, path):
        stored = spark.read.parquet(path).schema
        if unknown := sorted(set(df.columns) - set(stored.names)):
            raise ValueError(f"the table has no column {', '.join(unknown)}")
        df = df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in stored.fields))
    df.write.mode("append").parquet(path)


def write_results(df: DataFrame, path: str) -> None:
    """Results of retrieval or answers twice: JSON lines as they are, and CSV with nested columns as JSON text."""
    df.write.mode("overwrite").json(f"{path}/json")
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/csv")


def upsert_vectors(vectors: DataFrame, path: str, key: str = "id", rebuild: bool = False, buckets: int = 256) -> None:
    """A store of vectors by id: rebuilt, or with rows of known ids replaced and others added.

    Rows are kept in buckets by a hash of the id, and only the buckets that the
    delivery meets are read and written. Of several rows of one id the greatest
    stays; rows without an id are an error. A column that the store lacks is an
    error.
    """
    spark = vectors.sparkSession
    safe = F.when(F.col(key).isNotNull(), F.col(key)).otherwise(F.raise_error(F.lit("a vector without an id")))
    rows = vectors.withColumn(key, safe).groupBy(key).agg(F.max(F.struct(*[c for c in vectors.columns if c != key])).alias("__r")).select(key, "__r.*")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))
    if not rebuild and exists(spark, path):
        stored = spark.read.parquet(path)
        if set(stored.columns) != set(rows.columns):
            raise ValueError(f"the store has columns {stored.columns}")
        rows = materialize(rows, "vectors")
        met = stored.join(rows.select("bucket").distinct(), "bucket", "left_semi")
        rows = materialize(rows.unionByName(met.join(rows.select(key), key, "left_anti")), "vectors")
    mode = "static" if rebuild else "dynamic"
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(path)


def write_layer_report(df: DataFrame, path: str, title: str, metrics: dict[str, Any]) -> None:
    """A layer's report: its rows as JSON lines and CSV, a manifest with count, columns and fingerprint, and markdown."""
    spark = df.sparkSession
    write_results(df, path)
    f = fingerprint(flat(df)).first()
    manifest = {"title": title, "columns": df.columns, "rows": f["rows"], "fingerprint": [f["xor"], f["total"]], "metrics": metrics}
    for name, text in (("manifest", json.dumps(manifest, ensure_ascii=False, sort_keys=True)), ("markdown", markdown_report(title, {**metrics, "rows": f["rows"]}, df))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")
