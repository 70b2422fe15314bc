"""Queries through the sinks: rows are written to a fresh folder, changed there, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import rules as R
from corpusloom.operators import versioning as V
from corpusloom.plans.registry import query
from corpusloom.sources import files, guard
from corpusloom.sources.corpus import chapters, table
from corpusloom.sources.staging import new_path

SEED = {"godways": [{"id": "g1", "name": "First", "aliases": ["One", "Uno"], "steps": [{"id": "g1s", "name": "Step"}]}], "rules": {"r": {"rule_id": "r1", "name": None, "limits": [1, 2.5, True]}}, "note": "free"}
SEED_ROWS = [("$.godways[0]", "First|One|Step|Uno|g1|g1s"), ("$.godways[0].steps[0]", "Step|g1s"), ("$.rules.r", "1|2.5|True|r1")]


@query("SELECT item_path, scalars FROM (VALUES " + ", ".join(f"('{p}', '{s}')" for p, s in SEED_ROWS) + ") t(item_path, scalars)")
def s10_seed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 items of a seed by marker fields with their paths, X33 their scalars."""
    rows = files.seed_frame(spark, SEED, ("id", "rule_id"))
    return rows.select("item_path", F.array_join(F.array_sort("scalars"), "|").alias("scalars"))


@query("SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 'new' ELSE 'old' END AS state, (CASE WHEN vec_id % 2 = 0 THEN -1 ELSE 1 END * embedding[1])::DOUBLE AS first_value FROM embeddings WHERE vec_id % 2 = 0 OR vec_id % 3 <> 0")
def s12_vector_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 a store built anew, then a delivery that replaces some vectors and adds others."""
    path = new_path(spark, "vectors")
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    files.upsert_vectors(v.filter("vec_id % 3 <> 0").withColumn("state", F.lit("old")), path, "vec_id", rebuild=True, buckets=16)
    changed = v.filter("vec_id % 2 = 0").select("vec_id", F.transform("embedding", lambda x: -x).alias("embedding"), F.lit("new").alias("state"))
    files.upsert_vectors(changed, path, "vec_id", buckets=16)
    return spark.read.parquet(path).select("vec_id", "state", F.get("embedding", F.lit(0)).alias("first_value"))


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS s_nationkey FROM supplier")
def s13_appended_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S13 rows inserted by name in two deliveries, the second without one column."""
    path = new_path(spark, "rows")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    files.append_rows(s.filter("s_suppkey % 2 = 0"), path)
    files.append_rows(s.filter("s_suppkey % 2 <> 0").select("s_name", "s_suppkey"), path)
    return spark.read.parquet(path)


@query("SELECT doc_id, lang, CASE WHEN lang = 'de' THEN 'second' ELSE 'first' END AS delivery FROM documents WHERE lang <> 'de' OR doc_id % 2 = 0")
def s14_replaced_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S14 an idempotent rebuild of one scope: the other partitions stay."""
    path = new_path(spark, "scope")
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").filter("lang is not null")
    files.replace_scope(d.withColumn("delivery", F.lit("first")), path, "lang")
    for _ in range(2):
        files.replace_scope(d.filter("lang = 'de' and doc_id % 2 = 0").withColumn("delivery", F.lit("second")), path, "lang")
    return spark.read.parquet(path).select("doc_id", F.col("lang").cast("string").alias("lang"), "delivery")


MARKDOWN = "'# ' || n_name || chr(10) || chr(10) || 'Nation ' || n_nationkey"


@query(f"SELECT n_nationkey AS chapter_order, 'c' || n_nationkey AS chapter_id, n_name AS title, 'chapter_' || n_nationkey || '.md' AS filename, len({MARKDOWN})::BIGINT AS char_count, md5({MARKDOWN}) AS md5, md5({MARKDOWN}) AS file_md5 FROM nation")
def s05_chapter_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 markdown files and their index, read back and held against each other."""
    path = new_path(spark, "chapters")
    key = F.col("n_nationkey").cast("string")
    text = F.concat(F.lit("# "), "n_name", F.lit("\n\nNation "), key)
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("chapter_order"), F.concat(F.lit("c"), key).alias("chapter_id"), F.col("n_name").alias("title"), F.concat(F.lit("chapter_"), key, F.lit(".md")).alias("filename"), text.alias("markdown"), F.length(text).cast("long").alias("char_count"))
    files.write_chapters(rows, path)
    index = spark.read.option("header", True).option("escape", '"').schema("chapter_order long, chapter_id string, title string, filename string, char_count long, md5 string").csv(f"{path}/index")
    stored = files.read_texts(spark, f"{path}/chapters").select("filename", F.md5(F.encode("text", "UTF-8")).alias("file_md5"))
    return index.join(stored, "filename")


@query("SELECT doc_id, 'json' AS form, '[\"' || lang || '\",\"' || source || '\"]' AS tags FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL UNION ALL SELECT doc_id, 'csv', '[\"' || lang || '\",\"' || source || '\"]' FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def s16_s17_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S16 and S17 nested results as JSON lines and as flattened CSV, read back."""
    path = new_path(spark, "results")
    files.write_results(table(spark, sf_dir, "documents").filter("lang is not null and source is not null").select("doc_id", F.array("lang", "source").alias("tags")), path)
    nested = spark.read.schema("doc_id long, tags array<string>").json(f"{path}/json").select("doc_id", F.lit("json").alias("form"), F.to_json("tags").alias("tags"))
    flat = spark.read.option("header", True).option("escape", '"').schema("doc_id long, tags string").csv(f"{path}/csv")
    return nested.unionByName(flat.withColumn("form", F.lit("csv")))


@query("SELECT r_name AS name, 'second' AS found_in, 'other, none' AS missing FROM region")
def s21_s23_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S21 sources in order of preference, S22 the first with the columns, S23 the missing ones."""
    table(spark, sf_dir, "region").createOrReplaceTempView("corpusloom_third")
    table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.lit("second").alias("found_in")).createOrReplaceTempView("corpusloom_second")
    order = ["corpusloom_other", "corpusloom_third", "corpusloom_second", "corpusloom_none"]
    missing = ", ".join(n.removeprefix("corpusloom_") for n in files.missing_sources(spark, order))
    return files.first_compatible(spark, order, {"name", "found_in"}).withColumn("missing", F.lit(missing))


@query("SELECT CASE WHEN doc_id = (SELECT max(doc_id) FROM documents) THEN 'new_version' ELSE 'unchanged' END AS action, count(*) AS n FROM documents GROUP BY ALL")
def m12_single_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 one edited chapter makes one new version, and leaves all others as they are."""
    ch = chapters(table(spark, sf_dir, "documents"))
    columns = lambda text: ["chapter_id", "chapter_num", F.sha2(F.encode(text, "UTF-8"), 256).alias("version_id"), F.sha2(F.encode(text, "UTF-8"), 256).alias("content_hash")]
    last = F.lit(ch.agg(F.max("chapter_num")).first()[0])
    edited = ch.withColumn("content", F.when(F.col("chapter_num") == last, F.concat("content", F.lit("!"))).otherwise(F.col("content")))
    both = V.compare(ch.select(*columns(F.col("content")), F.lit(1).alias("is_current")), edited.select(*columns(F.col("content"))))
    return both.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


_h = "('0x' || substr(sha256(coalesce(doc_id::VARCHAR, 'None') || '|' || coalesce(quality::VARCHAR, 'None') || '|' || coalesce(toxic::VARCHAR, 'None')), 1, 15))::BIGINT"


@query(f"SELECT stage, rows, xor, total FROM (SELECT count(*) AS rows, bit_xor({_h}) AS xor, sum({_h})::VARCHAR AS total FROM labels) CROSS JOIN (VALUES ('before'), ('after'), ('report')) s(stage)")
def m13_m24_rebuilds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 a layer rebuilt twice keeps its fingerprint, M24 and M25 its report carries it."""
    path = new_path(spark, "layer")
    rows = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    prints = []
    for stage in ("before", "after"):
        rows.write.mode("overwrite").parquet(f"{path}/rows")
        print_ = R.fingerprint(spark.read.parquet(f"{path}/rows"))
        prints.append(spark.createDataFrame([print_.first()], print_.schema).withColumn("stage", F.lit(stage)))
    files.write_layer_report(rows, f"{path}/report", "Labels", {"layer": "labels"})
    manifest = spark.read.schema("rows long, fingerprint array<string>").json(f"{path}/report/manifest")
    report = manifest.select("rows", F.get("fingerprint", F.lit(0)).cast("long").alias("xor"), F.get("fingerprint", F.lit(1)).alias("total"), F.lit("report").alias("stage"))
    return R.union(*prints, report)


@query("SELECT event_id, event_type, '[\"' || event_type || '\",\"a,b\"]' AS flags, CASE WHEN event_id % 3 = 0 THEN 'accepted' WHEN event_id % 3 = 1 THEN 'say \"no\", ' || event_id END AS human_note FROM events")
def s15_review_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S15 a review workbook written as CSV and read back under its schema."""
    path = new_path(spark, "workbook")
    i = F.col("event_id")
    note = F.when(i % 3 == 0, "accepted").when(i % 3 == 1, F.concat(F.lit('say "no", '), i.cast("string")))
    files.write_review(table(spark, sf_dir, "events").select("event_id", "event_type", F.array("event_type", F.lit("a,b")).alias("flags"), note.alias("human_note")), path)
    return files.read_review(spark, path, "event_id long, event_type string, flags string, human_note string")


@query("SELECT line, text FROM (VALUES (0, '# Regions'), (1, ''), (2, '- rows: 5'), (3, ''), (4, '| r_regionkey | r_name |'), (5, '|-|-|')) t(line, text) UNION ALL SELECT 5 + row_number() OVER (ORDER BY r_regionkey), '| ' || r_regionkey || ' | ' || r_name || ' |' FROM region")
def s18_markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S18 a stage's report as markdown, line by line."""
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")
    lines = files.markdown_report("Regions", {"rows": r.count()}, r).rstrip("\n").split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "line long, text string")


@query("SELECT CASE WHEN n_nationkey % 4 = 3 THEN 'n' || n_nationkey || '.txt' ELSE 'n' || n_nationkey || '.md' END AS filename, '第' || n_nationkey || '章 ' || n_name || chr(10) || 'end' AS text, CASE WHEN n_nationkey % 2 = 0 THEN 'utf-8-sig' ELSE 'gb18030' END AS encoding FROM nation")
def s01_s04_read_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 and S4 markdown and text files of a folder, S2 and S3 read under the first encoding that fits, line ends made uniform."""
    path = new_path(spark, "texts")
    n, key = table(spark, sf_dir, "nation"), F.col("n_nationkey").cast("string")
    name = F.concat(F.lit("n"), key, F.when(F.col("n_nationkey") % 4 == 3, ".txt").otherwise(".md"))
    rows = n.select("n_nationkey", name.alias("filename"), F.concat(F.lit("第"), key, F.lit("章 "), "n_name", F.lit("\r\nend")).alias("text"))
    files.write_texts(rows.filter("n_nationkey % 2 = 0"), path, encoding="utf-8-sig")
    files.write_texts(rows.filter("n_nationkey % 2 <> 0"), path, encoding="gb18030")
    files.write_texts(rows.limit(1).withColumn("filename", F.lit("other.bin")), path)
    return files.read_texts(spark, path).select("filename", "text", "encoding")


STATEMENTS = (
    ("SELECT r_name FROM corpusloom_regions WHERE r_name <> 'DROP TABLE x; DELETE'", True), ("WITH a AS (SELECT 1 AS x) SELECT * FROM a -- update", True), ("INSERT INTO corpusloom_regions VALUES (1)", False), ("DROP TABLE corpusloom_regions", False),
    ("CREATE TABLE t AS SELECT 1", False), ("WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", False), ("FROM corpusloom_regions INSERT INTO t SELECT * INSERT INTO u SELECT *", False), ("DELETE FROM corpusloom_regions", False), ("UPDATE t SET x = 1", False), ("SET spark.sql.ansi.enabled = false", False), ("TRUNCATE TABLE t", False), ("VALUES (1)", True),
)


@query("SELECT n, read_only FROM (VALUES " + ", ".join(f"({i}, {str(ok).lower()})" for i, (_, ok) in enumerate(STATEMENTS)) + ") t(n, read_only)")
def s08_s09_statement_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 and S9 statements that only read, told from those that write, by their parsed plans."""
    return spark.createDataFrame([(i, guard.is_query(spark, sql)) for i, (sql, _) in enumerate(STATEMENTS)], "n long, read_only boolean")
