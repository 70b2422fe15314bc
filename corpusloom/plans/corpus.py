"""Queries over the corpus layers: coordinates, blocks, segments, versions, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import sha256
from corpusloom.operators import chunking as C
from corpusloom.operators import hashtree as H
from corpusloom.operators import versioning as V
from corpusloom.plans import corpus_sql as S
from corpusloom.plans.registry import query
from corpusloom.sources.corpus import LAST_MAIN, RANGES, chapters, table, version_ranges
from corpusloom.sources.staging import new_path

#: Limits of the queries over the test documents, which are shorter than a novel's chapters.
BLOCK, LEAST, MOST, HARD = 1200, 200, 450, 600
SEGMENTS_SQL = S.segments(BLOCK, LEAST, MOST, HARD)


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chapters(table(spark, sf_dir, "documents"))


def block_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.blocks(units(spark, sf_dir), BLOCK)


def segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.segments(units(spark, sf_dir), BLOCK, LEAST, MOST, HARD)


@query(f"WITH {S.PARAGRAPHS} SELECT lang, count(*) AS paragraphs, sum((sha256(substr(content, start_offset + 1, end_offset - start_offset)) = sha256(para_text))::INT)::BIGINT AS verified, sum(end_offset - start_offset)::BIGINT AS chars FROM pa JOIN ch USING (chapter_num) GROUP BY lang")
def q00_backcut_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs with offsets and hashes, cut again out of their chapters (J34) and counted."""
    rows = units(spark, sf_dir)
    paras = C.paragraphs(rows).drop("para_text")
    cut = C.cut_again(paras, rows, "para_index").select("chapter_num", F.col("para_index").cast("long").alias("para_index"), sha256(F.col("cut")).alias("again"))
    paras, again = paras.join(cut, ["chapter_num", "para_index"]), F.col("again")
    return paras.groupBy("lang").agg(F.count(F.lit(1)).alias("paragraphs"), F.count_if(again == F.col("para_hash")).alias("verified"), F.sum("char_length").alias("chars"))


@query(f"WITH {S.PARAGRAPHS} SELECT chapter_num, chapter_id, version_id, ch.lang, para_index, start_offset, end_offset, end_offset - start_offset AS char_length, para_kind, sha256(para_text) AS para_hash FROM pa JOIN ch USING (chapter_num)")
def w14_paragraph_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W14 offsets of paragraph units, J1 and J2 chapter texts."""
    return C.paragraphs(units(spark, sf_dir)).drop("para_text")


@query(
    f"WITH {S.SENTENCES} SELECT chapter_num, chapter_id, version_id, ch.lang, chapter_id || '_p_' || printf('%04d', para_index) AS para_id, chapter_id || '_p_' || printf('%04d', para_index) || '_s_' || printf('%04d', sentence_index) AS sentence_id, para_index, sentence_index, global_sentence_index, start_offset, end_offset, sentence_text, sha256(sentence_text) AS sentence_hash FROM se JOIN ch USING (chapter_num)"
)
def w14_sentence_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sentences(units(spark, sf_dir))


@query(f"WITH RECURSIVE {S.blocks(BLOCK)} SELECT bl.*, (SELECT min(global_sentence_index) FROM se WHERE se.chapter_num = bl.chapter_num AND se.start_offset >= bl.start_offset AND se.end_offset <= bl.end_offset) AS first_sentence FROM bl")
def g01_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 greedy paragraph packing, J4 first contained sentence."""
    return block_rows(spark, sf_dir)


@query(f"WITH RECURSIVE {S.blocks(BLOCK)}, x AS (SELECT *, lag(end_offset) OVER (PARTITION BY chapter_num ORDER BY scene_index) AS pe, lag(end_para_index) OVER (PARTITION BY chapter_num ORDER BY scene_index) AS pp FROM bl) SELECT count(*) AS blocks, sum((pe > start_offset)::INT)::BIGINT AS overlaps, sum((coalesce(pp, 0) + 1 <> start_para_index)::INT)::BIGINT AS gaps, sum((length <= 0)::INT)::BIGINT AS empty FROM x")
def g02_block_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 blocks of a chapter neither overlap nor leave out a paragraph."""
    w = Window.partitionBy("chapter_num").orderBy("scene_index")
    x = block_rows(spark, sf_dir).withColumns({"pe": F.lag("end_offset").over(w), "pp": F.lag("end_para_index").over(w)})
    return x.agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("pe") > F.col("start_offset")).alias("overlaps"), F.count_if(F.coalesce("pp", F.lit(0)) + 1 != F.col("start_para_index")).alias("gaps"), F.count_if(F.col("length") <= 0).alias("empty"))


@query(f"WITH RECURSIVE {SEGMENTS_SQL} SELECT * FROM sg")
def g03_g04_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 greedy sentence packing, G4 overlap, ids and boundary status, W12 previous segment."""
    return segment_rows(spark, sf_dir).drop("sentences")


@query(f"WITH RECURSIVE {SEGMENTS_SQL} SELECT sg.child_segment_id, si.i - go.f + 1 AS position, si.s AS start_offset, si.e AS end_offset, si.i < go.lo AS is_overlap FROM sg JOIN go ON go.chapter_num = sg.chapter_num AND go.scene_index = sg.scene_index AND go.g = sg.segment_index JOIN si ON si.chapter_num = go.chapter_num AND si.scene_index = go.scene_index AND si.i BETWEEN go.f AND go.hi")
def g04_segment_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 links from segments to their sentences, J3 containment."""
    rows = segment_rows(spark, sf_dir).select("child_segment_id", "overlap_sentences", F.posexplode("sentences").alias("k", "u"))
    return rows.select("child_segment_id", (F.col("k") + 1).cast("long").alias("position"), F.col("u.s").cast("long").alias("start_offset"), F.col("u.e").cast("long").alias("end_offset"), (F.col("k") < F.col("overlap_sentences")).alias("is_overlap"))


@query(
    f"WITH RECURSIVE {SEGMENTS_SQL}, x AS (SELECT sg.child_segment_id, sg.scene_key, sg.chapter_id, sg.version_id, sg.chapter_num, string_agg(si.s || '-' || si.e || '-' || sha256(substr(content, si.s + 1, si.e - si.s)), ';' ORDER BY si.i) AS body FROM sg JOIN ch USING (chapter_num) JOIN go ON go.chapter_num = sg.chapter_num AND go.scene_index = sg.scene_index AND go.g = sg.segment_index JOIN si ON si.chapter_num = go.chapter_num AND si.scene_index = go.scene_index AND si.i BETWEEN go.f AND go.hi GROUP BY ALL) SELECT child_segment_id, sha256(scene_key || '|' || chapter_id || '|' || version_id || '|' || chapter_num || '|' || body) AS source_fingerprint FROM x"
)
def g05_segment_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 a segment's fingerprint over its sources, X13 hash of a structure in a fixed form."""
    rows = segment_rows(spark, sf_dir)
    inside = lambda u: F.substring(F.col("segment_text"), (u["s"] - F.col("start_offset") + 1).cast("int"), u["e"] - u["s"])
    part = F.transform("sentences", lambda u: F.concat_ws("-", u["s"].cast("string"), u["e"].cast("string"), sha256(inside(u))))
    return rows.select("child_segment_id", sha256(F.concat_ws("|", "scene_key", "chapter_id", "version_id", F.col("chapter_num").cast("string"), F.array_join(part, ";"))).alias("source_fingerprint"))


@query(
    f"WITH RECURSIVE {SEGMENTS_SQL} SELECT lang, count(*) AS segments, count(DISTINCT scene_key) AS blocks, count(DISTINCT chapter_num) AS chapters, round(avg(end_offset - start_offset), 6) AS mean_length, min(end_offset - start_offset) AS least_length, max(end_offset - start_offset) AS most_length, sum((boundary_status <> 'ok')::INT)::BIGINT AS warned, sum(overlap_sentences)::BIGINT AS overlaps FROM sg GROUP BY lang"
)
def a01_segment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 scope metrics over the segments."""
    rows = segment_rows(spark, sf_dir)
    length = F.col("end_offset") - F.col("start_offset")
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("segments"), F.count_distinct("scene_key").alias("blocks"), F.count_distinct("chapter_num").alias("chapters"), F.round(F.avg(length), 6).alias("mean_length"), F.min(length).alias("least_length"), F.max(length).alias("most_length"), F.count_if(F.col("boundary_status") != "ok").alias("warned"), F.sum("overlap_sentences").alias("overlaps"))


@query(f"WITH RECURSIVE {S.blocks(BLOCK)} SELECT scene_kind, split_reason, count(*) AS n FROM bl GROUP BY ALL")
def a05_block_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 counts by kind and reason."""
    return block_rows(spark, sf_dir).groupBy("scene_kind", "split_reason").agg(F.count(F.lit(1)).alias("n"))


RANGE_SQL = ", ".join(f"({a}, {b}, '{v}', '{k}')" for a, b, v, k in RANGES)


@query(
    f"WITH {S.CHAPTERS}, r(a, b, v, k) AS (VALUES {RANGE_SQL}) SELECT chapter_num, coalesce(v, CASE WHEN chapter_num > {LAST_MAIN} THEN 'EXTRA' ELSE 'UNKNOWN' END) AS volume_code, coalesce(k, CASE WHEN chapter_num > {LAST_MAIN} THEN 'EXTRA' ELSE 'UNKNOWN' END) AS book_code FROM ch LEFT JOIN r ON chapter_num BETWEEN a AND b"
)
def f07_volume_of_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 static range lookup: a constant table of thirteen rows is broadcast."""
    rows = chapters(table(spark, sf_dir, "documents")).select("chapter_num")
    ranges = F.broadcast(version_ranges(spark))
    joined = rows.join(ranges, F.col("chapter_num").between(F.col("first_chapter"), F.col("last_chapter")), "left")
    return joined.select("chapter_num", *(F.coalesce(c, F.lit("UNKNOWN")).alias(c) for c in ("volume_code", "book_code")))


INCOMING_SQL = """cur AS (SELECT chapter_id, chapter_num, version_id, sha256(content) AS content_hash, 1 AS is_current FROM ch WHERE chapter_num % 7 <> 0),
inc AS (SELECT chapter_id, chapter_num, 'ver_' || sha256(t) AS version_id, sha256(t) AS content_hash FROM (SELECT *, CASE WHEN chapter_num % 10 = 0 THEN content || ' revised' ELSE content END AS t FROM ch WHERE chapter_num % 11 <> 0)),
j AS (SELECT coalesce(i.chapter_id, c.chapter_id) AS chapter_id, coalesce(i.chapter_num, c.chapter_num) AS chapter_num, i.version_id AS iv, i.content_hash AS ih, c.version_id AS cv, c.content_hash AS chh, CASE WHEN i.chapter_id IS NULL THEN 'absent' WHEN c.chapter_id IS NULL THEN 'inserted' WHEN i.content_hash = c.content_hash THEN 'unchanged' ELSE 'new_version' END AS action FROM inc i FULL JOIN cur c ON i.chapter_id = c.chapter_id)"""


def incoming(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored slice of the chapters, and a later delivery with revised, missing and new ones."""
    ch = chapters(table(spark, sf_dir, "documents"))
    stored = ch.filter("chapter_num % 7 <> 0").select("chapter_id", "chapter_num", "version_id", sha256(F.col("content")).alias("content_hash"), F.lit(1).alias("is_current"))
    later = ch.filter("chapter_num % 11 <> 0").withColumn("t", F.when(F.col("chapter_num") % 10 == 0, F.concat("content", F.lit(" revised"))).otherwise(F.col("content")))
    return stored, later.select("chapter_id", "chapter_num", F.concat(F.lit("ver_"), sha256(F.col("t"))).alias("version_id"), sha256(F.col("t")).alias("content_hash"))


@query(
    f"WITH {S.CHAPTERS}, {INCOMING_SQL} SELECT chapter_id, chapter_num, cv AS version_id, chh AS content_hash, (action <> 'new_version')::INT AS is_current, action FROM j WHERE action <> 'inserted' UNION ALL SELECT chapter_id, chapter_num, iv, ih, 1, action FROM j WHERE action IN ('inserted', 'new_version')"
)
def f08_versioned_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 versioned upsert, F10 demotion, keyed on chapter and version."""
    return V.upsert(*incoming(spark, sf_dir))


@query(f"WITH {S.CHAPTERS}, {INCOMING_SQL} SELECT action, count(*) AS n FROM j GROUP BY action")
def f08_upsert_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.compare(*incoming(spark, sf_dir)).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {S.CHAPTERS}, {INCOMING_SQL} SELECT chapter_id, chapter_num, coalesce(iv, cv) AS latest_version_id FROM j")
def f09_registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 registry keeps the latest version where none comes in."""
    return V.registry(*incoming(spark, sf_dir))


@query(f"WITH {S.CHAPTERS}, {INCOMING_SQL} SELECT i.* FROM inc i ANTI JOIN cur c ON i.chapter_id = c.chapter_id")
def f11_insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11 rows whose key is not stored yet."""
    stored, later = incoming(spark, sf_dir)
    return V.new_rows(stored, later, ["chapter_id"])


@query(
    f"WITH {S.CHAPTERS}, c AS (SELECT doc_id // 2 + 1 AS chapter_num, doc_id AS source_order, 'chapter_' || doc_id || '.md' AS filename FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY chapter_num ORDER BY source_order DESC, filename DESC) AS place, first_value(filename) OVER (PARTITION BY chapter_num ORDER BY source_order DESC, filename DESC) AS kept FROM c) SELECT chapter_num, source_order, filename, CASE WHEN place > 1 THEN 'skipped duplicate H1 chapter number ' || chapter_num || '; kept ' || kept END AS skipped FROM r"
)
def f06_duplicate_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 of candidates with one chapter number the last by order and name stays."""
    docs = table(spark, sf_dir, "documents")
    c = docs.select((F.floor(F.col("doc_id") / 2) + 1).alias("chapter_num"), F.col("doc_id").alias("source_order"), F.concat(F.lit("chapter_"), "doc_id", F.lit(".md")).alias("filename"))
    w = Window.partitionBy("chapter_num").orderBy(F.desc("source_order"), F.desc("filename"))
    skipped = F.when(F.row_number().over(w) > 1, F.concat(F.lit("skipped duplicate H1 chapter number "), "chapter_num", F.lit("; kept "), F.first("filename").over(w)))
    return c.withColumn("skipped", skipped)


@query(f"WITH {S.CHAPTERS} SELECT version_id, count(*) AS n FROM ch GROUP BY version_id HAVING count(*) > 1")
def a02_duplicate_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 and A3 keys that occur more than once."""
    return chapters(table(spark, sf_dir, "documents")).groupBy("version_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query("WITH k AS (SELECT doc_id + 1 AS n FROM documents WHERE doc_id % 13 <> 0) SELECT x AS chapter_num FROM (SELECT unnest(range((SELECT min(n) FROM k), (SELECT max(n) FROM k) + 1)) AS x) WHERE x NOT IN (SELECT n FROM k)")
def a04_missing_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 gaps in a sequence: each number's successor tells the gap after it, so no full sequence is joined."""
    k = table(spark, sf_dir, "documents").filter("doc_id % 13 <> 0").select((F.col("doc_id") + 1).alias("n"))
    return V.missing_numbers(k, "n").withColumnRenamed("n", "chapter_num")


@query(
    f"WITH {S.CHAPTERS}, s AS (SELECT *, chapter_num % 5 = 0 AS t FROM ch), c AS (SELECT chapter_num, sha256(content) AS h, CASE WHEN t THEN sha256(content || 'x') ELSE sha256(content) END AS stored, CASE WHEN chapter_num % 9 = 0 THEN 0 ELSE len(content) END AS l, len(content) AS n FROM s) SELECT sum((h <> stored)::INT)::BIGINT AS hash_mismatches, sum((l <> n)::INT)::BIGINT AS length_mismatches, count(*) AS chapters FROM c"
)
def m10_stored_against_recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 stored length and hash against the content's, on rows with planted damage."""
    ch = chapters(table(spark, sf_dir, "documents"))
    stored = ch.select("chapter_num", "content", F.when(F.col("chapter_num") % 5 == 0, sha256(F.concat("content", F.lit("x")))).otherwise(sha256(F.col("content"))).alias("content_hash"), F.when(F.col("chapter_num") % 9 == 0, 0).otherwise(F.length("content")).alias("content_length"))
    return stored.agg(F.count_if(F.col("content_hash") != sha256(F.col("content"))).alias("hash_mismatches"), F.count_if(F.col("content_length") != F.length("content")).alias("length_mismatches"), F.count(F.lit(1)).alias("chapters"))


@query(
    f"WITH {S.CHAPTERS}, st AS (SELECT chapter_id, version_id, CASE WHEN chapter_num % 17 = 0 THEN 'x' ELSE sha256(content) END AS content_hash, CASE WHEN chapter_num % 19 = 0 THEN 'pending' ELSE 'indexed' END AS status FROM ch WHERE chapter_num % 23 <> 0) SELECT CASE WHEN st.chapter_id IS NULL THEN 'missing' WHEN status <> 'indexed' THEN 'not_indexed' WHEN content_hash <> sha256(content) THEN 'stale' ELSE 'ready' END AS readiness, count(*) AS n FROM ch LEFT JOIN st USING (chapter_id, version_id) GROUP BY ALL"
)
def m01_coordinate_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 every current chapter has an indexed status with an equal hash."""
    ch = chapters(table(spark, sf_dir, "documents")).withColumn("h", sha256(F.col("content"))).drop("content")
    st = ch.filter("chapter_num % 23 <> 0").select("chapter_id", "version_id", F.when(F.col("chapter_num") % 17 == 0, "x").otherwise(F.col("h")).alias("content_hash"), F.when(F.col("chapter_num") % 19 == 0, "pending").otherwise("indexed").alias("status"))
    readiness = F.when(F.col("status").isNull(), "missing").when(F.col("status") != "indexed", "not_indexed").when(F.col("content_hash") != F.col("h"), "stale").otherwise("ready")
    return ch.join(st, ["chapter_id", "version_id"], "left").groupBy(readiness.alias("readiness")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH c AS (SELECT doc_id, sha256(concat_ws('|', doc_id::VARCHAR, lang, coalesce(text, ''))) AS h, len(coalesce(text, '')) AS n FROM documents) , p AS (SELECT lang, substr(h, 1, 4) AS head, sha256(string_agg(h, '' ORDER BY h)) AS part, count(*) AS n_rows, sum(n) AS chars FROM c JOIN documents USING (doc_id) GROUP BY ALL) SELECT lang, sha256(string_agg(part, '' ORDER BY head)) AS fingerprint, sum(n_rows)::BIGINT AS n_rows, sum(chars)::BIGINT AS chars FROM p GROUP BY lang")
def a20_dataset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20 fingerprint of a set of rows in digest order, A21 row and character sums: digests of 65,536 ranges of row digests, then one digest of those, so no task gathers a language."""
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    h = docs.select("lang", sha256(F.concat_ws("|", F.col("doc_id").cast("string"), "lang", text)).alias("h"), F.length(text).alias("n"))
    parts = h.groupBy("lang", F.substring("h", 1, 4).alias("head")).agg(sha256(F.array_join(F.sort_array(F.collect_list("h")), "")).alias("part"), F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("chars"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("head", "part"))), lambda x: x["part"])
    return parts.groupBy("lang").agg(sha256(F.array_join(listed, "")).alias("fingerprint"), F.sum("n_rows").alias("n_rows"), F.sum("chars").alias("chars"))


_encoded = " || ".join(f"CASE WHEN {c} IS NULL THEN '|' ELSE length({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in ("doc_id", "lang", "n_chars", "source", "text"))
_sums = " || '|' || ".join(f"sum(('0x' || substr(h, {1 + 15 * i}, 15))::BIGINT)::VARCHAR" for i in range(4))


@query(
    f"""WITH r AS (SELECT substr(sha256(CASE WHEN doc_id IS NULL THEN '|' ELSE length(doc_id::VARCHAR) || ':' || doc_id END), 1, 2) AS node, sha256({_encoded}) AS h FROM documents),
n2 AS (SELECT node, count(*) AS n_rows, sha256(count(*) || '|' || {_sums}) AS digest FROM r GROUP BY node),
n1 AS (SELECT substr(node, 1, 1) AS node, sum(n_rows)::BIGINT AS n_rows, sha256(string_agg(node || ':' || digest, '|' ORDER BY node)) AS digest FROM n2 GROUP BY 1),
n0 AS (SELECT '' AS node, sum(n_rows)::BIGINT AS n_rows, sha256(string_agg(node || ':' || digest, '|' ORDER BY node)) AS digest FROM n1)
SELECT length(node)::INT AS level, * FROM (SELECT * FROM n0 UNION ALL SELECT * FROM n1 UNION ALL SELECT * FROM n2)"""
)
def a20_fingerprint_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20 and A21 as a stored tree: the root is the table's fingerprint, its nodes those of key ranges."""
    path = new_path(spark, "tree")
    H.write_tree(table(spark, sf_dir, "documents"), "doc_id", path, levels=2)
    return H.nodes(spark, path)


@query(
    """WITH d AS (SELECT doc_id AS key, doc_id % 41 AS m, text FROM documents)
SELECT key, 'missing' AS state, 1::BIGINT AS left_rows, 0::BIGINT AS right_rows FROM d WHERE m IN (0, 2)
UNION ALL SELECT key + 1000000000, 'extra', 0, 1 FROM d WHERE m = 2
UNION ALL SELECT key, 'changed', 1, CASE m WHEN 3 THEN 2 ELSE 1 END FROM d WHERE m = 3 OR (m = 1 AND text IS NOT NULL)"""
)
def m13_located_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 and J18 two stores compared by their trees: of every 41 documents one is dropped, one edited, one moved to another id, one doubled."""
    docs, m = table(spark, sf_dir, "documents"), F.col("doc_id") % 41
    text = F.when(m == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    times = F.when(m == 0, F.array()).when(m == 3, F.array(F.lit(1), F.lit(1))).otherwise(F.array(F.lit(1)))
    other = docs.withColumn("__n", F.explode(times)).drop("__n").withColumn("text", text).withColumn("doc_id", F.when(m == 2, F.col("doc_id") + 1_000_000_000).otherwise(F.col("doc_id")))
    left, right = new_path(spark, "left-tree"), new_path(spark, "right-tree")
    H.write_tree(docs, "doc_id", left)
    H.write_tree(other, "doc_id", right)
    return H.differing_keys(spark, left, right)


@query("SELECT doc_id, text FROM documents ORDER BY sha256(doc_id || ':42') LIMIT 5")
def a22_seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22 a seeded sample of five rows: the feature is its fixed size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.orderBy(sha256(F.concat("doc_id", F.lit(":42")))).limit(5)


@query("SELECT doc_id + 1 AS chapter_num, lang FROM documents ORDER BY doc_id LIMIT 20")
def w18_first_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W18 the first chapters ascending."""
    return table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("chapter_num"), "lang").orderBy("chapter_num").limit(20)


@query("SELECT doc_id + 1 AS chapter_num, n_chars FROM documents WHERE doc_id + 1 IN (1, 2, 17, 169) ORDER BY 1")
def s07_scoped_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 a scan of named chapters; a missing one is an error."""
    return V.scoped(table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("chapter_num"), "n_chars"), "chapter_num", [1, 2, 17, 169])
