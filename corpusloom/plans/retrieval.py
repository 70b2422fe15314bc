"""Queries of hybrid retrieval over the corpus segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import sha256, squeeze
from corpusloom.operators import inverted as I
from corpusloom.operators import retrieval as R
from corpusloom.operators.rules import fingerprint
from corpusloom.plans.corpus import SEGMENTS_SQL, segment_rows
from corpusloom.plans.registry import query
from corpusloom.plans.text import squeeze_sql
from corpusloom.sources.corpus import table
from corpusloom.sources.staging import materialize

QUERIES = ["thing", "heit und", "of the", "ción", "Zza nowhere", "est"]
K = 10

QUERY_SQL = "qs(query_id, query_text) AS (VALUES " + ", ".join(f"('q{i:03d}', '{t}')" for i, t in enumerate(QUERIES, 1)) + ")"
TITLE_SQL = f"ti AS (SELECT doc_id + 1 AS chapter_num, {squeeze_sql('split_part(text, chr(10), 1)')} AS title FROM documents)"


def embedding_sql(text: str) -> str:
    parts = ", ".join(f"round(('0x' || substr(sha256('{n}:' || {text}), {8 * i + 1}, 8))::UBIGINT::DOUBLE / 4294967295.0::DOUBLE * 2.0::DOUBLE - 1.0::DOUBLE, 6)" for n in range(2) for i in range(8))
    return f"list_transform([{{'v': [{parts}]}}], lambda s: list_transform(s.v, lambda x: round(x / sqrt(list_reduce(list_transform(s.v, lambda y: y * y), lambda a, b: a + b)), 6)))[1]"


ROUTES_SQL = f"""{QUERY_SQL}, {TITLE_SQL},
kh AS (SELECT query_id, child_segment_id, chapter_num, scene_key, (len(segment_text) - len(replace(segment_text, query_text, ''))) // len(query_text) AS n, len(segment_text) AS length FROM sg JOIN qs ON contains(segment_text, query_text)),
ks AS (SELECT *, round(least(1.0, 0.25 + n / 3.0::DOUBLE), 6) AS keyword_score FROM kh),
kr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY keyword_score DESC, n DESC, length, child_segment_id) AS place FROM ks QUALIFY place <= {K}),
tt AS (SELECT *, regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}]+') AS tokens FROM ti),
tf AS (SELECT *, ' ' || array_to_string(tokens, ' ') || ' ' AS flat, len(tokens) AS size FROM tt),
qp AS (SELECT *, ' ' || array_to_string(regexp_extract_all(lower(query_text), '[\\p{{L}}\\p{{N}}]+'), ' ') || ' ' AS phrase FROM qs),
tp AS (SELECT query_id, chapter_num, size, (len(replace(flat, ' ', '  ')) - len(replace(replace(flat, ' ', '  '), replace(phrase, ' ', '  '), ''))) // len(replace(phrase, ' ', '  ')) AS f FROM tf JOIN qp ON contains(flat, phrase)),
td AS (SELECT query_id, count(*) AS df FROM tp GROUP BY query_id),
tb AS (SELECT query_id, chapter_num, round(1 / (1 + abs(greatest(ln(((SELECT count(*) FROM tf) - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)), 1e-6) * f * 2.2::DOUBLE / (f + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * size / (SELECT avg(size) FROM tf))))), 6) AS title_score, 'fts' AS tier FROM tp JOIN td USING (query_id)
  UNION ALL SELECT query_id, chapter_num, CASE WHEN title = query_text THEN 1.0 WHEN list_contains(tokens, lower(query_text)) THEN 0.9 ELSE 0.8 END::DOUBLE, 'like' FROM tf JOIN qs ON contains(title, query_text) WHERE query_id NOT IN (SELECT query_id FROM td)),
tr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY title_score DESC, chapter_num) AS place FROM tb QUALIFY place <= {K}),
ts AS (SELECT query_id, sg.chapter_num, scene_key, child_segment_id, title_score FROM tr JOIN sg ON sg.chapter_num = tr.chapter_num QUALIFY row_number() OVER (PARTITION BY query_id, sg.chapter_num ORDER BY scene_index, segment_index) <= {K}),
ve AS (SELECT child_segment_id, chapter_num, scene_key, {embedding_sql('segment_text')} AS e FROM sg),
qv AS (SELECT query_id, {embedding_sql('query_text')} AS q FROM qs),
vd AS (SELECT query_id, child_segment_id, chapter_num, scene_key, round(list_reduce(list_transform(list_zip(e, q), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b), 6) AS distance FROM ve CROSS JOIN qv),
vr AS (SELECT *, round(1 / (1 + abs(distance)), 6) AS vector_score, row_number() OVER (PARTITION BY query_id ORDER BY distance, child_segment_id) AS place FROM vd QUALIFY place <= {K}),
un AS (SELECT query_id, child_segment_id, chapter_num, scene_key, title_score AS t, 0.0::DOUBLE AS k, 0.0::DOUBLE AS v, 'sqlite_title' AS route FROM ts
  UNION ALL SELECT query_id, child_segment_id, chapter_num, scene_key, 0.0, keyword_score, 0.0, 'sqlite_child_keyword' FROM kr
  UNION ALL SELECT query_id, child_segment_id, chapter_num, scene_key, 0.0, 0.0, vector_score, 'chroma_vector' FROM vr),
me AS (SELECT query_id, child_segment_id, chapter_num, scene_key, max(t) AS title_score, max(k) AS keyword_score, max(v) AS vector_score, string_agg(DISTINCT route, ',' ORDER BY route) AS recall_sources FROM un GROUP BY ALL),
fu AS (SELECT *, round(0.35::DOUBLE * title_score + 0.30::DOUBLE * keyword_score + 0.35::DOUBLE * vector_score, 6) AS hybrid_score FROM me),
fr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hybrid_score DESC, chapter_num, scene_key, child_segment_id) AS place FROM fu QUALIFY place <= {K})"""
FULL_SQL = f"WITH RECURSIVE {SEGMENTS_SQL}, {ROUTES_SQL}"


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A chapter's title is its first line."""
    return table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("chapter_num"), squeeze(F.substring_index("text", "\n", 1)).alias("title"))


def routes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Segments, written once for all that read them, query table, and the three routes' hits."""
    segments, queries = materialize(segment_rows(spark, sf_dir), "segments"), R.query_table(spark, QUERIES)
    title = R.title_segments(R.title_recall(titles(spark, sf_dir), queries, K), segments, K)
    keyword = R.keyword_recall(segments, queries, K)
    vectors = segments.select("child_segment_id", "chapter_num", "scene_key", R.hash_embedding(F.col("segment_text")).alias("embedding"))
    vector = R.vector_recall(vectors, queries.select("query_id", R.hash_embedding(F.col("query_text")).alias("query_vector")), K)
    return segments, queries, title, keyword, vector


def fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, title, keyword, vector = routes(spark, sf_dir)
    return R.fuse(title, keyword, vector, K)


@query(f"{FULL_SQL} SELECT query_id, child_segment_id, n, keyword_score, place FROM kr")
def w01_keyword_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 keyword route, X19 score."""
    return R.keyword_recall(segment_rows(spark, sf_dir), R.query_table(spark, QUERIES), K).select("query_id", "child_segment_id", "n", "keyword_score", "place")


@query(f"{FULL_SQL} SELECT query_id, chapter_num, title_score, tier, place FROM tr")
def w02_title_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 title route with its two tiers, J13 token join, X17 query form, X21 BM25 score."""
    return R.title_recall(titles(spark, sf_dir), R.query_table(spark, QUERIES), K)


def indexed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).select(F.col("chapter_num").alias("id"), F.lit(1).alias("version"), R.title_tokens(F.col("title")).alias("tokens"))


@query(f"{FULL_SQL} SELECT query_id, chapter_num, title_score, place FROM tr WHERE tier = 'fts'")
def w02_indexed_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2, X21 the phrase tier of the title route from a stored inverted index that skips blocks by their bounds."""
    rows = indexed_titles(spark, sf_dir)
    size = rows.agg(F.count("tokens").alias("n"), F.avg(F.size("tokens")).alias("mean")).first()
    queries = R.query_table(spark, QUERIES).select("query_id", R.title_tokens(F.col("query_text")).alias("tokens"))
    hits, _ = I.search(I.build(rows), queries, K, size["n"], size["mean"])
    return hits.select("query_id", F.col("id").alias("chapter_num"), F.col("score").alias("title_score"), "place")


@query(f"WITH {TITLE_SQL}, m AS (SELECT chapter_num, regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}]+') AS tokens FROM ti WHERE chapter_num % 7 <> 0) SELECT count(*) FILTER (len(tokens) > 0) AS main_rows, count(*) FILTER (len(tokens) > 0) AS index_rows, 0::BIGINT AS missing, 0::BIGINT AS orphans, 0::BIGINT AS damaged FROM m")
def m02_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 index against main table in both directions, after every fifth title has got a new version and every seventh has gone."""
    rows = indexed_titles(spark, sf_dir)
    # every fifth row is first indexed with its tokens in the reverse order and its text doubled, under version 0
    stale = F.col("id") % 5 == 0
    first = rows.select("id", F.when(stale, 0).otherwise(1).alias("version"), F.when(stale, F.concat("tokens", F.reverse("tokens"))).otherwise(F.col("tokens")).alias("tokens"))
    removed = first.filter(stale | (F.col("id") % 7 == 0)).select("id", "version")
    index, _ = I.changed(I.build(first), removed, rows.filter(stale & (F.col("id") % 7 != 0)))
    return I.differences(index, rows.filter("id % 7 <> 0"))


@query(f"{FULL_SQL} SELECT query_id, chapter_num, child_segment_id, title_score FROM ts")
def j14_title_to_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14 the first segments of a chapter whose title was hit."""
    return routes(spark, sf_dir)[2].select("query_id", "chapter_num", "child_segment_id", "title_score")


@query(f"{FULL_SQL} SELECT query_id, child_segment_id, distance, vector_score, place FROM vr")
def w03_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 exact vector route, X23 hash embedding, X25 distance."""
    return routes(spark, sf_dir)[4].select("query_id", "child_segment_id", "distance", "vector_score", "place")


@query(
    f"SELECT q.vec_id AS query_id, v.vec_id, round(list_reduce(list_transform(list_zip(v.embedding, q.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)), lambda a, b: a + b), 6) AS distance, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_reduce(list_transform(list_zip(v.embedding, q.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE)), lambda a, b: a + b), 6), v.vec_id) AS place FROM embeddings v CROSS JOIN (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q WHERE v.vec_id <> q.vec_id QUALIFY place <= {K}"
)
def x25_vector_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 stored vectors, X25 nearest neighbours of every vector whose id is divisible by 20, among all vectors."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return R.nearest(v, v.filter("vec_id % 20 = 0"), K)


@query(f"{FULL_SQL} SELECT query_id, child_segment_id, chapter_num, title_score, keyword_score, vector_score, recall_sources, hybrid_score, place FROM fr")
def p01_hybrid_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 hybrid retrieval, J16 route merge, X22 fusion, W4 fused rank."""
    return fused(spark, sf_dir).drop("scene_key")


@query(
    f"{FULL_SQL}, st AS (SELECT child_segment_id, CASE WHEN chapter_num % 4 = 0 THEN 'damaged' ELSE segment_hash END AS stored_hash FROM sg WHERE chapter_num % 6 <> 0) SELECT query_id, count(*) AS hits, sum((st.child_segment_id IS NULL)::INT)::BIGINT AS missing, sum((stored_hash <> segment_hash)::INT)::BIGINT AS hash_mismatch, sum((stored_hash = segment_hash)::INT)::BIGINT AS ok FROM fr JOIN sg USING (child_segment_id) LEFT JOIN st USING (child_segment_id) GROUP BY query_id"
)
def j17_hit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J15 lookup of hit ids, J17 hits against the store."""
    segments, _, title, keyword, vector = routes(spark, sf_dir)
    hits = R.fuse(title, keyword, vector, K).select("query_id", "child_segment_id")
    own = segments.select("child_segment_id", "segment_hash")
    stored = segments.filter("chapter_num % 6 <> 0").select("child_segment_id", F.when(F.col("chapter_num") % 4 == 0, "damaged").otherwise(F.col("segment_hash")).alias("stored_hash"))
    rows = hits.join(own, "child_segment_id").join(stored, "child_segment_id", "left")
    same = F.col("stored_hash") == F.col("segment_hash")
    return rows.groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"), F.count_if(F.col("stored_hash").isNull()).alias("missing"), F.count_if(~same).alias("hash_mismatch"), F.count_if(same).alias("ok"))


@query(
    f"WITH RECURSIVE {SEGMENTS_SQL}, st AS (SELECT child_segment_id, CASE WHEN chapter_num % 4 = 0 THEN 'damaged' ELSE segment_hash END AS h FROM sg WHERE chapter_num % 6 <> 0 UNION ALL SELECT 'extra_' || chapter_num, 'x' FROM ch WHERE chapter_num <= 7) SELECT CASE WHEN st.child_segment_id IS NULL THEN 'missing' WHEN sg.child_segment_id IS NULL THEN 'extra' WHEN h <> segment_hash THEN 'mismatch' ELSE 'equal' END AS state, count(*) AS n FROM sg FULL JOIN st ON sg.child_segment_id = st.child_segment_id GROUP BY ALL"
)
def j18_store_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J18 full outer difference of segments and vector store, O1 id differences, M23."""
    segments = segment_rows(spark, sf_dir).select("child_segment_id", "chapter_num", "segment_hash")
    extra = table(spark, sf_dir, "documents").filter("doc_id < 7").select(F.concat(F.lit("extra_"), F.col("doc_id") + 1).alias("stored_id"), F.lit("x").alias("h"))
    stored = segments.filter("chapter_num % 6 <> 0").select(F.col("child_segment_id").alias("stored_id"), F.when(F.col("chapter_num") % 4 == 0, "damaged").otherwise(F.col("segment_hash")).alias("h")).unionByName(extra)
    state = F.when(F.col("stored_id").isNull(), "missing").when(F.col("child_segment_id").isNull(), "extra").when(F.col("h") != F.col("segment_hash"), "mismatch").otherwise("equal")
    return segments.join(stored, F.col("child_segment_id") == F.col("stored_id"), "full_outer").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""{FULL_SQL},
pq AS (SELECT query_id, max(child_segment_id) FILTER (place = 1) AS top1, max(recall_sources) FILTER (place = 1) AS src, max(segment_text) FILTER (place = 1) AS txt, max((place <= 3 AND contains(recall_sources, 'sqlite_child_keyword'))::INT) AS k3, count(*) FILTER (place <= 3) AS top3_hits, count(*) FILTER (place <= 5) AS top5_hits FROM fr JOIN sg USING (child_segment_id) GROUP BY query_id)
SELECT query_id, query_text, top1, coalesce(top3_hits, 0) AS top3_hits, coalesce(top5_hits, 0) AS top5_hits, (SELECT count(*) FROM kr WHERE kr.query_id = qs.query_id) AS keyword_hits, (SELECT count(*) FROM vr WHERE vr.query_id = qs.query_id) AS vector_hits,
(SELECT count(*) FROM kr JOIN vr USING (query_id, child_segment_id) WHERE kr.query_id = qs.query_id) AS overlap,
CASE WHEN top1 IS NULL THEN 'zero_hit' WHEN contains(src, 'sqlite_child_keyword') AND contains(src, 'chroma_vector') THEN 'good' WHEN contains(txt, query_text) OR len(list_filter(string_split(query_text, ' '), lambda w: len(w) >= 2 AND contains(txt, w))) > 0 THEN 'good' WHEN k3 = 1 THEN 'good' WHEN query_id IN (SELECT query_id FROM vr) THEN 'acceptable' ELSE 'weak' END AS quality_label FROM qs LEFT JOIN pq USING (query_id)"""
)
def x27_quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X26 direct overlap, X27 label cascade, A17 counters, O2 overlap of routes."""
    segments, queries, title, keyword, vector = routes(spark, sf_dir)
    return R.quality_labels(queries, R.fuse(title, keyword, vector, K), segments, keyword, vector)


@query(
    f"WITH RECURSIVE {SEGMENTS_SQL}, d AS (SELECT count(*) AS segments, bit_xor(h) AS x, sum(h)::VARCHAR AS s FROM (SELECT ('0x' || substr(sha256(child_segment_id || '|' || segment_hash), 1, 15))::BIGINT AS h FROM sg)) SELECT 'run_' || substr(sha256('200|450|600|1|' || segments || '|' || x || '|' || s), 1, 16) AS run_id, segments FROM d"
)
def m18_run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M18 a run's id from its parameters and an order-free digest of its inputs: sum and xor of row digests, so nothing is gathered."""
    digest = fingerprint(segment_rows(spark, sf_dir), "child_segment_id", "segment_hash").toDF("segments", "x", "s")
    return digest.select(F.concat(F.lit("run_"), F.substring(sha256(F.concat_ws("|", F.lit("200|450|600|1"), F.col("segments").cast("string"), F.col("x").cast("string"), F.col("s").cast("string"))), 1, 16)).alias("run_id"), "segments")
