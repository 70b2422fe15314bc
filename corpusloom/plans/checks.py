"""Queries of layer checks, on stored rows with planted damage of every kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import sha256
from corpusloom.operators import chunking as C
from corpusloom.operators import dictionary as D
from corpusloom.operators import rules as R
from corpusloom.operators import verification as V
from corpusloom.plans import corpus_sql as S
from corpusloom.plans import entities
from corpusloom.plans import evidence as ev
from corpusloom.plans.corpus import BLOCK, SEGMENTS_SQL, block_rows, segment_rows, units
from corpusloom.plans.events import EVENT_SQL, Chain, wrap
from corpusloom.plans.registry import oracle_sql_of, query
from corpusloom.sources.chat import reply_contents
from corpusloom.sources.corpus import table


def digits(text: Column, first: int, n: int = 6) -> Column:
    """A number from hex digits of an id or hash, to choose the damage."""
    return F.conv(F.substring(text, first, n), 16, 10).cast("long")


def chosen(number: Column, cases: dict[int, Column], otherwise: Column) -> Column:
    out = None
    for k, value in cases.items():
        out = F.when(number == k, value) if out is None else out.when(number == k, value)
    return out.otherwise(otherwise)


def _none() -> Column:
    return F.lit(None).cast("string")


_SID = lambda c, p, i: f"{c} || '_p_' || printf('%04d', {p}) || '_s_' || printf('%04d', {i})"

EVIDENCE_SQL = f"""{EVENT_SQL},
e0 AS (SELECT *, ('0x' || substr(event_id, 5, 6))::BIGINT % 13 AS m FROM ev),
e1 AS (SELECT event_id, chapter_id, CASE WHEN m = 7 THEN 'old' ELSE version_id END AS version_id, CASE m WHEN 1 THEN 'gone' WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE sentence_id END AS sentence_id, CASE WHEN m = 6 THEN 'gone' ELSE para_id END AS para_id, CASE WHEN m = 0 THEN '' ELSE start_offset::VARCHAR END AS start_offset,
  CASE m WHEN 2 THEN start_offset::VARCHAR WHEN 3 THEN 'x9' WHEN 9 THEN '999999999' ELSE end_offset::VARCHAR END AS end_offset, CASE m WHEN 4 THEN 'bad' WHEN 8 THEN NULL ELSE sentence_hash END AS evidence_hash FROM e0),
e2 AS (SELECT e1.*, try_cast(start_offset AS BIGINT) AS s, try_cast(end_offset AS BIGINT) AS e, ch.content, ch.chapter_num IS NOT NULL AS has_chapter, CASE WHEN sentence_id IS NOT NULL THEN EXISTS (SELECT 1 FROM s2 WHERE s2.sentence_id = e1.sentence_id AND s2.version_id = e1.version_id) WHEN para_id IS NOT NULL THEN EXISTS (SELECT 1 FROM s2 WHERE s2.para_id = e1.para_id AND s2.version_id = e1.version_id) ELSE true END AS traced
  FROM e1 LEFT JOIN ch ON ch.chapter_id = e1.chapter_id AND ch.version_id = e1.version_id),
e3 AS (SELECT *, CASE WHEN s >= 0 AND e > s AND e <= len(content) THEN substr(content, s + 1, e - s) END AS cut FROM e2),
e4 AS (SELECT event_id AS evidence_id, CASE WHEN start_offset = '' OR end_offset = '' THEN 'missing_coordinate' WHEN NOT traced OR NOT has_chapter THEN 'missing_l2_source' WHEN cut IS NULL THEN 'offset_invalid' WHEN cut = '' THEN 'empty_text' WHEN evidence_hash <> sha256(cut) THEN 'hash_mismatch' ELSE 'ok' END AS status, cut FROM e3)"""


@query(wrap(EVIDENCE_SQL, "SELECT evidence_id, status, CASE WHEN status IN ('empty_text', 'hash_mismatch', 'ok') THEN sha256(cut) END AS text_hash FROM e4"))
def x42_backcut_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X42 evidence of every event cut out of its chapter again, with what is wrong."""
    c = Chain(spark, sf_dir)
    m = digits(F.col("event_id"), 5) % 13
    text = lambda name: F.col(name).cast("string")
    damaged = c.events.select(
        F.col("event_id").alias("evidence_id"), "chapter_id", chosen(m, {7: F.lit("old")}, F.col("version_id")).alias("version_id"), chosen(m, {1: F.lit("gone"), 5: _none(), 6: _none()}, F.col("sentence_id")).alias("sentence_id"), chosen(m, {6: F.lit("gone")}, F.col("para_id")).alias("para_id"),
        chosen(m, {0: F.lit("")}, text("start_offset")).alias("start_offset"), chosen(m, {2: text("start_offset"), 3: F.lit("x9"), 9: F.lit("999999999")}, text("end_offset")).alias("end_offset"), chosen(m, {4: F.lit("bad"), 8: _none()}, F.col("sentence_hash")).alias("evidence_hash"),
    )
    paragraphs = c.sentences.select("para_id", "version_id").distinct()
    return V.backcut_status(damaged, c.sentences, paragraphs, c.units).select("evidence_id", "status", sha256(F.col("evidence_text")).alias("text_hash"))


def stored_segments(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments and links as they are stored; beside a link its segment's last position."""
    inside = lambda u: F.substring(F.col("segment_text"), (u["s"] - F.col("start_offset") + 1).cast("int"), u["e"] - u["s"])
    first, last = F.get("sentences", F.lit(0)), F.element_at("sentences", -1)
    part = F.transform("sentences", lambda u: F.concat_ws("-", u["s"].cast("string"), u["e"].cast("string"), sha256(inside(u))))
    sid = lambda u: C.sentence_id("chapter_id", u["para"], u["i"])
    segments = rows.withColumns({
        "first_sentence_id": sid(first), "last_sentence_id": sid(last), "first_para_id": C.paragraph_id("chapter_id", first["para"]), "last_para_id": C.paragraph_id("chapter_id", last["para"]), "paragraph_count": F.size(F.array_distinct(F.transform("sentences", lambda u: u["para"]))).cast("long"),
        "has_overlap": F.col("overlap_sentences") > 0, "source_fingerprint": V.fingerprint_of(F.array_join(part, ";")),
    })
    linked = rows.select("child_segment_id", "chapter_id", "version_id", "segment_hash", "overlap_sentences", F.size("sentences").alias("top"), F.posexplode(F.transform("sentences", lambda u: F.struct(u["s"].alias("s"), u["e"].alias("e"), u["para"].alias("para"), u["i"].alias("i"), sha256(inside(u)).alias("h")))).alias("k", "u"))
    links = linked.select("child_segment_id", "chapter_id", "version_id", "segment_hash", (F.col("k") + 1).cast("long").alias("position"), sid(F.col("u")).alias("sentence_id"), F.col("u.s").cast("long").alias("start_offset"), F.col("u.e").cast("long").alias("end_offset"), F.col("u.h").alias("sentence_hash"), (F.col("k") < F.col("overlap_sentences")).alias("is_overlap"), "top")
    return segments.drop("sentences"), links


STORED_SQL = f"""{SEGMENTS_SQL},
s2 AS (SELECT {_SID('ch.chapter_id', 'para_index', 'sentence_index')} AS t_id, ch.chapter_id || '_p_' || printf('%04d', para_index) AS t_para, ch.chapter_id AS t_chapter, ch.version_id AS t_version, chapter_num, para_index, start_offset AS t_start, end_offset AS t_end, sha256(sentence_text) AS t_hash FROM se JOIN ch USING (chapter_num)),
l0 AS (SELECT sg.child_segment_id, sg.chapter_id, sg.version_id, sg.segment_hash, si.i - go.f + 1 AS position, t_id AS sentence_id, t_para AS para_id, t_start AS start_offset, t_end AS end_offset, t_hash AS sentence_hash, si.i < go.lo AS is_overlap FROM sg JOIN go ON go.chapter_num = sg.chapter_num AND go.scene_index = sg.scene_index AND go.g = sg.segment_index JOIN si ON si.chapter_num = go.chapter_num AND si.scene_index = go.scene_index AND si.i BETWEEN go.f AND go.hi JOIN s2 ON s2.chapter_num = si.chapter_num AND s2.t_start = si.s),
sa AS (SELECT child_segment_id, arg_min(sentence_id, position) AS first_sentence_id, arg_max(sentence_id, position) AS last_sentence_id, arg_min(para_id, position) AS first_para_id, arg_max(para_id, position) AS last_para_id, count(DISTINCT para_id) AS paragraph_count, string_agg(start_offset || '-' || end_offset || '-' || sentence_hash, ';' ORDER BY position) AS parts FROM l0 GROUP BY ALL),
sx AS (SELECT sg.*, sa.* EXCLUDE (child_segment_id, parts), overlap_sentences > 0 AS has_overlap, sha256(scene_key || '|' || chapter_id || '|' || version_id || '|' || chapter_num || '|' || parts) AS source_fingerprint FROM sg JOIN sa USING (child_segment_id))"""


@query(f"""WITH RECURSIVE {STORED_SQL},
st AS (SELECT child_segment_id, CASE WHEN m = 15 THEN -1 ELSE chapter_num END AS chapter_num, chapter_id, CASE WHEN m = 6 THEN 'old' ELSE version_id END AS version_id, CASE WHEN m = 3 THEN 'nowhere' ELSE scene_key END AS scene_key, CASE WHEN m = 1 THEN start_offset + 1 ELSE start_offset END AS start_offset, end_offset, CASE WHEN m = 2 THEN sentence_count + 1 ELSE sentence_count END AS sentence_count, CASE WHEN m = 7 THEN paragraph_count + 1 ELSE paragraph_count END AS paragraph_count, CASE WHEN m = 16 THEN 'x' ELSE first_sentence_id END AS first_sentence_id, last_sentence_id, first_para_id, CASE WHEN m = 16 THEN 'x' ELSE last_para_id END AS last_para_id,
  CASE WHEN m = 0 THEN segment_text || 'x' ELSE segment_text END AS segment_text, segment_hash, CASE WHEN m = 8 THEN 'x' ELSE source_fingerprint END AS source_fingerprint, has_overlap, CASE m WHEN 4 THEN NULL WHEN 5 THEN 'none' ELSE previous_child_id END AS previous_child_id FROM (SELECT *, ('0x' || substr(segment_hash, 1, 6))::BIGINT % 23 AS m FROM sx)),
lk AS (SELECT child_segment_id, chapter_id, version_id, CASE WHEN m = 10 THEN position + 1 ELSE position END AS position, CASE WHEN m = 11 AND position = 1 THEN 'gone' ELSE sentence_id END AS sentence_id, CASE WHEN m = 12 THEN start_offset + 1 ELSE start_offset END AS start_offset, end_offset, CASE WHEN m = 13 THEN 'x' ELSE sentence_hash END AS sentence_hash, is_overlap FROM (SELECT *, ('0x' || substr(segment_hash, 1, 6))::BIGINT % 23 AS m, max(position) OVER (PARTITION BY child_segment_id) AS top FROM l0) WHERE m <> 14 AND NOT (m = 9 AND position = top)),
x AS (SELECT st.*, c.chapter_num AS c_num, c.chapter_id AS c_id, c.version_id AS c_version, c.content, b.scene_key AS b_key, b.chapter_id AS b_chapter, b.version_id AS b_version, b.start_offset AS b_start, b.end_offset AS b_end FROM st LEFT JOIN ch c ON c.chapter_num = st.chapter_num LEFT JOIN bl b ON b.scene_key = st.scene_key),
pr AS (SELECT DISTINCT child_segment_id AS p_child, sentence_id AS p_sentence FROM lk),
lj AS (SELECT lk.*, x.chapter_id AS g_chapter, x.version_id AS g_version, b_start, b_end, s2.* EXCLUDE (chapter_num, para_index), p_child FROM lk JOIN x USING (child_segment_id) LEFT JOIN s2 ON s2.t_id = lk.sentence_id LEFT JOIN pr ON is_overlap AND p_child = x.previous_child_id AND p_sentence = lk.sentence_id),
k AS (SELECT child_segment_id, count(*) AS n, min(position) <> 1 OR max(position) <> count(*) OR count(DISTINCT position) <> count(*) AS gap, bool_or(chapter_id <> g_chapter OR version_id <> g_version) AS identity, bool_or(t_id IS NULL) AS untraced, bool_or(t_chapter <> g_chapter OR t_version <> g_version) AS other, bool_or(t_start < b_start OR t_end > b_end) AS outside, bool_or(start_offset <> t_start) AS ls, bool_or(end_offset <> t_end) AS le, bool_or(sentence_hash <> t_hash) AS lh, bool_or(is_overlap) AS linked, bool_or(is_overlap AND p_child IS NULL) AS stray,
  arg_min({{'id': t_id, 'p': t_para, 'o': t_start}}, position) AS f, arg_max({{'id': t_id, 'p': t_para, 'o': t_end}}, position) AS l, count(DISTINCT t_para) AS paras, string_agg(t_start || '-' || t_end || '-' || t_hash, ';' ORDER BY position) AS parts FROM lj GROUP BY child_segment_id),
y AS (SELECT x.*, k.* EXCLUDE (child_segment_id), c_num IS NOT NULL AND b_key IS NOT NULL AS sc, n IS NOT NULL AS hl, NOT untraced AS tr, CASE WHEN start_offset >= 0 AND end_offset > start_offset AND end_offset <= len(content) THEN substr(content, start_offset + 1, end_offset - start_offset) END AS cut FROM x LEFT JOIN k USING (child_segment_id))
SELECT child_segment_id, unnest(list_filter([CASE WHEN c_num IS NULL THEN 'chapter_missing' END, CASE WHEN chapter_id <> c_id OR version_id <> c_version THEN 'chapter_identity' END, CASE WHEN c_num IS NOT NULL AND b_key IS NULL THEN 'scene_missing' END,
  CASE WHEN sc AND (chapter_id <> b_chapter OR version_id <> b_version) THEN 'scene_identity' END, CASE WHEN sc AND (start_offset < b_start OR end_offset > b_end) THEN 'scene_boundary' END, CASE WHEN sc AND sentence_count < 1 THEN 'no_sentences' END, CASE WHEN sc AND coalesce(n, 0) <> sentence_count THEN 'link_count' END, CASE WHEN sc AND n IS NULL THEN 'no_links' END,
  CASE WHEN sc AND hl AND gap THEN 'link_position_gap' END, CASE WHEN sc AND hl AND identity THEN 'link_identity' END, CASE WHEN sc AND hl AND untraced THEN 'sentence_untraced' END, CASE WHEN sc AND hl AND other THEN 'sentence_of_other_chapter' END, CASE WHEN sc AND hl AND outside THEN 'sentence_out_of_scene' END, CASE WHEN sc AND hl AND ls THEN 'link_start' END, CASE WHEN sc AND hl AND le THEN 'link_end' END, CASE WHEN sc AND hl AND lh THEN 'link_hash' END,
  CASE WHEN sc AND hl AND tr AND first_sentence_id <> f.id THEN 'first_sentence' END, CASE WHEN sc AND hl AND tr AND last_sentence_id <> l.id THEN 'last_sentence' END, CASE WHEN sc AND hl AND tr AND start_offset <> f.o THEN 'starts_inside_sentence' END, CASE WHEN sc AND hl AND tr AND end_offset <> l.o THEN 'ends_inside_sentence' END, CASE WHEN sc AND hl AND tr AND segment_text IS DISTINCT FROM cut THEN 'text_backcut' END, CASE WHEN sc AND hl AND tr AND segment_hash <> sha256(segment_text) THEN 'text_hash' END,
  CASE WHEN sc AND hl AND tr AND source_fingerprint <> sha256(scene_key || '|' || chapter_id || '|' || version_id || '|' || chapter_num || '|' || parts) THEN 'source_fingerprint' END, CASE WHEN sc AND hl AND tr AND paragraph_count <> paras THEN 'paragraph_count' END, CASE WHEN sc AND hl AND tr AND (first_para_id <> f.p OR last_para_id <> l.p) THEN 'paragraph_boundary' END,
  CASE WHEN sc AND hl AND tr AND has_overlap AND previous_child_id IS NULL THEN 'overlap_without_source' END, CASE WHEN sc AND hl AND tr AND has_overlap AND previous_child_id IS NOT NULL AND NOT linked THEN 'overlap_without_links' END, CASE WHEN sc AND hl AND tr AND has_overlap AND previous_child_id IS NOT NULL AND stray THEN 'overlap_not_from_previous' END], lambda c: c IS NOT NULL)) AS code FROM y""")
def m15_segment_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 every stored segment and link against blocks, sentences and chapters, P22."""
    chapters = units(spark, sf_dir)
    segments, links = stored_segments(segment_rows(spark, sf_dir))
    m = digits(F.col("segment_hash"), 1) % 23
    c = F.col
    segments = segments.withColumns({
        "chapter_num": chosen(m, {15: F.lit(-1).cast("long")}, c("chapter_num")), "version_id": chosen(m, {6: F.lit("old")}, c("version_id")), "scene_key": chosen(m, {3: F.lit("nowhere")}, c("scene_key")), "start_offset": chosen(m, {1: c("start_offset") + 1}, c("start_offset")),
        "sentence_count": chosen(m, {2: c("sentence_count") + 1}, c("sentence_count")), "paragraph_count": chosen(m, {7: c("paragraph_count") + 1}, c("paragraph_count")), "first_sentence_id": chosen(m, {16: F.lit("x")}, c("first_sentence_id")), "last_para_id": chosen(m, {16: F.lit("x")}, c("last_para_id")),
        "segment_text": chosen(m, {0: F.concat("segment_text", F.lit("x"))}, c("segment_text")), "source_fingerprint": chosen(m, {8: F.lit("x")}, c("source_fingerprint")), "previous_child_id": chosen(m, {4: _none(), 5: F.lit("none")}, c("previous_child_id")),
    })
    links = links.filter((m != 14) & ~((m == 9) & (c("position") == c("top"))))
    links = links.withColumns({"sentence_id": F.when((m == 11) & (c("position") == 1), "gone").otherwise(c("sentence_id")), "start_offset": chosen(m, {12: c("start_offset") + 1}, c("start_offset")), "sentence_hash": chosen(m, {13: F.lit("x")}, c("sentence_hash"))}).withColumn("position", chosen(m, {10: c("position") + 1}, c("position")))
    return V.segment_violations(segments, links, block_rows(spark, sf_dir), C.sentences(chapters), chapters)


@query(f"WITH RECURSIVE {STORED_SQL} SELECT child_segment_id, sha256('{{\"chapter_id\":\"' || chapter_id || '\",\"chapter_num\":' || chapter_num || ',\"child_segment_id\":\"' || child_segment_id || '\",\"end_para_id\":\"' || last_para_id || '\",\"end_sentence_id\":\"' || last_sentence_id || '\",\"scene_id\":\"' || scene_key || '\",\"segment_text_hash\":\"' || segment_hash || '\",\"source_fingerprint\":\"' || source_fingerprint || '\",\"start_para_id\":\"' || first_para_id || '\",\"start_sentence_id\":\"' || first_sentence_id || '\"}}') AS evidence_hash FROM sx")
def x39_segment_evidence_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X39 the evidence hash of every stored segment."""
    segments, _ = stored_segments(segment_rows(spark, sf_dir))
    return segments.select("child_segment_id", V.segment_evidence_hash(segments).alias("evidence_hash"))


SPAN_SQL = f"""{S.SENTENCES}, {entities.SENT_SQL}, {entities.PATTERN_SQL},
x0 AS (SELECT owner_id, pattern, chapter_num, sentence_id, unnest({entities.OCC('sentence_text', 'pattern')}) AS start FROM sn JOIN zp ON contains(sentence_text, pattern) AND len(list_filter(negatives, lambda n: contains(sentence_text, n))) = 0),
ps AS (SELECT chapter_num, para_index, start_offset AS p_start, para_text FROM pa),
xs AS (SELECT x0.*, sn.chapter_id, sn.para_id, sn.sentence_text, sn.start_offset - p_start AS lead, para_text FROM x0 JOIN sn USING (chapter_num, sentence_id) JOIN ps ON ps.chapter_num = x0.chapter_num AND sn.para_id = sn.chapter_id || '_p_' || printf('%04d', para_index))"""


def span_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dictionary spans with their paragraph and its lead, sentences, paragraphs."""
    chapters = units(spark, sf_dir)
    sentences = C.sentences(chapters)
    paragraphs = C.paragraphs(chapters).withColumn("para_id", C.paragraph_id("chapter_id", "para_index"))
    rows = [(z, p, entities.NEGATIVES[z]) for z, found in entities.ZONES for p in found]
    spans = D.pattern_spans(sentences, spark.createDataFrame(rows, "owner_id string, pattern string, negatives array<string>"))
    spans = spans.join(sentences.select("sentence_id", "chapter_id", "para_id", F.col("start_offset").alias("s_start")), "sentence_id").join(paragraphs.select("para_id", F.col("start_offset").alias("p_start")), "para_id")
    return spans.withColumn("lead", F.col("s_start") - F.col("p_start")).drop("s_start", "p_start"), sentences, paragraphs


@query(f"""WITH {SPAN_SQL},
xd AS (SELECT owner_id, m, CASE WHEN m = 2 THEN substr(para_text, start + lead + 1, len(pattern)) WHEN m = 3 THEN substr(sentence_text, start + 2, greatest(0, len(pattern) - 1)) ELSE substr(sentence_text, start + 1, len(pattern)) END AS cut, CASE WHEN m = 0 THEN 'wrong' ELSE pattern END AS evidence_text, CASE WHEN m = 1 THEN 'x' WHEN m = 0 THEN sha256('wrong') ELSE sha256(pattern) END AS evidence_hash FROM (SELECT *, (chapter_num + start) % 7 AS m FROM xs))
SELECT owner_id, count(*) AS spans, count(*) FILTER (cut IS DISTINCT FROM evidence_text) AS backcut_errors, count(*) FILTER (sha256(evidence_text) <> evidence_hash) AS hash_errors FROM xd GROUP BY owner_id""")
def m16_span_backcuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 spans cut out of their sentence, or their paragraph, again."""
    spans, sentences, paragraphs = span_rows(spark, sf_dir)
    m, c = (F.col("chapter_num") + F.col("start")) % 7, F.col
    text = chosen(m, {0: F.lit("wrong")}, c("pattern"))
    damaged = spans.select(
        "owner_id", "chapter_id", chosen(m, {2: _none()}, c("sentence_id")).alias("sentence_id"), "para_id", chosen(m, {2: c("start") + c("lead"), 3: c("start") + 1}, c("start")).alias("start"), chosen(m, {2: c("end") + c("lead")}, c("end")).alias("end"),
        text.alias("evidence_text"), chosen(m, {1: F.lit("x")}, sha256(text)).alias("evidence_hash"),
    )
    return V.span_backcuts(damaged, sentences, paragraphs)


@query(f"WITH RECURSIVE {S.blocks(BLOCK)}, r AS ({oracle_sql_of('j10_same_scene')}), d AS (SELECT relation_id, chapter_id, version_id, CASE WHEN substr(relation_id, 5, 1) IN ('0', '1', '2') THEN 'nowhere' ELSE scene_block_id END AS scene_block_id FROM r) SELECT relation_id, scene_block_id FROM d ANTI JOIN bl ON bl.scene_key = d.scene_block_id AND bl.chapter_id = d.chapter_id AND bl.version_id = d.version_id")
def m17_scene_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M17 relations of one scene whose scene is not stored."""
    relations = entities.j10_same_scene(spark, sf_dir)
    lost = F.substring("relation_id", 5, 1).isin("0", "1", "2")
    relations = relations.withColumn("scene_block_id", F.when(lost, "nowhere").otherwise(F.col("scene_block_id")))
    return V.missing_scenes(relations, block_rows(spark, sf_dir)).select("relation_id", "scene_block_id")


KINDS = (*V.CANDIDATE_TABLES, "other_candidate")
_kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"


@query(f"""WITH {SPAN_SQL},
ca AS (SELECT *, (chapter_num * 3 + start) AS q, 'cand_' || owner_id || '_' || sentence_id || '_' || start AS candidate_id FROM xs),
ac AS (SELECT *, {_kinds}[(q % 5 + 1)::INT] AS kind, CASE WHEN q % 11 = 0 THEN 'gone' ELSE pattern END AS evidence_text FROM ca WHERE q % 3 = 0),
ta AS (SELECT *, CASE kind {" ".join(f"WHEN '{k}' THEN '{t}'" for k, t in V.CANDIDATE_TABLES.items())} END AS target FROM ac WHERE evidence_text = pattern)
SELECT target, 'dz_' || substr(sha256(target || '|' || candidate_id), 1, 16) AS row_id, CASE WHEN q % 2 = 0 THEN 'human_zone' ELSE owner_id END AS owner_id, candidate_id, chapter_id, sentence_id, CASE WHEN q % 4 = 1 THEN 'h_type' ELSE 'o_type' END AS owner_type, CASE WHEN q % 5 = 0 THEN 'unknown' WHEN q % 7 = 0 THEN 'seen' ELSE 'guess' END AS appearance_type, CASE WHEN q % 2 = 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS confidence, sha256(pattern) AS evidence_hash, 'accepted' AS review_status FROM ta WHERE target IS NOT NULL QUALIFY row_number() OVER (PARTITION BY target, candidate_id ORDER BY evidence_hash) = 1""")
def m04_applied_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 accepted candidates as rows of four tables, human values over guesses."""
    spans, sentences, _ = span_rows(spark, sf_dir)
    q = F.col("chapter_num") * 3 + F.col("start")
    rows = spans.select(
        F.concat(F.lit("cand_"), "owner_id", F.lit("_"), "sentence_id", F.lit("_"), F.col("start").cast("string")).alias("candidate_id"), F.get(F.array(*map(F.lit, KINDS)), (q % 5).cast("int")).alias("candidate_type"), "chapter_id", "sentence_id", "start", "end",
        F.when(q % 11 == 0, "gone").otherwise(F.col("pattern")).alias("evidence_text"), "owner_id", F.lit("o_type").alias("owner_type"), F.when(q % 5 == 0, "").otherwise("guess").alias("type_guess"), F.when(q % 2 == 0, 1.0).otherwise(0.5).alias("score"),
        F.when(q % 2 == 0, "human_zone").alias("human_owner_id"), F.when(q % 4 == 1, "h_type").otherwise("").alias("human_owner_type"), F.when((q % 7 == 0) & (q % 5 != 0), "seen").alias("human_type"), F.when(q % 3 == 0, "accepted").when(q % 3 == 1, "rejected").alias("human_status"),
    )
    return V.applied_review(rows, sentences)


PACKET_SQL = f"""{S.PARAGRAPHS}, {ev.FOUND_SQL},
ca AS (SELECT seed_item_id, place, CASE WHEN place % 4 = 0 THEN evidence_id END AS candidate_id, CASE WHEN place % 4 = 1 THEN 'p' || para_index END AS paragraph_id, CASE WHEN place % 8 <> 3 THEN 'c' || chapter_num END AS chapter_id, CASE WHEN place % 12 <> 7 THEN para_hash END AS paragraph_hash, para_text FROM ev),
en AS (SELECT *, CASE WHEN candidate_id IS NOT NULL THEN candidate_id WHEN paragraph_id IS NOT NULL THEN seed_item_id || ':' || paragraph_id ELSE seed_item_id || ':' || coalesce(chapter_id, 'unknown_chapter') || ':' || coalesce(paragraph_hash, 'unknown_hash') END AS entry_id FROM ca),
rv AS (SELECT entry_id AS r_key, CASE WHEN min(place) % 3 <> 0 THEN 'seen' END AS note FROM en WHERE place % 2 = 0 GROUP BY entry_id)"""


@query(f"WITH {PACKET_SQL} SELECT entry_id, seed_item_id, chapter_id, paragraph_hash, CASE WHEN r_key IS NOT NULL THEN 'accepted' WHEN place % 5 = 0 THEN 'needs_more' END AS entry_status, CASE WHEN r_key IS NOT NULL THEN coalesce(note, 'r') ELSE 'own' END AS entry_note, sha256(para_text) AS text_hash FROM en LEFT JOIN rv ON r_key = entry_id")
def m07_packet_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 entries of a review packet: identity by precedence, the reviewer's word over the candidate's."""
    place, c = F.col("place"), F.col
    rows = ev.found(spark, sf_dir)
    candidates = rows.select(
        "seed_item_id", "place", F.when(place % 4 == 0, c("evidence_id")).alias("candidate_id"), F.when(place % 4 == 1, F.concat(F.lit("p"), "para_index")).alias("paragraph_id"), F.when(place % 8 != 3, F.concat(F.lit("c"), "chapter_num")).alias("chapter_id"), F.when(place % 12 != 7, c("para_hash")).alias("paragraph_hash"),
        F.when(place % 3 == 0, "").otherwise(c("para_text")).alias("evidence_text"), c("para_text").alias("paragraph_text"), F.when(place % 5 == 0, "needs_more").alias("human_status"), _none().alias("human_note"), F.lit("own").alias("review_note"),
    )
    identified = candidates.withColumn("entry_id", V.candidate_identity())
    reviews = identified.filter(place % 2 == 0).groupBy(c("entry_id").alias("review_key")).agg(F.min("place").alias("p")).select("review_key", F.lit("accepted").alias("human_status"), F.when(c("p") % 3 != 0, "seen").alias("human_note"), F.lit("r").alias("review_note"))
    return V.packet_entries(candidates, reviews).select("entry_id", "seed_item_id", "chapter_id", "paragraph_hash", "entry_status", "entry_note", sha256(c("entry_text")).alias("text_hash"))


_fields = [f"CASE WHEN doc_id % {n} = 0 THEN '{name}_' || doc_id END" for n, name in zip((9, 7, 6, 5, 4, 3), V.SEED_IDENTITIES[:6], strict=True)]


@query(f"SELECT doc_id, coalesce({', '.join(_fields)}, CASE WHEN doc_id % 2 = 0 THEN '$.' || doc_id END, 'unknown_seed_item') AS seed_item_id FROM documents")
def m07_seed_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 identity of a seed item by precedence."""
    i = F.col("doc_id")
    field = lambda n, name: F.when(i % n == 0, F.concat(F.lit(f"{name}_"), i.cast("string"))).otherwise(F.lit("")).alias(name)
    inner = [field(n, name) for n, name in zip((7, 6, 5, 4, 3), V.SEED_IDENTITIES[1:6], strict=True)]
    path = F.when(i % 2 == 0, F.concat(F.lit("$."), i.cast("string"))).alias("item_path")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.struct(field(9, "item_id"), path).alias("source"), F.struct(*inner).alias("content"))
    return rows.select("doc_id", V.seed_identity(source="source", content="content").alias("seed_item_id"))


CATEGORIES, TYPES, FLAGS = ["movement", "speech", "conflict", "information"], ["movement_arrive", "attack", "reveal", "rain"], ["weak_candidate", "missing_scene"]
_in = lambda xs: ", ".join(f"'{x}'" for x in xs)


@query(wrap(EVENT_SQL + ", wb AS (SELECT event_family AS trigger_category, event_type AS event_type_candidate, ['[\"weak_candidate\"]', '[\"odd\", \"missing_scene\"]', '{broken', '', '[]'][(('0x' || substr(event_id, 5, 6))::BIGINT % 5 + 1)::INT] AS j FROM ev)", f"""SELECT 'missing_field' AS finding, 'reviewer' AS value
UNION ALL SELECT DISTINCT 'unknown_trigger_category', trigger_category FROM wb WHERE trigger_category NOT IN ({_in(CATEGORIES)}) UNION ALL SELECT DISTINCT 'unknown_event_type_candidate', event_type_candidate FROM wb WHERE event_type_candidate NOT IN ({_in(TYPES)})
UNION ALL SELECT 'unknown_flag', 'odd' UNION ALL SELECT 'invalid_flag_rows', count(*)::VARCHAR FROM wb WHERE j = '{{broken'"""))
def m09_workbook_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 an exported review workbook's missing columns, unknown values and broken flags."""
    flags = F.array(*map(F.lit, ('["weak_candidate"]', '["odd", "missing_scene"]', "{broken", "", "[]")))
    rows = Chain(spark, sf_dir).events.select(F.col("event_family").alias("trigger_category"), F.col("event_type").alias("event_type_candidate"), F.get(flags, (digits(F.col("event_id"), 5) % 5).cast("int")).alias("warning_flags_json"))
    return V.workbook_findings(rows, ["trigger_category", "event_type_candidate", "warning_flags_json", "reviewer"], {"trigger_category": CATEGORIES, "event_type_candidate": TYPES}, FLAGS)


FORBIDDEN = ["ASIA", "EUROPE", "ATLANTIS"]


@query(f"SELECT DISTINCT r_name AS name FROM region WHERE r_name IN ({_in(FORBIDDEN)})")
def o05_forbidden_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5 names that must not exist."""
    return V.forbidden_tables(table(spark, sf_dir, "region").select(F.col("r_name").alias("name")), FORBIDDEN)


SOURCES = {"region": ("r_regionkey", "r_name"), "nation": ("n_nationkey", "n_name", "n_regionkey"), "labels": ("doc_id", "quality", "toxic"), "benchmark": ("item_id", "text"), "conversations": ("conv_id", "turn", "role", "text")}
_digest = lambda cols: f"('0x' || substr(sha256({' || chr(124) || '.join(f'coalesce({c}::VARCHAR, {chr(39)}None{chr(39)})' for c in cols)}), 1, 15))::BIGINT"


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows, bit_xor(h) AS xor, sum(h)::VARCHAR AS total FROM (SELECT {_digest(cols)} AS h FROM {t})" for t, cols in SOURCES.items() if t != "labels"))
def m19_source_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M19 fingerprints of all source tables but one's own layer."""
    return R.source_fingerprints({t: table(spark, sf_dir, t).select(*cols) for t, cols in SOURCES.items()}, ["labels"])


CASES = (("fake_ok", '{"ok": true}'), ("fake_empty_response", " "), ("fake_invalid_json", "{broken"), ("fixture_ok", 'Here:\n```json\n{"ok": true, "n": 1}\n```'), ("fixture_text", '{"ok": "true"}'), ("fixture_empty_response", '{"ok": true}'))
CASE_SQL = "cs AS (SELECT conv_id AS run_id, turn, (conv_id * 7 + turn) % 6 AS k, [" + ", ".join(f"'{n}'" for n, _ in CASES) + "][((conv_id * 7 + turn) % 6 + 1)::INT] AS name, CASE WHEN (conv_id * 7 + turn) % 6 IN (0, 3, 5) THEN 'PASS' ELSE 'FAIL' END AS status FROM conversations)"
RUN_SQL = """ru AS (SELECT run_id, CASE WHEN run_id % 13 = 0 THEN 'BLOCKED' ELSE 'FAIL' END AS status, CASE WHEN run_id % 5 = 0 THEN 'FAIL' ELSE 'PASS' END AS sandbox_status, CASE WHEN run_id % 4 = 0 THEN 'PASS' ELSE 'FULL PASS' END AS verifier_status, run_id % 3 AS response_count, run_id % 7 AS valid_response_count, CASE WHEN run_id % 8 = 0 THEN 1 ELSE 0 END AS invalid_response_count, run_id % 6 = 0 AS leak, run_id % 9 <> 0 AS read_only FROM (SELECT DISTINCT conv_id AS run_id FROM conversations)),
re AS (SELECT run_id, unnest(list_filter([CASE WHEN sandbox_status <> 'PASS' THEN 'sandbox_status must be PASS' END, CASE WHEN verifier_status <> 'FULL PASS' THEN 'verifier_status must be FULL PASS' END, CASE WHEN response_count <= 0 THEN 'response_count must be > 0' END, CASE WHEN valid_response_count <= 0 THEN 'valid_response_count must be > 0' END, CASE WHEN invalid_response_count <> 0 THEN 'invalid_response_count must be 0' END, CASE WHEN leak THEN 'api key leak detected in generated or checked artifacts' END, CASE WHEN NOT read_only THEN 'read_only must be true' END], lambda e: e IS NOT NULL)) AS error FROM ru WHERE status <> 'BLOCKED'),
ce AS (SELECT run_id, CASE WHEN name IN ('fake_empty_response', 'fake_invalid_json', 'fixture_empty_response', 'fixture_invalid_json') THEN CASE WHEN status <> 'FAIL' THEN name || ' must FAIL' END ELSE CASE WHEN status <> 'PASS' THEN name || ' must PASS' END END AS error FROM cs)"""


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = ((F.col("conv_id") * 7 + F.col("turn")) % 6).cast("int")
    pick = lambda i: F.get(F.array(*(F.lit(c[i]) for c in CASES)), k)
    return V.reply_cases(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("run_id"), "turn", pick(0).alias("name"), pick(1).alias("raw_content")))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("run_id")
    zero, no = F.lit(0), F.lit(False)
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("run_id")).distinct()
    return rows.withColumns({
        "status": F.when(i % 13 == 0, "BLOCKED").otherwise("FAIL"), "sandbox_status": F.when(i % 5 == 0, "FAIL").otherwise("PASS"), "verifier_status": F.when(i % 4 == 0, "PASS").otherwise("FULL PASS"), "response_count": i % 3, "valid_response_count": i % 7, "invalid_response_count": F.when(i % 8 == 0, 1).otherwise(0),
        **{c: zero for c in ("empty_raw_response_count", "json_parse_error_count", "out_of_pack_fact_ref_count", "out_of_pack_evidence_ref_count", "source_table_mutation_count", "forbidden_final_table_count")}, "api_key_leak_detected": i % 6 == 0, "read_only": i % 9 != 0, **{c: no for c in ("sqlite_write", "chroma_write", "embedding_call", "source_mutation")},
    })


@query(f"WITH {CASE_SQL} SELECT run_id, turn, name, k = 1 AS raw_empty, k NOT IN (1, 2) AS json_ok, status FROM cs")
def p07_reply_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 raw replies of a regression suite, each judged by itself."""
    return cases(spark, sf_dir).drop("raw_content")


@query(f"WITH {CASE_SQL}, {RUN_SQL} SELECT * FROM re UNION ALL SELECT * FROM ce WHERE error IS NOT NULL")
def m21_run_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M21 pass conditions that runs don't meet, and cases that ended the wrong way."""
    return V.run_errors(runs(spark, sf_dir)).unionByName(V.case_errors(cases(spark, sf_dir)))


@query(f"WITH {CASE_SQL}, {RUN_SQL}, er AS (SELECT run_id, count(*) AS errors FROM (SELECT * FROM re UNION ALL SELECT * FROM ce WHERE error IS NOT NULL) GROUP BY run_id) SELECT run_id, CASE WHEN status = 'BLOCKED' THEN 'BLOCKED' WHEN errors > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN status = 'BLOCKED' THEN 0 ELSE coalesce(errors, 0) END AS errors FROM ru LEFT JOIN er USING (run_id)")
def p07_run_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 a verdict for each run over its conditions and cases."""
    all_errors = V.run_errors(runs(spark, sf_dir)).unionByName(V.case_errors(cases(spark, sf_dir)))
    return V.run_verdicts(runs(spark, sf_dir), all_errors)


@query("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'API_KEY_MISSING' WHEN a = 'BLOCKED' OR b = 'BLOCKED' OR c = 'BLOCKED' THEN 'REAL_LLM_NOT_CALLED' WHEN a = 'FAIL' AND doc_id % 2 = 0 THEN CASE WHEN doc_id % 3 <> 0 THEN 'API_ERROR' ELSE 'REAL_LLM_CONNECTED_JSON_FAILED' END WHEN c = 'FAIL' THEN 'REGRESSION_FAILED' WHEN a = 'PASS' AND b = 'PASS' AND c = 'PASS' THEN 'FULL_PASS' ELSE 'ENGINEERING_PASS_REAL_LLM_BLOCKED' END AS final_status
FROM (SELECT doc_id, ['PASS', 'FAIL', 'BLOCKED', 'PASS'][(doc_id % 4 + 1)::INT] AS a, ['PASS', 'PASS', 'FAIL', 'BLOCKED', 'PASS'][(doc_id % 5 + 1)::INT] AS b, ['PASS', 'FAIL', 'PASS'][(doc_id % 3 + 1)::INT] AS c FROM documents)""")
def m22_final_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M22 the diagnosis over a connection test and two stages."""
    i = F.col("doc_id")
    pick = lambda xs: F.get(F.array(*map(F.lit, xs)), (i % len(xs)).cast("int"))
    status = V.final_status(F.when(i % 7 == 0, "missing").otherwise("present"), pick(["PASS", "FAIL", "BLOCKED", "PASS"]), pick(["PASS", "PASS", "FAIL", "BLOCKED", "PASS"]), pick(["PASS", "FAIL", "PASS"]), i % 2 == 0, i % 3 == 0)
    return table(spark, sf_dir, "documents").select("doc_id", status.alias("final_status"))


@query(wrap(EVENT_SQL, "SELECT event_id, chapter_num, para_id, sentence_id FROM ev WHERE chapter_num IN (3, 5, 8, 13, 21)"))
def f17_scoped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F17 events of a sample's chapters, in export order."""
    events = Chain(spark, sf_dir).events.withColumn("scene_key", _none())
    return V.scoped_events(events, [21, 3, 5, 13, 8]).select("event_id", "chapter_num", "para_id", "sentence_id")


SHAPES = (
    ('{"choices": [{"message": {"content": "c@"}, "text": "no"}]}', "c@", "choices[0].message.content"), ('{"choices": [{"message": {"content": [{"text": "a"}, {"text": "@"}, 3]}}]}', "a@", "choices[0].message.content"), ('{"choices": [{"text": "t@"}], "output_text": "no"}', "t@", "choices[0].text"),
    ('{"choices": [], "output_text": "o@"}', "o@", "output_text"), ('{"content": [{"text": "r@"}]}', "r@", "response.content"), ('{"choices": "odd"}', "", ""), ("[1]", "", ""), ("broken @", "", ""),
)


@query("SELECT conv_id, turn, " + ", ".join(f"replace([{_in([s[i] for s in SHAPES])}][((conv_id + turn) % {len(SHAPES)} + 1)::INT], '@', turn::VARCHAR) AS {name}" for i, name in ((1, "content"), (2, "place"))) + " FROM conversations")
def m20_reply_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M20 the text of a service's answer in each of its shapes."""
    raw = F.get(F.array(*(F.lit(s[0]) for s in SHAPES)), ((F.col("conv_id") + F.col("turn")) % len(SHAPES)).cast("int"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.replace(raw, F.lit("@"), F.col("turn").cast("string")).alias("raw"))
    return rows.withColumn("r", reply_contents(F.col("raw"))).select("conv_id", "turn", "r.*")
