"""SQL of the corpus layers, as common table expressions that the queries' oracles share."""

BLANK = r"[^ \t\n\x0B\f\r\x{85}\x{a0}\x{3000}]"

CHAPTERS = """ch AS (SELECT doc_id + 1 AS chapter_num, 'ch_' || lpad((doc_id + 1)::VARCHAR, greatest(4, len((doc_id + 1)::VARCHAR))::INT, '0') AS chapter_id, 'ver_' || sha256(coalesce(text, '')) AS version_id, lang, source, coalesce(text, '') AS content FROM documents)"""

PARAGRAPHS = (
    CHAPTERS
    + """,
lines AS (SELECT chapter_num, unnest(list_transform(string_split(content, chr(10)), lambda s, i: {'i': i, 's': s})) AS l FROM ch),
placed AS (SELECT chapter_num, l.i AS line_no, l.s AS s, coalesce(sum(len(l.s) + 1) OVER (PARTITION BY chapter_num ORDER BY l.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS st FROM lines),
pa AS (SELECT chapter_num, row_number() OVER (PARTITION BY chapter_num ORDER BY line_no) AS para_index, st AS start_offset, st + len(s) AS end_offset, s AS para_text,
  CASE WHEN regexp_matches(s, '\\A[-*=_~ ]{3,}\\z') THEN 'separator' WHEN NOT regexp_matches(s, '\\p{L}') THEN 'noise' WHEN regexp_matches(lower(s), 'license|copyright') THEN 'author_note' WHEN regexp_matches(lower(s), 'https?://|www[.]') THEN 'promo' ELSE 'body' END AS para_kind
  FROM placed WHERE regexp_matches(s, '"""
    + BLANK
    + "'))"
)

SENTENCES = (
    PARAGRAPHS
    + """,
cuts AS (SELECT chapter_num, para_index, start_offset AS ps, unnest(list_transform(string_split(regexp_replace(para_text, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)), lambda s, i: {'i': i, 's': s})) AS c FROM pa),
placed_s AS (SELECT chapter_num, para_index, c.i AS cut_no, c.s AS s, ps + coalesce(sum(len(c.s) + 1) OVER (PARTITION BY chapter_num, para_index ORDER BY c.i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS st FROM cuts),
se AS (SELECT chapter_num, para_index, row_number() OVER (PARTITION BY chapter_num, para_index ORDER BY cut_no) AS sentence_index, row_number() OVER (PARTITION BY chapter_num ORDER BY para_index, cut_no) AS global_sentence_index, st AS start_offset, st + len(s) AS end_offset, s AS sentence_text
  FROM placed_s WHERE regexp_matches(s, '"""
    + BLANK
    + "'))"
)


def blocks(longest: int) -> str:
    """Adds fb: a paragraph with its block's number, and bl: the blocks. Needs WITH RECURSIVE."""
    alone = f"(p.para_kind IN ('separator', 'author_note', 'promo', 'noise') OR p.end_offset - p.start_offset > {longest})"
    return (
        SENTENCES
        + f""",
fb AS (SELECT chapter_num, para_index, 1::BIGINT AS b, CASE WHEN {alone} THEN -1 ELSE start_offset END AS ps, end_offset AS pe FROM pa p WHERE para_index = 1
  UNION ALL SELECT p.chapter_num, p.para_index, CASE WHEN {alone} OR f.ps < 0 OR f.pe - f.ps + 1 + p.end_offset - p.start_offset > {longest} THEN f.b + 1 ELSE f.b END,
    CASE WHEN {alone} THEN -1 WHEN f.ps < 0 OR f.pe - f.ps + 1 + p.end_offset - p.start_offset > {longest} THEN p.start_offset ELSE f.ps END, p.end_offset
  FROM fb f JOIN pa p ON p.chapter_num = f.chapter_num AND p.para_index = f.para_index + 1),
bg AS (SELECT p.chapter_num, f.b AS scene_index, min(p.para_index) AS start_para_index, max(p.para_index) AS end_para_index, min(p.start_offset) AS start_offset, max(p.end_offset) AS end_offset, min(p.para_kind) AS k, min({alone}) AS alone FROM fb f JOIN pa p USING (chapter_num, para_index) GROUP BY p.chapter_num, f.b),
bn AS (SELECT *, lead(k) OVER w AS nk, lead(scene_index) OVER w AS nx FROM bg WINDOW w AS (PARTITION BY chapter_num ORDER BY scene_index)),
bl AS (SELECT bn.chapter_num, ch.chapter_id, ch.version_id, ch.lang, scene_index, ch.chapter_id || ':' || ch.version_id || ':scene:' || scene_index AS scene_key, start_para_index, end_para_index, start_offset, end_offset, end_offset - start_offset AS length,
  CASE WHEN k IN ('separator', 'author_note', 'promo', 'noise') AND alone THEN k ELSE 'normal' END AS scene_kind,
  CASE WHEN alone AND k IN ('separator', 'author_note', 'promo', 'noise') THEN 'strong_separator_block' WHEN alone THEN 'single_long_paragraph' WHEN nx IS NULL THEN 'chapter_end' WHEN nk IN ('separator', 'author_note', 'promo', 'noise') THEN 'strong_separator_trigger' ELSE 'target_max_reached' END AS split_reason,
  sha256(substr(content, start_offset + 1, end_offset - start_offset)) AS source_hash FROM bn JOIN ch USING (chapter_num))"""
    )


def segments(longest: int, least: int, most: int, hard: int) -> str:
    """Adds sg: the segments with one sentence of overlap."""
    closes = f"(f.pe - f.ps > {hard} OR (f.pe - f.ps >= {least} AND s.e - f.ps > {most}) OR s.e - f.ps > {hard})"
    return (
        blocks(longest)
        + f""",
si AS (SELECT b.chapter_num, b.scene_index, s.start_offset AS s, s.end_offset AS e, row_number() OVER (PARTITION BY b.chapter_num, b.scene_index ORDER BY s.global_sentence_index) AS i FROM bl b JOIN se s ON s.chapter_num = b.chapter_num AND s.start_offset >= b.start_offset AND s.end_offset <= b.end_offset),
fs AS (SELECT chapter_num, scene_index, i, 1::BIGINT AS g, s AS ps, e AS pe FROM si WHERE i = 1
  UNION ALL SELECT s.chapter_num, s.scene_index, s.i, CASE WHEN {closes} THEN f.g + 1 ELSE f.g END, CASE WHEN {closes} THEN s.s ELSE f.ps END, s.e FROM fs f JOIN si s ON s.chapter_num = f.chapter_num AND s.scene_index = f.scene_index AND s.i = f.i + 1),
gr AS (SELECT chapter_num, scene_index, g, min(i) AS lo, max(i) AS hi FROM fs GROUP BY ALL),
go AS (SELECT *, CASE WHEN g > 1 THEN greatest(1, lo - 1) ELSE lo END AS f FROM gr),
ga AS (SELECT go.chapter_num, go.scene_index, g, lo, hi, f, min(s) AS start_offset, max(e) AS end_offset, count(*) AS sentence_count, max(e - s) AS widest FROM go JOIN si ON si.chapter_num = go.chapter_num AND si.scene_index = go.scene_index AND si.i BETWEEN f AND hi GROUP BY ALL),
sg AS (SELECT ga.chapter_num, ch.chapter_id, ch.version_id, ch.lang, bl.scene_key, ga.scene_index, g AS segment_index, 'l3cs_' || lpad(ga.chapter_num::VARCHAR, greatest(4, len(ga.chapter_num::VARCHAR))::INT, '0') || '_' || substr(sha256(ga.chapter_num || '|' || bl.scene_key), 1, 12) || '_' || printf('%04d', g) AS child_segment_id,
  CASE WHEN g > 1 THEN 'l3cs_' || lpad(ga.chapter_num::VARCHAR, greatest(4, len(ga.chapter_num::VARCHAR))::INT, '0') || '_' || substr(sha256(ga.chapter_num || '|' || bl.scene_key), 1, 12) || '_' || lpad((g - 1)::VARCHAR, 4, '0') END AS previous_child_id,
  ga.start_offset, ga.end_offset, sentence_count, lo - f AS overlap_sentences, CASE WHEN widest > {hard} THEN 'oversized_sentence_warning' WHEN ga.end_offset - ga.start_offset > {hard} THEN 'over_hard_max_warning' ELSE 'ok' END AS boundary_status,
  substr(content, ga.start_offset + 1, ga.end_offset - ga.start_offset) AS segment_text, sha256(substr(content, ga.start_offset + 1, ga.end_offset - ga.start_offset)) AS segment_hash
  FROM ga JOIN ch USING (chapter_num) JOIN bl ON bl.chapter_num = ga.chapter_num AND bl.scene_index = ga.scene_index)"""
    )
