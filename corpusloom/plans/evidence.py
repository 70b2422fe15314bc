"""Queries of seed evidence, its review, and the coverage lock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators import chunking as C
from corpusloom.operators import evidence as E
from corpusloom.plans import corpus_sql as S
from corpusloom.plans.corpus import units
from corpusloom.plans.registry import query
from corpusloom.sources.corpus import chapters, table
from corpusloom.sources.staging import materialize

SEEDS = [
    {"seed_item_id": "godway:thing", "category": "godway", "name": "Thing", "aliases": ["Thingou", " things "], "characters": ["Haor"], "branches": ["tionth"], "keywords": ["ereding", "ntti", "x"], "rules": []},
    {"seed_item_id": "domain:heit", "category": "domain", "name": "Heit", "aliases": ["heitung"], "keywords": ["lichkeit", "keitver"], "rules": ["schzu"]},
    {"seed_item_id": "rule:license", "category": "rule", "name": "License", "rules": ["MIT", "Apache"], "keywords": ["Released"]},
    {"seed_item_id": "other:cion", "category": "other", "name": "Ciónmente", "keywords": ["mentera"]},
    {"seed_item_id": "item:none", "category": "item", "name": "Qqqqxyz", "keywords": ["zzqqzz"]},
    {"seed_item_id": "other:ment", "category": "other", "name": "Mentai", "branches": ["réeux", "relle"], "characters": ["Auxé"]},
]


def _arr(values: list[str]) -> str:
    values = E.normalize_keywords(values)
    return "[" + ", ".join(f"'{v}'" for v in values) + "]" if values else "[]::VARCHAR[]"


SEED_SQL = "sd(seed_item_id, category, name, aliases, characters, branches, keywords, rules) AS (VALUES " + ", ".join(f"('{s['seed_item_id']}', '{s['category']}', '{s['name']}', {', '.join(_arr(s.get(f, [])) for f in E.FIELDS)})" for s in SEEDS) + ")"
_hit = lambda c: f"list_filter({c}, lambda k: contains(para_text, k))"
_uniq = "list_filter({0}, lambda k, i: list_position({0}, k) = i)"
_STRIPPED = r"len(regexp_replace(para_text, '\A[ \t\n\x0B\f\r\x{85}\x{a0}\x{3000}]+|[ \t\n\x0B\f\r\x{85}\x{a0}\x{3000}]+\z', '', 'g'))"
FOUND_SQL = f"""{SEED_SQL},
pr AS (SELECT *, list_concat([name], aliases, keywords, branches, characters) AS pos0 FROM pa CROSS JOIN sd),
pq AS (SELECT * EXCLUDE (pos0), {_uniq.format('pos0')} AS pos FROM pr),
ph AS (SELECT *, {_hit('aliases')} AS ha, {_hit('characters')} AS hc, {_hit('branches')} AS hb, {_hit('keywords')} AS hk, {_hit('rules')} AS hr, {_hit('pos')} AS mp, contains(para_text, name) AS hn FROM pq),
pm AS (SELECT *, list_concat(mp, hr) AS m0 FROM ph WHERE len(mp) + len(hr) > 0),
pn AS (SELECT *, {_uniq.format('m0')} AS matched, hn::INT + (len(ha) > 0)::INT + (len(hc) > 0)::INT + (len(hb) > 0)::INT + (len(hk) > 0)::INT + (len(hr) > 0)::INT AS kinds FROM pm),
pb AS (SELECT *, list_filter([CASE WHEN hn THEN {{'n': 'name_hit', 'p': 30}} END, CASE WHEN len(ha) > 0 THEN {{'n': 'alias_hit', 'p': 25}} END, CASE WHEN len(hc) > 0 THEN {{'n': 'character_hit', 'p': 15}} END, CASE WHEN len(hb) > 0 THEN {{'n': 'branch_hit', 'p': 15}} END,
  CASE WHEN len(hk) > 0 THEN {{'n': 'keyword_hits', 'p': (len(hk) * 10)::INT}} END, CASE WHEN len(hr) > 0 THEN {{'n': 'rule_keyword_hits', 'p': (len(hr) * 8)::INT}} END, {{'n': 'distinct_keyword_bonus', 'p': (len(matched) * 3)::INT}}, CASE WHEN kinds > 1 THEN {{'n': 'multi_field_bonus', 'p': 5}} END, CASE WHEN {_STRIPPED} < 20 THEN {{'n': 'short_paragraph_penalty', 'p': -5}} END], lambda x: x IS NOT NULL) AS bd FROM pn),
ps AS (SELECT *, sha256(para_text) AS para_hash, list_sum(list_transform(bd, lambda x: x.p))::BIGINT AS score, CASE WHEN len(hr) > 0 THEN 'rule_violation_candidate' ELSE 'positive_candidate' END AS evidence_type FROM pb),
ev AS (SELECT 'ev_' || substr(sha256(seed_item_id || '|' || chapter_num || '|' || para_index || '|' || para_hash), 1, 20) AS evidence_id, seed_item_id, category, chapter_num, para_index, start_offset, end_offset, para_hash, para_text, score, array_to_string(list_transform(bd, lambda x: x.n || ':' || x.p), ',') AS breakdown, array_to_string(matched, ',') AS matched_keywords, len(matched)::BIGINT AS matched_count, list_max(list_transform(matched, lambda k: len(k)))::INT AS longest, evidence_type,
  row_number() OVER (PARTITION BY seed_item_id ORDER BY score DESC, chapter_num, para_index) AS place FROM ps QUALIFY place <= 30)"""
DECISION_SQL = "de AS (SELECT evidence_id, CASE WHEN seed_item_id = 'other:ment' THEN NULL WHEN place % 11 = 1 AND seed_item_id <> 'domain:heit' THEN 'accepted' WHEN place % 3 = 0 THEN 'needs_more' ELSE 'rejected' END AS human_status FROM ev)"
COVER_SQL = f"""{DECISION_SQL},
pe AS (SELECT seed_item_id, count(*) AS candidates, count(human_status) AS reviews, count(*) FILTER (human_status = 'accepted') AS accepted, array_to_string(list_sort(list_distinct(list(chapter_num) FILTER (human_status = 'accepted'))), ',') AS chapters FROM ev LEFT JOIN de USING (evidence_id) GROUP BY seed_item_id),
cv AS (SELECT seed_item_id, category, coalesce(candidates, 0) AS candidates, coalesce(reviews, 0) AS reviews, coalesce(accepted, 0) AS accepted, coalesce(chapters, '') AS chapters, CASE WHEN coalesce(accepted, 0) > 0 THEN NULL WHEN candidates IS NULL THEN 'no_candidate_evidence' WHEN reviews = 0 THEN 'no_review_evidence' ELSE 'no_accepted_evidence' END AS gap_reason,
  CASE WHEN category = 'rule' THEN 'high' WHEN category IN ('godway', 'domain', 'lord', 'item') THEN 'medium' ELSE 'low' END AS risk_level FROM sd LEFT JOIN pe USING (seed_item_id)),
co AS (SELECT *, CASE WHEN accepted > 0 THEN 'covered' ELSE 'uncovered' END AS coverage_status, CASE WHEN accepted > 0 THEN 'keep_as_coverage_locked' WHEN gap_reason = 'no_candidate_evidence' OR risk_level = 'high' THEN 'schedule_followup_evidence_search' ELSE 'keep_as_uncovered_for_now' END AS next_action FROM cv)"""


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best paragraphs of each seed, a few dozen a seed, written once for all that read them."""
    return materialize(E.candidates(C.paragraphs(units(spark, sf_dir)), E.seed_table(spark, SEEDS)), "evidence", compact=True)


def decisions(rows: DataFrame) -> DataFrame:
    """Made-up review results: none for one seed, some accepted for most."""
    status = F.when(F.col("seed_item_id") == "other:ment", None).when((F.col("place") % 11 == 1) & (F.col("seed_item_id") != "domain:heit"), "accepted").when(F.col("place") % 3 == 0, "needs_more").otherwise("rejected")
    return rows.select("evidence_id", status.alias("human_status"))


@query(f"WITH {S.PARAGRAPHS}, {FOUND_SQL} SELECT * EXCLUDE (para_text) FROM ev")
def w05_evidence_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X34 keyword building, X35 scores with breakdown, X37 evidence ids, W5 best paragraphs of each seed."""
    return found(spark, sf_dir).drop("para_text")


@query(
    f"WITH {S.PARAGRAPHS}, {FOUND_SQL}, cu AS (SELECT ev.*, sha256(substr(content, start_offset + 1, end_offset - start_offset)) = para_hash AS backcut, count(*) OVER (PARTITION BY para_hash) AS same FROM ev JOIN ch USING (chapter_num)) SELECT evidence_id, seed_item_id, backcut, array_to_string(list_filter([CASE WHEN NOT backcut THEN 'invalid_backcut' END, CASE WHEN score < 20 THEN 'low_score' END, CASE WHEN matched_count = 1 AND longest <= 1 THEN 'weak_keyword_match' END, CASE WHEN evidence_type = 'rule_violation_candidate' THEN 'rule_violation_candidate' END, CASE WHEN {_STRIPPED} < 20 THEN 'short_paragraph' END, CASE WHEN backcut AND score >= 50 AND matched_count >= 2 THEN 'high_confidence_candidate' END, CASE WHEN same > 1 THEN 'duplicate_paragraph' END], lambda x: x IS NOT NULL), ',') AS review_flags, CASE WHEN NOT backcut THEN 'invalid' WHEN evidence_type = 'rule_violation_candidate' THEN 'needs_review' WHEN score >= 50 AND matched_count >= 2 THEN 'likely_relevant' WHEN score < 20 THEN 'likely_irrelevant' ELSE 'needs_review' END AS suggested_status FROM cu"
)
def x36_review_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X36 flags and suggested status, A11 duplicate paragraph groups, J34 back-cut."""
    rows = E.reviewed(found(spark, sf_dir), chapters(table(spark, sf_dir, "documents")))
    return rows.select("evidence_id", "seed_item_id", "backcut", "review_flags", "suggested_status")


@query(
    f"WITH {S.PARAGRAPHS}, {FOUND_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY seed_item_id ORDER BY place) AS k FROM (SELECT seed_item_id, min(place) AS place, chapter_num, start_offset, end_offset, min(evidence_id) AS evidence_id FROM ev GROUP BY seed_item_id, chapter_num, start_offset, end_offset)) SELECT seed_item_id, evidence_id, k FROM t WHERE k <= 5"
)
def w06_top_per_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 the first five of each seed after dropping repeated spans, in input order."""
    rows = found(spark, sf_dir).groupBy("seed_item_id", "chapter_num", "start_offset", "end_offset").agg(F.min("place").alias("place"), F.min("evidence_id").alias("evidence_id"))
    w = Window.partitionBy("seed_item_id").orderBy("place")
    return rows.withColumn("k", F.row_number().over(w).cast("long")).filter("k <= 5").select("seed_item_id", "evidence_id", "k")


@query(f"WITH {S.PARAGRAPHS}, {FOUND_SQL}, {DECISION_SQL} SELECT coalesce(human_status, 'pending') AS status, seed_item_id, count(*) AS n FROM ev LEFT JOIN de USING (evidence_id) GROUP BY ALL")
def p08_review_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 decisions applied, F15 status domain, J20 lookup, S15 decision rows."""
    rows = found(spark, sf_dir)
    d = decisions(rows)
    legal = F.col("human_status").isNull() | F.col("human_status").isin("accepted", "rejected", "needs_more")
    d = d.withColumn("human_status", F.when(legal, F.col("human_status")).otherwise(F.raise_error(F.concat(F.lit("illegal status "), "human_status"))))
    return rows.join(d, "evidence_id", "left").groupBy(F.coalesce("human_status", F.lit("pending")).alias("status"), "seed_item_id").agg(F.count(F.lit(1)).alias("n"))


def covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = found(spark, sf_dir)
    return E.coverage(E.seed_table(spark, SEEDS), rows, decisions(rows))


@query(f"WITH {S.PARAGRAPHS}, {FOUND_SQL}, {COVER_SQL} SELECT * FROM co")
def p09_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 coverage of seeds, M6 gap rows, X55 reasons and actions."""
    return covered(spark, sf_dir)


@query(
    f"WITH {S.PARAGRAPHS}, {FOUND_SQL}, {COVER_SQL}, s AS (SELECT count(*) AS seeds, count(*) FILTER (accepted > 0) AS covered, sum(accepted)::BIGINT AS accepted, sum(candidates - reviews)::BIGINT AS pending, max(accepted) AS most_accepted, count(*) - count(DISTINCT seed_item_id) AS duplicate_seeds FROM co) SELECT *, round(covered / seeds, 6) AS coverage_rate, duplicate_seeds = 0 AND pending = 0 AND most_accepted <= 3 AND seeds = {len(SEEDS)} AS lock_holds FROM s"
)
def a13_coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 coverage summary, P10 integrity of the lock."""
    return E.lock_summary(covered(spark, sf_dir), len(SEEDS))


@query(f"WITH {S.PARAGRAPHS}, {FOUND_SQL}, {COVER_SQL} SELECT seed_item_id, co.category, coverage_status, accepted AS accepted_evidence_count, evidence_id, chapter_num FROM ev JOIN de USING (evidence_id) JOIN co USING (seed_item_id) WHERE human_status = 'accepted'")
def f14_trusted_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14 the reader without a filter: all accepted evidence of locked seeds, J21 and J22 against the lock."""
    rows = found(spark, sf_dir)
    d = decisions(rows)
    accepted = rows.join(d.filter("human_status = 'accepted'"), "evidence_id")
    lock = E.coverage(E.seed_table(spark, SEEDS), rows, d).select("seed_item_id", "category", "coverage_status")
    seeds = E.filter_reader_rows(E.reader_rows(accepted, lock))
    return seeds.select("seed_item_id", "category", "coverage_status", "accepted_evidence_count", F.explode("evidence_refs").alias("e")).select("*", "e.evidence_id", "e.chapter_num").drop("e")


@query(f"WITH {S.PARAGRAPHS}, {FOUND_SQL}, {DECISION_SQL}, a AS (SELECT ev.* FROM ev JOIN de USING (evidence_id) WHERE human_status = 'accepted') SELECT 'seed' AS index_name, seed_item_id AS key, string_agg(evidence_id, ',' ORDER BY evidence_id) AS ids FROM a GROUP BY seed_item_id UNION ALL SELECT 'chapter', chapter_num::VARCHAR, string_agg(evidence_id, ',' ORDER BY evidence_id) FROM a GROUP BY chapter_num UNION ALL SELECT 'category', category, string_agg(evidence_id, ',' ORDER BY evidence_id) FROM a GROUP BY category")
def a16_inverted_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16 inverted indexes of accepted evidence: one exploded pass for all of them."""
    rows = found(spark, sf_dir)
    accepted = rows.join(decisions(rows).filter("human_status = 'accepted'"), "evidence_id")
    entry = lambda name, c: F.struct(F.lit(name).alias("index_name"), F.col(c).cast("string").alias("key"))
    keyed = accepted.select("evidence_id", F.explode(F.array(entry("seed", "seed_item_id"), entry("chapter", "chapter_num"), entry("category", "category"))).alias("k"))
    return keyed.groupBy("k.index_name", "k.key").agg(F.array_join(F.array_sort(F.collect_list("evidence_id")), ",").alias("ids"))


@query(
    f"WITH {S.PARAGRAPHS}, {FOUND_SQL} SELECT evidence_id, p.para_index, p.start_offset, p.end_offset, sha256(p.para_text) AS para_hash, p.para_text FROM ev JOIN pa p ON p.chapter_num = ev.chapter_num AND p.para_index BETWEEN ev.para_index - 2 AND ev.para_index + 2"
)
def j19_context_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J19 the whole paragraphs round every hit, two on either side, a row each."""
    paras = C.paragraphs(units(spark, sf_dir)).select("chapter_num", "para_index", "start_offset", "end_offset", "para_hash", "para_text")
    keys = found(spark, sf_dir).select("evidence_id", "chapter_num", F.explode(F.sequence(F.col("para_index") - 2, F.col("para_index") + 2)).alias("para_index"))
    return keys.join(paras, ["chapter_num", "para_index"]).drop("chapter_num")


@query("SELECT doc_id, CASE WHEN contains(p, 'rules') THEN 'rule' WHEN contains(p, 'godway') THEN 'godway' WHEN contains(p, 'domain') THEN 'domain' WHEN contains(p, 'lord') THEN 'lord' WHEN contains(p, 'item') THEN 'item' ELSE 'other' END AS category FROM (SELECT doc_id, ['$.rules[0]', '$.godways[1]', 'x.domain', 'lords', 'item_2', 'zzz'][(doc_id % 6 + 1)::INT] AS p FROM documents)")
def x56_seed_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X56 category from a seed item's path."""
    p = F.get(F.array(*map(F.lit, ["$.rules[0]", "$.godways[1]", "x.domain", "lords", "item_2", "zzz"])), (F.col("doc_id") % 6).cast("int"))
    rows = table(spark, sf_dir, "documents").select("doc_id", p.alias("p"))
    chain = F.when(F.col("p").contains("rules"), "rule")
    for word in ("godway", "domain", "lord", "item"):
        chain = chain.when(F.col("p").contains(word), word)
    return rows.select("doc_id", chain.otherwise("other").alias("category"))
