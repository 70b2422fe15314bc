"""Queries of grounded answers, packs, replies and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import keywords as K
from corpusloom.functions.text import estimate_tokens
from corpusloom.operators import grounding as G
from corpusloom.operators import retrieval as R
from corpusloom.plans.registry import query
from corpusloom.plans.retrieval import FULL_SQL, routes
from corpusloom.plans.text import squeeze_sql
from corpusloom.sources.corpus import table
from corpusloom.sources.staging import materialize

BUDGET = 60
_ws = r"[ \t\n\x0B\f\r\x{85}\x{a0}\x{3000}]"
_tokens = lambda t: f"(CASE WHEN regexp_matches({t}, '[\\x{{4e00}}-\\x{{9fff}}]') THEN floor(len({t}) / 1.5::DOUBLE) ELSE floor(len(list_filter(regexp_split_to_array({t}, '{_ws}+'), lambda w: w <> '')) * 1.3::DOUBLE) END + 1)::BIGINT"
_keys = lambda t: f"list_distinct(list_transform(regexp_extract_all({t}, '[A-Za-z0-9_]{{2,}}'), lambda w: lower(w)))"
ANSWER_SQL = f"""{FULL_SQL},
e0 AS (SELECT query_id, child_segment_id, row_number() OVER (PARTITION BY query_id ORDER BY place) AS evidence_rank, substr({squeeze_sql('segment_text')}, 1, 160) AS excerpt FROM fr JOIN sg USING (child_segment_id) QUALIFY evidence_rank <= 5),
e1 AS (SELECT query_id, list({{'r': evidence_rank, 'i': child_segment_id, 'x': excerpt}} ORDER BY evidence_rank) AS ev FROM e0 GROUP BY query_id),
an AS (SELECT query_id, query_text, coalesce(ev, []) AS ev, coalesce(len(ev), 0)::BIGINT AS evidence_count, coalesce(list_sum(list_transform(ev, lambda e: len(e.x))), 0) AS total FROM qs LEFT JOIN e1 USING (query_id)),
aw AS (SELECT *, CASE WHEN evidence_count < 1 THEN 'insufficient_evidence' ELSE 'grounded_draft' END AS answer_status, CASE WHEN evidence_count < 1 THEN 'weak' WHEN total < 40 THEN 'acceptable' WHEN evidence_count >= 3 THEN 'good' ELSE 'acceptable' END AS confidence,
  CASE WHEN evidence_count < 1 THEN '' ELSE (CASE WHEN total < 40 THEN '{G.CAUTION}' ELSE '{K.ANSWER_OPENING}' END) || array_to_string(list_transform(list_slice(ev, 1, 3), lambda e: e.x), '；') || chr(10) || 'evidence_refs: ' || array_to_string(list_transform(ev, lambda e: '[E' || e.r || ':' || e.i || ']'), ' ') END AS grounded_answer FROM an)"""
_prompt = "query_text || chr(10) || array_to_string(list_transform(list_slice(ev, 1, {n}), lambda e: '[E' || e.r || '] ' || e.x), chr(10))"
PACK_SQL = f"""{ANSWER_SQL},
pn AS (SELECT query_id, n, {_tokens(_prompt.replace('{n}', 'n'))} AS cost FROM aw, (SELECT unnest(range(1, 6)) AS n) WHERE n <= evidence_count),
pk AS (SELECT query_id, coalesce(max(n) FILTER (cost <= {BUDGET}), 1) AS k FROM pn GROUP BY query_id),
pp AS (SELECT aw.*, coalesce(k, 0) AS k, {_prompt.replace('{n}', 'coalesce(k, 0)')} AS prompt, list_slice(ev, 1, coalesce(k, 0)) AS refs FROM aw LEFT JOIN pk USING (query_id)),
pf AS (SELECT *, list_filter(list_transform(regexp_split_to_array(replace(split_part(grounded_answer, 'evidence_refs:', 1), '{K.ANSWER_OPENING}', ''), '[。；;\\n]+'), lambda p: {squeeze_sql('p')}), lambda p: p <> '' AND NOT regexp_matches(p, '证据不足|不能确认|无法确认')) AS fs0 FROM pp),
pu AS (SELECT *, list_filter(fs0, lambda f, i: list_position(fs0, f) = i) AS fs FROM pf),
px AS (SELECT *, list_slice(list_filter(fs, lambda f: len(list_filter(refs, lambda e: list_has_any({_keys('f')}, {_keys('e.x')}))) > 0), 1, 8) AS facts FROM pu)"""


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments, queries, title, keyword, vector = routes(spark, sf_dir)
    hits = R.fuse(title, keyword, vector, 10).select("query_id", "child_segment_id", "place")
    return materialize(G.answers(queries, G.evidence(hits, segments)), "answers", compact=True)


@query(f"{ANSWER_SQL} SELECT query_id, evidence_count, answer_status, confidence, grounded_answer FROM aw")
def p02_grounded_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 extractive answers, W13 dense evidence rank over valid hits, X18 excerpts."""
    return answered(spark, sf_dir).drop("evidence", "query_text")


@query(f"{ANSWER_SQL} SELECT answer_status, confidence, count(*) AS n, round(avg(evidence_count), 2) AS mean_evidence FROM aw GROUP BY ALL")
def a18_answer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered(spark, sf_dir).groupBy("answer_status", "confidence").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("evidence_count"), 2).alias("mean_evidence"))


@query(f"{PACK_SQL} SELECT query_id, CASE WHEN answer_status = 'insufficient_evidence' OR len(refs) = 0 THEN 'insufficient' WHEN len(facts) > 0 AND confidence = 'good' THEN 'ready' ELSE 'partial' END AS pack_status, len(refs)::BIGINT AS ref_count, {_tokens('prompt')} AS tokens, len(facts)::BIGINT AS fact_count, array_to_string(facts, '|') AS facts FROM px")
def p03_context_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 packs: the longest prefix of evidence within the budget, O7 facts bound by shared keywords, A19 counts."""
    packs = G.context_packs(answered(spark, sf_dir), BUDGET)
    return packs.select("query_id", "pack_status", "ref_count", "tokens", "fact_count", F.array_join(F.transform("facts", lambda f: f["fact"]), "|").alias("facts"))


@query(f"{PACK_SQL}, rn AS (SELECT query_id, n, {_tokens('array_to_string(list_slice(facts, 1, n), chr(10))')} AS cost FROM px, (SELECT unnest(range(1, 9)) AS n) WHERE n <= len(facts)), rk AS (SELECT query_id, coalesce(max(n) FILTER (cost <= 25), 1) AS k FROM rn GROUP BY query_id) SELECT query_id, coalesce(rk.k, 0)::BIGINT AS facts_used, array_to_string(list_slice(facts, 1, coalesce(rk.k, 0)), chr(10)) AS reply FROM px LEFT JOIN rk USING (query_id)")
def p04_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4 a dry-run consumer that echoes the facts fitting its budget, S20 deterministic mock."""
    packs = G.context_packs(answered(spark, sf_dir), BUDGET).withColumn("f", F.transform("facts", lambda f: f["fact"]))
    k = G.longest_fitting(F.col("f"), lambda fs: estimate_tokens(F.array_join(fs, "\n")), 25)
    return packs.select("query_id", k.cast("long").alias("facts_used"), F.array_join(F.slice("f", F.lit(1), k), "\n").alias("reply"))


@query(
    """SELECT conv_id, turn, CASE conv_id % 7 WHEN 0 THEN 'plain' WHEN 1 THEN 'fenced' WHEN 3 THEN 'invalid' WHEN 4 THEN 'empty' ELSE 'balanced' END AS how, CASE WHEN conv_id % 7 NOT IN (3, 4) THEN conv_id END AS a, CASE WHEN conv_id % 7 NOT IN (3, 4) THEN 'x}"{' || turn END AS b FROM conversations"""
)
def x54_json_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X54 plain, fenced, or first balanced object after broken ones, M20 reply contents; an Arrow function, since balance is beyond expressions."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    good = F.concat(F.lit('{"a": '), F.col("conv_id").cast("string"), F.lit(', "b": "x}\\"{'), F.col("turn").cast("string"), F.lit('"}'))
    m = F.col("conv_id") % 7
    fenced = F.concat(F.lit("Here:\n```json\n"), good, F.lit("\n```\nbye"))
    text = F.when(m == 0, good).when(m == 1, fenced).when(m == 2, F.concat(F.lit("sure: "), good)).when(m == 3, "{broken: true").when(m == 4, "  \n").when(m == 6, F.concat(F.lit('use {x} or {"a": {"b": then '), good)).otherwise(F.concat(F.lit("Answer: "), good, F.lit(" and {more}")))
    r = rows.withColumn("r", G.recover_json(text))
    return r.select("conv_id", "turn", F.col("r.how").alias("how"), F.get_json_object("r.json", "$.a").cast("long").alias("a"), F.get_json_object("r.json", "$.b").alias("b"))


REPLY_SQL = """r0 AS (SELECT doc_id, ['ready', 'partial', 'insufficient'][(doc_id % 3 + 1)::INT] AS pack_status, ['f1', 'f2', 'e1'] AS allowed, ['ready', 'partial', 'insufficient', 'done', 'ready'][(doc_id % 5 + 1)::INT] AS status, CASE WHEN doc_id % 7 = 0 THEN ['f1', 'zz'] WHEN doc_id % 7 = 1 THEN []::VARCHAR[] ELSE ['f1', 'e1'] END AS used, doc_id % 4 AS facts, doc_id % 6 AS claims, CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END AS unsupported FROM documents),
r1 AS (SELECT *, list_filter(used, lambda u: NOT list_contains(allowed, u)) AS outside, list_filter(used, lambda u: list_contains(allowed, u)) AS inside, CASE WHEN status IN ('ready', 'partial', 'insufficient', 'invalid') THEN status ELSE 'invalid' END AS s1 FROM r0),
r2 AS (SELECT *, CASE WHEN pack_status <> 'ready' AND s1 = 'ready' THEN 'partial' ELSE s1 END AS s2 FROM r1), r3 AS (SELECT *, CASE WHEN unsupported > 0 AND s2 = 'ready' THEN 'partial' ELSE s2 END AS s3 FROM r2),
r4 AS (SELECT *, CASE WHEN facts = 0 AND s3 NOT IN ('insufficient', 'invalid') THEN 'insufficient' ELSE s3 END AS s4 FROM r3), r5 AS (SELECT *, CASE WHEN len(outside) > 0 THEN 'invalid' ELSE s4 END AS s5 FROM r4),
r6 AS (SELECT *, CASE WHEN claims = 0 AND facts > 0 AND s5 = 'ready' THEN 'partial' ELSE s5 END AS final_status FROM r5)"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up replies of all kinds."""
    i = F.col("doc_id")
    pick = lambda values, n: F.get(F.array(*map(F.lit, values)), (i % n).cast("int"))
    used = F.when(i % 7 == 0, F.array(F.lit("f1"), F.lit("zz"))).when(i % 7 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("f1"), F.lit("e1")))
    return table(spark, sf_dir, "documents").select("doc_id", pick(["ready", "partial", "insufficient"], 3).alias("pack_status"), F.array(F.lit("f1"), F.lit("f2"), F.lit("e1")).alias("allowed"), pick(["ready", "partial", "insufficient", "done", "ready"], 5).alias("status"), used.alias("used"), (i % 4).alias("facts"), (i % 6).alias("claims"), F.when(i % 9 == 0, 1).otherwise(0).alias("unsupported"))


@query(f"WITH {REPLY_SQL} SELECT doc_id, array_to_string(inside, ',') AS inside, array_to_string(outside, ',') AS outside, final_status FROM r6")
def p05_reply_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 references outside the pack go, and the status falls in a fixed order."""
    r = G.normalize_replies(replies(spark, sf_dir))
    return r.select("doc_id", F.array_join("inside", ",").alias("inside"), F.array_join("outside", ",").alias("outside"), "final_status")


@query("SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(text || ' l3cs_0001_ab ch_0001 ch_' || printf('%04d', doc_id), 'l3cs_[0-9a-z_]+|ch_[0-9]{4}')), lambda x: NOT list_contains(['ch_0001'], x))), ',') AS leaks, regexp_matches(text || CASE WHEN doc_id % 8 = 0 THEN '显然' ELSE '' END, '显然|必然|毫无疑问|众所周知') AS overreaches FROM documents")
def p06_generation_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 ids leaked by a generated text, and phrases beyond the evidence."""
    docs = table(spark, sf_dir, "documents")
    text = F.concat("text", F.lit(" l3cs_0001_ab ch_0001 ch_"), F.lpad(F.col("doc_id").cast("string"), 4, "0"))
    leaks = G.leaked_ids(text, F.array(F.lit("ch_0001")), "l3cs_[0-9a-z_]+|ch_[0-9]{4}")
    marked = F.concat("text", F.when(F.col("doc_id") % 8 == 0, "显然").otherwise(""))
    return docs.select("doc_id", F.array_join(leaks, ",").alias("leaks"), marked.rlike("|".join(G.OVERREACH)).alias("overreaches"))
