"""Queries of rule checks over seeds, references and layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import strip
from corpusloom.operators import rules as R
from corpusloom.plans.registry import query
from corpusloom.plans.text import strip_sql
from corpusloom.sources.corpus import table

RULES = [
    ("conf_base", 0.0, 0.0, 1.0), ("conf_subject_boost", 0.1, 0.0, 1.0), ("conf_weak_penalty", 0.2, 0.0, 0.9), ("conf_late_boost", -0.1, 0.2, 0.8), ("Conf-Bad", 0.1, 0.9, 0.2),
    ("conf_base", None, 0.0, 1.0), ("conf_open", 0.0, None, 1.0),
]
REQUIRED = ["conf_base", "conf_subject_boost", "conf_review_reject_floor"]
_v = lambda x: "NULL::DOUBLE" if x is None else f"{x}::DOUBLE"
RULE_SQL = "cr(rule_id, delta, floor_, ceiling_) AS (VALUES " + ", ".join(f"('{r}', {_v(d)}, {_v(f)}, {_v(c)})" for r, d, f, c in RULES) + ")"


@query(
    f"""WITH {RULE_SQL} SELECT 'duplicate_rule' AS code, rule_id AS item FROM cr GROUP BY rule_id HAVING count(*) > 1
UNION ALL SELECT 'missing_rule', r FROM (SELECT unnest({REQUIRED}) AS r) WHERE r NOT IN (SELECT rule_id FROM cr)
UNION ALL SELECT 'not_snake_case', rule_id FROM cr WHERE NOT regexp_matches(rule_id, '\\A[a-z][a-z0-9]*(?:_[a-z0-9]+)*\\z')
UNION ALL SELECT CASE WHEN floor_ IS NULL OR ceiling_ IS NULL THEN 'bounds_not_numeric' ELSE 'bounds_invalid' END, rule_id FROM cr WHERE floor_ IS NULL OR ceiling_ IS NULL OR NOT (floor_ >= 0 AND floor_ <= ceiling_ AND ceiling_ <= 1)
UNION ALL SELECT CASE WHEN contains(rule_id, 'penalty') THEN 'penalty_not_negative' ELSE 'boost_not_positive' END, rule_id FROM cr WHERE (contains(rule_id, 'penalty') AND delta >= 0) OR (contains(rule_id, 'boost') AND delta <= 0)
UNION ALL SELECT 'delta_not_numeric', rule_id FROM cr WHERE delta IS NULL"""
)
def m08_rule_validators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 and P21 seed rule validators, O6 required and duplicate ids, X57 snake case."""
    rules = spark.createDataFrame(RULES, "rule_id string, delta double, floor double, ceiling double")
    return R.union(
        R.finding(R.duplicates(rules, "rule_id"), "duplicate_rule", "rule_id"), R.finding(R.missing_required(rules, "rule_id", REQUIRED), "missing_rule", "required"),
        R.finding(R.not_snake(rules, "rule_id"), "not_snake_case", "rule_id"), R.bound_violations(rules),
    )


@query("SELECT 'orders.customer' AS reference, count(*) AS n FROM orders WHERE o_custkey + CASE WHEN o_orderkey % 50 = 0 THEN 10000000 ELSE 0 END NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'lineitem.part', count(*) FROM lineitem WHERE l_partkey + CASE WHEN l_linenumber = 7 THEN 10000000 ELSE 0 END NOT IN (SELECT p_partkey FROM part) UNION ALL SELECT 'nation.region', count(*) FROM nation WHERE CASE WHEN n_nationkey = 3 THEN NULL ELSE n_regionkey END NOT IN (SELECT r_regionkey FROM region)")
def j31_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J31 and J35 references without a parent, on keys with planted damage; null keys are allowed."""
    orders = table(spark, sf_dir, "orders").select((F.col("o_custkey") + F.when(F.col("o_orderkey") % 50 == 0, 10000000).otherwise(0)).alias("k"))
    items = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") + F.when(F.col("l_linenumber") == 7, 10000000).otherwise(0)).alias("k"))
    nations = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") != 3, F.col("n_regionkey")).alias("k"))
    parts = (("orders.customer", orders, "customer", "c_custkey"), ("lineitem.part", items, "part", "p_partkey"), ("nation.region", nations, "region", "r_regionkey"))
    return R.union(*(R.orphans(child, "k", table(spark, sf_dir, parent), key).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("reference"), "n") for name, child, parent, key in parts))


PATTERNS = [("the", "th(?:e|at)", ["idiot", "scum"], ["and", "of"]), ("und", "und", ["achlich"], []), ("zzz", "License", [], ["MIT"])]
_ctx = lambda cs: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{c}') THEN '{c}' END" for c in cs) + (", " if cs else "") + "NULL::VARCHAR], lambda x: x IS NOT NULL), ', ')"


@query(
    "SELECT doc_id, term, CASE WHEN b <> '' THEN 'error' WHEN a <> '' THEN 'warning' ELSE 'suspect' END AS severity, CASE WHEN b <> '' THEN b WHEN a <> '' THEN a ELSE term END AS context FROM ("
    + " UNION ALL ".join(f"SELECT doc_id, '{t}' AS term, {_ctx(b)} AS b, {_ctx(a)} AS a FROM documents WHERE contains(text, '{t}') OR regexp_matches(text, '{r}')" for t, r, b, a in PATTERNS)
    + ")"
)
def x58_forbidden_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X58 forbidden terms by context, one of P20's rules."""
    return R.forbidden_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", PATTERNS)


@query("WITH g AS (SELECT c_mktsegment AS godway, c_name AS name, c_custkey % 40 AS person, c_custkey % 3 = 0 AS allowed FROM customer) SELECT person, string_agg(DISTINCT godway, ',' ORDER BY godway) AS godways, count(*) AS n, sum(allowed::INT)::BIGINT AS allowed FROM g GROUP BY person HAVING count(DISTINCT godway) > 1")
def p20_shared_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20 members that several groups claim, with how many of the claims allow it."""
    g = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("godway"), (F.col("c_custkey") % 40).alias("person"), (F.col("c_custkey") % 3 == 0).alias("allowed"))
    per = g.groupBy("person").agg(F.array_join(F.array_sort(F.collect_set("godway")), ",").alias("godways"), F.count(F.lit(1)).alias("n"), F.count_if("allowed").alias("allowed"), F.count_distinct("godway").alias("k"))
    return per.filter("k > 1").drop("k")


@query("SELECT e.event_type AS value, count(*) AS n FROM events e WHERE e.event_type NOT IN (SELECT unnest(['click', 'view'])) GROUP BY e.event_type")
def p21_uncovered_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P21 distinct values of a table that a rule set lacks, M9 unknown values; values are grouped before they are joined."""
    seen = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    known = spark.createDataFrame([("click",), ("view",)], "value string")
    return seen.join(known, "value", "left_anti")


@query("WITH m AS (SELECT doc_id, doc_id % 10 <> 0 AS main FROM documents), f AS (SELECT doc_id + CASE WHEN doc_id % 25 = 1 THEN 1000000 ELSE 0 END AS doc_id FROM documents WHERE doc_id % 4 <> 3) SELECT (SELECT count(*) FROM m WHERE main) AS main_rows, (SELECT count(*) FROM f) AS index_rows, (SELECT count(*) FROM m WHERE main AND doc_id NOT IN (SELECT doc_id FROM f)) AS missing, (SELECT count(*) FROM f WHERE doc_id NOT IN (SELECT doc_id FROM m WHERE main)) AS orphans")
def m02_index_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 a table and its index agree in both directions: one full outer join counts all."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    main = d.filter("doc_id % 10 <> 0").select(F.col("doc_id").alias("a"))
    index = d.filter("doc_id % 4 <> 3").select((F.col("doc_id") + F.when(F.col("doc_id") % 25 == 1, 1000000).otherwise(0)).alias("b"))
    return main.join(index, F.col("a") == F.col("b"), "full_outer").agg(F.count("a").alias("main_rows"), F.count("b").alias("index_rows"), F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("orphans"))


@query(
    r"WITH t AS (SELECT page_id, regexp_extract(html, '(?i)<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '(?i)<h1[^>]*>([^<]*)</h1>', 1) AS h1 FROM pages) SELECT page_id, "
    + strip_sql("title")
    + r" AS title, try_cast(nullif(regexp_extract(title, '([0-9]+)', 1), '') AS BIGINT) AS title_number, try_cast(nullif(regexp_extract(h1, '([0-9]+)', 1), '') AS BIGINT) AS h1_number, coalesce(nullif(regexp_extract(title, '([0-9]+)', 1), '') = nullif(regexp_extract(h1, '([0-9]+)', 1), ''), false) AS agree FROM t"
)
def m11_title_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 numbers in titles and headings compared, on raw pages."""
    t = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "(?i)<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", "(?i)<h1[^>]*>([^<]*)</h1>", 1).alias("h1"))
    n = lambda c: F.nullif(F.regexp_extract(c, "([0-9]+)", 1), F.lit(""))
    return t.select("page_id", strip(F.col("title")).alias("title"), n("title").try_cast("long").alias("title_number"), n("h1").try_cast("long").alias("h1_number"), F.coalesce(n("title") == n("h1"), F.lit(False)).alias("agree"))


@query("WITH w AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following FROM events) SELECT event_type, coalesce(previous, 'none') AS previous, count(*) AS n, count(following) AS followed FROM w GROUP BY ALL")
def w11_event_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W11 and W12 neighbours in a chain, on the event stream table."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").select("event_type", F.lag("event_type").over(w).alias("previous"), F.lead("ts").over(w).alias("following"))
    return e.groupBy("event_type", F.coalesce("previous", F.lit("none")).alias("previous")).agg(F.count(F.lit(1)).alias("n"), F.count("following").alias("followed"))
