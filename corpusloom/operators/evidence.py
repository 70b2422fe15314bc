"""Seed evidence: keyword scoring of paragraphs, review hints, decisions, coverage lock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.terms import MOST_TERMS, owners_present
from corpusloom.functions.text import sha256, strip
from corpusloom.operators.chunking import cut_again

#: Points of the evidence score.
POINTS = {"name": 30, "alias": 25, "character": 15, "branch": 15, "keyword": 10, "rule": 8, "distinct": 3, "several": 5, "short": -5}
SHORT = 20
TOP = 30
FIELDS = ("aliases", "characters", "branches", "keywords", "rules")


def normalize_keywords(values: list[str]) -> list[str]:
    """Trimmed, distinct in order, without single ASCII characters."""
    trimmed = [v.strip() for v in values]
    return list(dict.fromkeys(v for v in trimmed if v and not (len(v) == 1 and v.isascii())))


def seed_table(spark: SparkSession, seeds: list[dict]) -> DataFrame:
    """seed_item_id, category, name and keyword arrays, from the caller's list."""
    rows = [(s["seed_item_id"], s["category"], s["name"], *(normalize_keywords(s.get(f, [])) for f in FIELDS)) for s in seeds]
    kinds = ", ".join(f"{f} array<string>" for f in FIELDS)
    return spark.createDataFrame(rows, f"seed_item_id string, category string, name string, {kinds}")


def hits(column: str) -> Column:
    return F.filter(column, lambda k: F.col("para_text").contains(k))


def candidates(paragraphs: DataFrame, seeds: DataFrame, top: int = TOP) -> DataFrame:
    """The best paragraphs of each seed with score, its breakdown, matched keywords and the kind of evidence."""
    positive = F.array_distinct(F.concat(F.array("name"), "aliases", "keywords", "branches", "characters"))
    listed = seeds.select("seed_item_id", F.explode(F.concat(positive, "rules")).alias("term")).distinct().limit(MOST_TERMS + 1).collect()
    if len(listed) > MOST_TERMS:
        raise ValueError(f"seeds may name at most {MOST_TERMS} terms, each counted once a seed")
    owners: dict[str, list[str]] = {}
    for row in listed:
        owners.setdefault(row["term"], []).append(row["seed_item_id"])
    pairs = paragraphs.withColumn("seed_item_id", F.explode(owners_present(F.col("para_text"), owners))).join(seeds, "seed_item_id")
    pairs = pairs.withColumns({f"h_{f}": hits(f) for f in FIELDS} | {"matched_positive": F.filter(positive, lambda k: F.col("para_text").contains(k)), "h_name": F.col("para_text").contains(F.col("name"))})
    n = lambda f: F.size(f"h_{f}")
    distinct = F.size(F.array_distinct(F.concat("matched_positive", "h_rules")))
    kinds = F.col("h_name").cast("int") + sum(F.least(n(f), F.lit(1)) for f in FIELDS)
    entry = lambda key, name, when, value: F.when(when, F.struct(F.lit(name).alias("name"), value.cast("int").alias("points")))
    breakdown = F.array_compact(F.array(
        entry("n", "name_hit", F.col("h_name"), F.lit(POINTS["name"])), entry("a", "alias_hit", n("aliases") > 0, F.lit(POINTS["alias"])), entry("c", "character_hit", n("characters") > 0, F.lit(POINTS["character"])), entry("b", "branch_hit", n("branches") > 0, F.lit(POINTS["branch"])),
        entry("k", "keyword_hits", n("keywords") > 0, n("keywords") * POINTS["keyword"]), entry("r", "rule_keyword_hits", n("rules") > 0, n("rules") * POINTS["rule"]), entry("d", "distinct_keyword_bonus", distinct > 0, distinct * POINTS["distinct"]),
        entry("m", "multi_field_bonus", kinds > 1, F.lit(POINTS["several"])), entry("s", "short_paragraph_penalty", F.length(strip(F.col("para_text"))) < SHORT, F.lit(POINTS["short"])),
    ))
    scored = pairs.withColumn("breakdown", breakdown).withColumn("score", F.aggregate("breakdown", F.lit(0), lambda a, x: a + x["points"]).cast("long"))
    scored = scored.withColumn("evidence_type", F.when(n("rules") > 0, "rule_violation_candidate").otherwise("positive_candidate"))
    scored = scored.withColumn("matched", F.array_distinct(F.concat("matched_positive", "h_rules")))
    w = Window.partitionBy("seed_item_id").orderBy(F.desc("score"), "chapter_num", "para_index")
    best = scored.withColumn("place", F.row_number().over(w).cast("long")).filter(F.col("place") <= top)
    evidence_id = F.concat(F.lit("ev_"), F.substring(sha256(F.concat_ws("|", "seed_item_id", F.col("chapter_num").cast("string"), F.col("para_index").cast("string"), "para_hash")), 1, 20))
    listed = F.array_join(F.transform("breakdown", lambda x: F.concat_ws(":", x["name"], x["points"].cast("string"))), ",")
    return best.select(evidence_id.alias("evidence_id"), "seed_item_id", "category", "chapter_num", "para_index", "start_offset", "end_offset", "para_hash", "para_text", "score", listed.alias("breakdown"), F.array_join("matched", ",").alias("matched_keywords"), F.size("matched").cast("long").alias("matched_count"), F.array_max(F.transform("matched", F.length)).alias("longest"), "evidence_type", "place")


def reviewed(found: DataFrame, chapters: DataFrame) -> DataFrame:
    """Back-cut against the chapters, review flags, the suggested status and duplicate paragraphs."""
    cut = cut_again(found, chapters, "evidence_id").select(F.col("evidence_id").alias("__id"), "cut")
    r = found.join(cut, F.col("evidence_id") == F.col("__id"), "left").withColumn("backcut", F.coalesce(sha256(F.col("cut")) == F.col("para_hash"), F.lit(False))).drop("__id", "cut")
    weak = (F.col("matched_count") == 0) | ((F.col("matched_count") == 1) & (F.col("longest") <= 1))
    rule = F.col("evidence_type") == "rule_violation_candidate"
    strong = (F.col("score") >= 50) & (F.col("matched_count") >= 2)
    same = F.count(F.lit(1)).over(Window.partitionBy("para_hash"))
    flags = F.array_compact(F.array(
        F.when(~F.col("backcut"), "invalid_backcut"), F.when(F.col("score") < 20, "low_score"), F.when(weak, "weak_keyword_match"), F.when(rule, "rule_violation_candidate"),
        F.when(F.length(strip(F.col("para_text"))) < SHORT, "short_paragraph"), F.when(F.col("backcut") & strong, "high_confidence_candidate"), F.when(same > 1, "duplicate_paragraph"),
    ))
    status = F.when(~F.col("backcut"), "invalid").when(rule, "needs_review").when(strong, "likely_relevant").when((F.col("score") < 20) | weak, "likely_irrelevant").otherwise("needs_review")
    return r.withColumns({"review_flags": F.array_join(flags, ","), "suggested_status": status})


def coverage(seeds: DataFrame, found: DataFrame, decisions: DataFrame) -> DataFrame:
    """For each seed: accepted evidence, coverage, and for gaps the reason, risk and next action."""
    per = found.join(decisions, "evidence_id", "left").groupBy("seed_item_id").agg(
        F.count(F.lit(1)).alias("candidates"), F.count("human_status").alias("reviews"), F.count_if(F.col("human_status") == "accepted").alias("accepted"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("human_status") == "accepted", F.col("chapter_num")))), ",").alias("chapters"),
    )
    zero = F.lit(0).cast("long")
    c = seeds.select("seed_item_id", "category").join(per, "seed_item_id", "left").withColumns({k: F.coalesce(k, zero) for k in ("candidates", "reviews", "accepted")} | {"chapters": F.coalesce("chapters", F.lit(""))})
    reason = F.when(F.col("accepted") > 0, None).when(F.col("candidates") == 0, "no_candidate_evidence").when(F.col("reviews") == 0, "no_review_evidence").otherwise("no_accepted_evidence")
    risk = F.when(F.col("category") == "rule", "high").when(F.col("category").isin("godway", "domain", "lord", "item"), "medium").otherwise("low")
    action = F.when(F.col("accepted") > 0, "keep_as_coverage_locked").when((F.col("gap_reason") == "no_candidate_evidence") | (F.col("risk_level") == "high"), "schedule_followup_evidence_search").otherwise("keep_as_uncovered_for_now")
    return c.withColumns({"gap_reason": reason, "risk_level": risk}).withColumns({"coverage_status": F.when(F.col("accepted") > 0, "covered").otherwise("uncovered"), "next_action": action})


def reader_rows(accepted: DataFrame, lock: DataFrame) -> DataFrame:
    """A row a seed of the lock with its accepted evidence as an ordered array; fails where the lock lacks a seed.

    accepted: seed_item_id, evidence_id, chapter_num; at most a few dozen a seed. lock: seed_item_id, coverage_status and columns to keep.
    """
    refs = accepted.groupBy("seed_item_id").agg(F.array_sort(F.collect_list(F.struct("chapter_num", "evidence_id"))).alias("evidence_refs"))
    rows = refs.join(lock, "seed_item_id", "left")
    missing = F.raise_error(F.concat(F.lit("coverage lock misses seed "), "seed_item_id"))
    rows = rows.withColumn("coverage_status", F.when(F.col("coverage_status").isNotNull(), F.col("coverage_status")).otherwise(missing))
    return rows.withColumn("accepted_evidence_count", F.size("evidence_refs").cast("long"))


def filter_reader_rows(rows: DataFrame, chapter_num: int | None = None, **equal: str | None) -> DataFrame:
    """Rows whose named columns equal the given values, None for any, with only the evidence of the chapter, if given; seeds without evidence left go."""
    for name, wanted in equal.items():
        if wanted is not None:
            rows = rows.filter(F.col(name) == wanted)
    if chapter_num is not None:
        rows = rows.withColumn("evidence_refs", F.filter("evidence_refs", lambda e: e["chapter_num"] == chapter_num))
    return rows.filter(F.size("evidence_refs") > 0).withColumn("accepted_evidence_count", F.size("evidence_refs").cast("long"))


def lock_summary(covered: DataFrame, expected: int, most_accepted: int = 3) -> DataFrame:
    """One row: totals, coverage rate, and whether the lock holds."""
    s = covered.agg(
        F.count(F.lit(1)).alias("seeds"), F.count_if(F.col("accepted") > 0).alias("covered"), F.sum("accepted").alias("accepted"), F.sum(F.col("candidates") - F.col("reviews")).alias("pending"), F.max("accepted").alias("most_accepted"),
        (F.count(F.lit(1)) - F.count_distinct("seed_item_id")).alias("duplicate_seeds"),
    )
    holds = (F.col("duplicate_seeds") == 0) & (F.col("pending") == 0) & (F.col("most_accepted") <= most_accepted) & (F.col("seeds") == expected)
    return s.withColumns({"coverage_rate": F.round(F.col("covered") / F.col("seeds"), 6), "lock_holds": holds})
