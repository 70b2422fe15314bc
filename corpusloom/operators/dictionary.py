"""Dictionary matching with offsets, and candidates from patterns.

Dictionaries are dimension tables of the caller's. Their terms are found by one
pass over each text, see ``functions.terms``, and joined to their owners on
equality. The dictionary goes to the matches, as its terms have gone already: a
shuffle by term would put all that one term finds in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.terms import distinct_terms, matches, term_starts
from corpusloom.functions.text import sha256

#: Words and shapes that are no person's name, and the name patterns' verbs.
NON_PERSON_TERMS = ("灰界", "灾厄", "能力", "规则", "组织", "先生", "夫人", "姑娘", "少年", "少女", "老人", "男人", "女人", "陛下", "殿下", "众人", "人类", "所有人")
NON_PERSON_SUFFIXES = ("神道", "界域", "灾厄", "能力", "规则", "组织", "军团", "小队", "协会", "城市", "国度", "王朝", "城", "殿", "宫", "山", "海", "河", "伞", "剑", "刀", "书")
NON_PERSON_PARTS = ("神道", "界域", "灰界", "灾厄", "能力", "规则", "组织")
HAN = r"[\x{4e00}-\x{9fff}]"
BEFORE_VERB = rf"({HAN}{{2,4}})(?:说道|问道|开口|低声道|笑道|冷笑道|沉声道|点头|摇头|看向|望向|皱眉|走进|走到|站起|喃喃道|叹道|问)"
AFTER_VERB = rf"(?:看向|望向|问|叫住|对|朝着|名叫|名为|唤作)({HAN}{{2,4}})"


def alias_table(spark: SparkSession, aliases: list[tuple[str, str, int | None, int | None]]) -> DataFrame:
    """character_id, alias_text and its first and last valid chapter (null: open)."""
    return spark.createDataFrame(aliases, "character_id string, alias_text string, valid_from long, valid_to long")


def appearances(sentences: DataFrame, aliases: DataFrame) -> DataFrame:
    """A row for each leftmost longest match of the aliases and each owner whose interval holds the chapter."""
    hit = sentences.withColumn("m", F.explode(matches(F.col("sentence_text"), distinct_terms(aliases, "alias_text"))))
    hit = hit.withColumns({"matched_text": F.col("m.m"), "match_start": F.col("start_offset") + F.col("m.s")}).withColumn("match_end", F.col("match_start") + F.length("matched_text"))
    valid = F.col("chapter_num").between(F.coalesce("valid_from", F.col("chapter_num")), F.coalesce("valid_to", F.col("chapter_num")))
    owned = hit.join(F.broadcast(aliases), (F.col("matched_text") == F.col("alias_text")) & valid)
    key = F.concat_ws("|", "character_id", "alias_text", "version_id", "sentence_id", F.col("match_start").cast("string"), F.col("match_end").cast("string"))
    columns = ["character_id", "alias_text", "chapter_num", "chapter_id", "version_id", "para_id", "sentence_id", "match_start", "match_end"]
    return owned.select(F.concat(F.lit("app_"), F.substring(sha256(key), 1, 16)).alias("appearance_id"), *columns)


def alias_occurrences(sentences: DataFrame, aliases: DataFrame) -> DataFrame:
    """Every alias by itself: non-overlapping occurrences in the sentences that contain it."""
    valid = F.col("chapter_num").between(F.coalesce("valid_from", F.col("chapter_num")), F.coalesce("valid_to", F.col("chapter_num")))
    hit = sentences.withColumn("found", F.explode(term_starts(F.col("sentence_text"), distinct_terms(aliases, "alias_text"))))
    hit = hit.join(F.broadcast(aliases), (F.col("found.term") == F.col("alias_text")) & valid).withColumn("at", F.explode("found.starts"))
    return hit.select("character_id", "alias_text", "chapter_num", "sentence_id", (F.col("start_offset") + F.col("at")).alias("match_start"))


def person_name(value: Column) -> Column:
    """Two to four Han characters that name no thing, or null."""
    name = F.regexp_replace(value, rf"[^{HAN[1:-1]}]", "")
    bad = ~F.length(name).between(2, 4) | name.isin(*NON_PERSON_TERMS) | name.rlike("(?:" + "|".join(NON_PERSON_SUFFIXES) + r")\z") | name.rlike("|".join(NON_PERSON_PARTS))
    return F.when(~bad, name)


def name_candidates(sentences: DataFrame, surnames: str) -> DataFrame:
    """Names by speech or action, by address, and by surname: sentence columns with name and source_type."""
    rules = ((BEFORE_VERB, "speech_or_action_pattern"), (AFTER_VERB, "address_pattern"), (rf"([{surnames}]{HAN}{{1,2}})", "surname_pattern"))
    named = lambda kind: lambda x: F.struct(person_name(x).alias("name"), F.lit(kind).alias("source_type"))
    found = F.flatten(F.array(*(F.transform(F.regexp_extract_all("sentence_text", F.lit(p), F.lit(1)), named(k)) for p, k in rules)))
    return sentences.withColumn("c", F.explode(found)).select("chapter_num", "sentence_id", "c.name", "c.source_type").filter("name is not null")


def candidate_characters(found: DataFrame, least: int, seeds: list[str], most_evidence: int = 10) -> DataFrame:
    """Names seen often enough or listed, with first sight, kinds of source and the first pieces of evidence.

    Evidence is cut to its first pieces by a window limit before it is gathered.
    """
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("name").orderBy("chapter_num", "sentence_id", "source_type"))
    first = found.withColumn("place", place).filter(F.col("place") <= most_evidence)
    evidence = first.groupBy("name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "sentence_id"))), lambda e: e["sentence_id"]), ",").alias("evidence"))
    totals = found.groupBy("name").agg(F.count(F.lit(1)).alias("evidence_count"), F.min("chapter_num").alias("first_chapter"), F.array_join(F.array_sort(F.collect_set("source_type")), ",").alias("source_types"))
    kept = totals.filter((F.col("evidence_count") >= least) | F.col("name").isin(seeds))
    return kept.join(evidence, "name").select(F.concat(F.lit("char_"), F.substring(sha256(F.col("name")), 1, 12)).alias("character_id"), "name", "evidence_count", "first_chapter", "source_types", "evidence")


def pattern_spans(sentences: DataFrame, patterns: DataFrame) -> DataFrame:
    """patterns: owner_id, pattern, negatives (array). Non-overlapping spans of each pattern where no negative occurs; sentence-relative."""
    hit = sentences.withColumn("found", F.explode(term_starts(F.col("sentence_text"), distinct_terms(patterns, "pattern"))))
    hit = hit.join(F.broadcast(patterns), F.col("found.term") == F.col("pattern")).filter(~F.exists("negatives", lambda n: F.col("sentence_text").contains(n)))
    return hit.withColumn("start", F.explode("found.starts")).select("owner_id", "pattern", "chapter_num", "sentence_id", F.col("start").cast("long").alias("start"), (F.col("start") + F.length("pattern")).cast("long").alias("end"))


def first_present(text: Column, values: list[str]) -> Column:
    """The value that stands first in the text; of two at one place the earlier in the list; null if none."""
    places = F.array_compact(F.array(*(F.when(F.instr(text, v) > 0, F.struct(F.instr(text, v).alias("at"), F.lit(i).alias("i"), F.lit(v).alias("v"))) for i, v in enumerate(values))))
    return F.array_min(places)["v"]


def invasions(sentences: DataFrame, zones: list[tuple[str, list[str]]], disasters: list[tuple[str, list[str]]], kinds: list[tuple[str, list[str]]], places: list[str], spreading: tuple[str, ...]) -> DataFrame:
    """An actor, disasters before zones, with the first kind of invasion that has a word present, and the place affected."""
    text = F.col("sentence_text")
    first_owner = lambda defs: F.coalesce(*(F.when(first_present(text, p).isNotNull(), F.struct(F.lit(i).alias("id"), first_present(text, p).alias("v"))) for i, p in defs))
    rows = sentences.withColumns({"zone": first_owner(zones), "disaster": first_owner(disasters), "kind": first_owner(kinds), "place": first_present(text, places)})
    rows = rows.filter("(disaster is not null or zone is not null) and kind is not null")
    return rows.select(
        "chapter_num", "sentence_id", F.col("disaster.id").alias("disaster_id"), F.col("zone.id").alias("zone_id"), F.coalesce("disaster.v", "zone.v").alias("actor"), F.col("kind.id").alias("invasion_type"), F.col("kind.v").alias("word"),
        F.coalesce("place", F.lit("unknown")).alias("affected"), F.when(F.col("kind.id").isin(*spreading), "spreading").otherwise("unknown").alias("state"), F.when(F.col("place").isNull(), 0.5).otherwise(1.0).alias("score"),
    )
