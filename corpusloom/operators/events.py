"""Event understanding: triggers, arguments, review, confirmation, groups, order, impacts, gate.

Rules are the caller's; their terms are found by one pass over each sentence and
joined on equality. The review takes events with their context from one pass over
each chapter. Every other step joins on ids.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.intervals import bucket_of, over_buckets
from corpusloom.functions.terms import automaton, checked, distinct_terms, found, held, term_starts
from corpusloom.functions.terms import longest as longest_terms
from corpusloom.functions.text import WS, let, sha256, stable_id
from corpusloom.operators import chunking as C
from corpusloom.sources.staging import materialize, release

#: Words and scores of the review rules.
PRONOUNS = ("he", "she", "they", "him", "her", "他", "她", "它", "他们", "她们", "对方")
SUBJECT_LIKE = ("subject", "agent", "speaker", "mover", "discoverer", "attacker", "defender", "actor", "performer", "observer")
NO_NAMES = ("the", "this", "that", "room", "door", "view", "chapter", "he", "she", "they", "him", "her", "他们", "我们", "你们", "众人", "所有人", "男人", "女人", "少年", "少女", "老人", "孩子", "灾厄", "怪物", "声音", "目光", "身体", "空气", "世界")
SPEECH = ("said", "asked", "answered", "shouted", "whispered", "说道", "说", "问", "喊", "开口", "回答", "冷笑")
CONFIDENCE = {"high": 0.8, "medium": 0.5, "low": 0.2}
DECISION_CONFIDENCE = {"low": 0.25, "medium": 0.6, "high": 0.9}
DECISIONS = ("approved_candidate", "rejected", "duplicate_candidate", "needs_context", "uncertain", "weak_candidate")
BLOCKED = {"duplicate_candidate": "blocked_by_duplicate", "rejected": "blocked_by_rejected", "needs_context": "blocked_by_needs_context", "uncertain": "blocked_by_uncertain", "weak_candidate": "blocked_by_weak_candidate"}
RELATIONSHIPS = (("conflict", "attack|injury|death|conflict|wound|kill"), ("cooperation", "help|rescue|protect|cooperate|deliver"), ("authority", "order|judge|appoint|punish|control"), ("information", "reveal|discover|inform|hide"))
STATES = (("life_status", "death|die|kill", "dead_or_at_risk", "event_type_state_hint"), ("injury_status", "injury|wound|attack", "injured_or_at_risk", "event_type_state_hint"), ("power_status", "power|upgrade|awaken|realm", "power_changed", "power_state_hint"))


#: Parts of an order that are summed up together.
PARTS = 1 << 16


def lookup(value: Column, table: dict, default: object = None) -> Column:
    chain = None
    for k, v in table.items():
        chain = F.when(value == k, v) if chain is None else chain.when(value == k, v)
    return chain.otherwise(F.lit(default))


def normalized(text: Column) -> Column:
    """Lower case without any white space."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), f"{WS}+", ""))


def rule_table(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    """rule_id, family, type, terms, negatives, confidence, (state type, from, to) or None; the order is the priority. One row a term."""
    rows = [(i, r[0], r[1], r[2], term, r[4], r[5], *(r[6] or (None, None, None))) for i, r in enumerate(rules) for term in r[3]]
    return spark.createDataFrame(rows, "priority int, rule_id string, event_family string, event_type string, term string, negatives array<string>, confidence string, state_type string, from_state string, to_state string")


def triggers(sentences: DataFrame, rules: DataFrame) -> DataFrame:
    """All occurrences of all terms whose rule no negative vetoes; of equal spans the first by rule is kept, the others are marked as skipped.

    The rules, whose terms the driver has held already, go to the sentences: a shuffle by term would put all that one term finds in one task.
    """
    hit = sentences.withColumn("found", F.explode(term_starts(F.col("sentence_text"), distinct_terms(rules, "term")))).withColumn("__term", F.col("found.term"))
    hit = hit.join(F.broadcast(rules), F.col("__term") == F.col("term")).filter(~F.exists("negatives", lambda n: F.col("sentence_text").contains(n)))
    hit = hit.withColumn("at", F.explode("found.starts")).drop("found", "__term")
    hit = hit.withColumns({"trigger_start": F.col("start_offset") + F.col("at")}).withColumn("trigger_end", F.col("trigger_start") + F.length("term"))
    w = Window.partitionBy("sentence_id", "trigger_start", "trigger_end").orderBy("priority", F.desc(F.length("term")))
    return hit.withColumn("kept", F.row_number().over(w) == 1).withColumn("event_id", event_id()).withColumnRenamed("term", "trigger_text").drop("negatives", "at")


def event_id() -> Column:
    return stable_id("evt", F.col("rule_id"), F.col("sentence_id"), F.col("trigger_start"), F.col("trigger_end"))


def state_changes(events: DataFrame) -> DataFrame:
    return events.filter("state_type is not null").select(stable_id("sch", F.col("event_id"), F.col("state_type"), F.col("from_state"), F.col("to_state")).alias("state_change_id"), "event_id", "state_type", "from_state", "to_state")


def enclosing_scene(events: DataFrame, scenes: DataFrame) -> DataFrame:
    """event_id and the first block that holds the event's sentence."""
    s = scenes.select("chapter_id", "version_id", "scene_key", "scene_index", F.col("start_offset").alias("b_start"), F.col("end_offset").alias("b_end"), *over_buckets(F.col("start_offset"), F.col("end_offset")))
    inside = events.withColumn("bucket", bucket_of(F.col("start_offset"))).join(s, ["chapter_id", "version_id", "bucket"]).filter("b_start <= start_offset and end_offset <= b_end")
    return inside.groupBy("event_id").agg(F.min_by("scene_key", "b_start").alias("scene_key"), F.min_by("scene_index", "b_start").alias("scene_index"))


def arguments(events: DataFrame, appearances: DataFrame) -> DataFrame:
    """Characters of the same sentence or else paragraph, each once; the bare trigger where there is none.

    The either-or join is two equality joins.
    """
    e = events.select("event_id", "sentence_id", "para_id", "trigger_text")
    a = appearances.select("character_id", "alias_text", "match_start", "appearance_id", F.col("sentence_id").alias("a_sentence"), F.col("para_id").alias("a_para"))
    near = e.join(a, e["sentence_id"] == a["a_sentence"]).withColumn("distance", F.lit(0))
    wide = e.join(a, (e["para_id"] == a["a_para"]) & (e["sentence_id"] != a["a_sentence"])).withColumn("distance", F.lit(1))
    both = near.unionByName(wide)
    w = Window.partitionBy("event_id", "character_id", "alias_text").orderBy("distance", "match_start", "appearance_id")
    found = both.withColumn("k", F.row_number().over(w)).filter("k = 1").select("event_id", F.lit("character").alias("role"), "character_id", F.col("alias_text").alias("entity_text"), F.when(F.col("distance") == 0, "same_sentence").otherwise("same_paragraph").alias("scope"), "match_start")
    bare = e.join(both.select("event_id").distinct(), "event_id", "left_anti")
    return found.unionByName(bare.select("event_id", F.lit("unknown").alias("role"), F.lit(None).cast("string").alias("character_id"), F.col("trigger_text").alias("entity_text"), F.lit("raw_trigger").alias("scope"), F.lit(None).cast("long").alias("match_start")))


#: Characters between a name and the trigger after it at which the name is the trigger's subject, or its agent.
SUBJECT_GAP, AGENT_GAP = 1, 20


def placed_role(name: Column) -> Column:
    """A name's role by its place and the event's trigger: of names of the sentence that end before the trigger the speaker of speech, the mover of a movement, the subject right before it, the agent near it."""
    gap = F.col("trigger_start") - name["match_start"] - F.length(name["entity_text"])
    near = (name["scope"] == "same_sentence") & (gap >= 0)
    return (
        F.when(near & F.col("trigger_text").isin(*SPEECH), "speaker")
        .when(near & (gap <= SUBJECT_GAP), "subject")
        .when(near & (F.col("event_family") == "movement"), "mover")
        .when(near & (gap <= AGENT_GAP), "agent")
        .otherwise("character")
    )


#: The names around an event.
NAMES = "array<struct<match_start:long,character_id:string,entity_text:string,scope:string>>"
_RULE = ("rule_id", "event_family", "event_type", "confidence", "state_type", "from_state", "to_state")


def in_context(chapters: DataFrame, rules: DataFrame, aliases: DataFrame, longest: int = C.BLOCK_MAX) -> DataFrame:
    """The kept triggers with what their chapters hold around them: sentence, the one before it in the paragraph, text that the offsets cut, block, names, and how many events have the same trigger in the sentence and the same evidence in the chapter.

    What ``triggers``, ``arguments`` and ``enclosing_scene`` find in stored layers,
    by one pass over each chapter: no layer is written, and nothing moves to meet
    its neighbours. Rules and aliases travel to the workers whole.
    """
    of_term: dict[str, list[tuple]] = {}
    for r in sorted(held(rules), key=lambda r: r["priority"]):
        if r["term"] and r["negatives"] is not None:
            of_term.setdefault(r["term"], []).append((r["negatives"], tuple(r[c] for c in _RULE)))
    owners: dict[str, list[tuple]] = {}
    for r in held(aliases):
        if r["alias_text"]:
            owners.setdefault(r["alias_text"], []).append((r["character_id"], r["valid_from"], r["valid_to"]))
    terms, names = checked(of_term), checked(owners)
    fields = [(n, "long") for n in ("para_index", "sentence_index", "start_offset", "end_offset", "scene_index", "trigger_start", "trigger_end", "same_trigger", "same_evidence")] + [(n, "string") for n in ("sentence_text", "previous", "cut", "trigger_text", *_RULE)] + [("names", NAMES)]

    def fired(text: str) -> Iterator[tuple[str, list[int], tuple]]:
        """Terms with their places and the first rule that nothing vetoes; equal spans are of one term."""
        for term, starts in found(text, automaton(terms)).items():
            for negatives, rule in of_term[term]:
                if not any(n is None or n in text for n in negatives):
                    yield term, starts, rule
                    break

    def named(u: C.Unit, num: int | None) -> dict[tuple, int]:
        """The first place of each character's alias that is valid in the chapter."""
        first: dict[tuple, int] = {}
        for at, alias in longest_terms(u.text, automaton(names)):
            for character, low, high in owners[alias]:
                if num is not None and (low is None or low <= num) and (high is None or num <= high):
                    first.setdefault((character, alias), u.s + at)
        return first

    def rows_of(content: str, num: int | None) -> Iterator[tuple]:
        hits, evidence = [], Counter()
        for k, (_, _, inside) in enumerate(C.blocks_with_sentences(content, longest), 1):
            for _, units in groupby(inside, key=lambda u: u.para):
                units = list(units)
                hit = [(j, u, f) for j, u in enumerate(units) if (f := list(fired(u.text)))]
                near = [named(u, num) for u in units] if hit else []
                wide: dict[tuple, int] = {}
                for first in near:
                    wide = first | wide
                for j, u, f in hit:
                    around = [{"match_start": at, "character_id": c, "entity_text": t, "scope": "same_sentence" if (c, t) in near[j] else "same_paragraph"} for (c, t), at in (wide | near[j]).items()]
                    hits.append((k, u, units[j - 1].text if j else None, f, around))
                    evidence[u.text] += sum(len(starts) for _, starts, _ in f)
        for k, u, previous, f, around in hits:
            cut = content[u.s : u.e]
            for term, starts, rule in f:
                for at in starts:
                    yield u.para, u.i, u.s, u.e, k, u.s + at, u.s + at + len(term), len(starts), evidence[u.text], u.text, previous, cut, term, *rule, around

    x = C.expand(chapters, fields, rows_of)
    x = x.withColumns({"para_id": C.paragraph_id("chapter_id", "para_index"), "sentence_id": C.sentence_id("chapter_id", "para_index", "sentence_index"), "scene_key": C.scene_key(), "sentence_hash": sha256(F.col("sentence_text"))})
    return x.withColumn("event_id", event_id())


def review_export(events: DataFrame) -> DataFrame:
    """Events in context with their arguments in order and sorted warnings; the bare trigger is the argument where there is no name.

    events: as ``in_context`` gives them, with backcut_status of the evidence that each has.
    """
    argument = lambda start, character, text, role: F.struct(start.alias("match_start"), character.alias("character_id"), text.alias("entity_text"), role.alias("role"))
    none = lambda kind: F.lit(None).cast(kind)
    listed = F.array_sort(F.transform("names", lambda n: argument(n["match_start"], n["character_id"], n["entity_text"], placed_role(n))))
    bare = F.array(argument(none("long"), none("string"), F.col("trigger_text"), F.lit("unknown")))
    people = F.filter("arguments", lambda x: x["character_id"].isNotNull())
    x = events.withColumn("arguments", F.when(F.size("names") > 0, listed).otherwise(bare)).withColumn("__people", people)
    x = x.withColumns({"characters": F.size("__people").cast("long"), "character_texts": F.array_join(F.transform("__people", lambda a: a["entity_text"]), ",")})
    has = lambda role: F.exists("arguments", lambda a: a["role"] == role)
    warnings = F.array_compact(F.array(
        F.when(F.col("backcut_status").isNull(), "missing_evidence_span"), F.when(F.coalesce(F.col("trigger_text"), F.lit("")) == "", "missing_trigger_text"), F.when(F.size("arguments") <= 0, "missing_argument"),
        F.when(~has("subject"), "missing_subject_candidate"), F.when(F.col("scene_key").isNull(), "missing_scene_block"), F.when(F.coalesce(F.col("backcut_status"), F.lit("")) != "ok", "evidence_backcut_not_ok"),
        F.when(F.col("confidence") == "low", "weak_candidate"), F.when(F.col("state_type").isNull(), "event_without_state_change"), F.when(F.col("same_trigger") > 1, "duplicate_trigger_same_sentence"), F.when(F.col("same_evidence") > 1, "duplicate_event_same_evidence"),
    ))
    return x.withColumns({"warnings": F.array_sort(warnings), "confidence_score": lookup(F.col("confidence"), CONFIDENCE, 0.5)}).drop("__people", "names", "cut", "same_trigger", "same_evidence")


def _place(start: Column, text: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), (start + F.length(text)).cast("long").alias("end"), text.alias("text"))


def _last_place(before: Column, text: Column) -> Column:
    """Where a text stands for the last time, or null."""
    at = F.instr(F.reverse(before), F.reverse(text))
    return F.when((text != "") & (at > 0), _place(F.length(before) - at - F.length(text) + 1, text))


_WORD = r"[\p{L}\p{N}_]"
_CAPITAL = rf"(?s)\A(.*)(?<!{_WORD})(?!(?i:{'|'.join(n for n in NO_NAMES if n.isascii())})(?!{_WORD}))([A-Z][a-z]{{1,32}})(?!{_WORD})"


def name_before(text: Column, trigger: Column, arguments: Column) -> Column:
    """The name that stands last before the trigger's first occurrence: an argument's text, a capitalised word, or two to four Han characters; null if none."""
    before = F.when(F.instr(text, trigger) > 0, F.substring(text, F.lit(1), F.instr(text, trigger) - 1)).otherwise(text)

    def last(b: Column) -> Column:
        own = F.transform(arguments, lambda a: F.when(~F.lower(a["entity_text"]).isin(*NO_NAMES), _last_place(b, a["entity_text"])))
        capital = F.when(F.regexp_extract(b, _CAPITAL, 2) != "", _place(F.length(F.regexp_extract(b, _CAPITAL, 1)), F.regexp_extract(b, _CAPITAL, 2)))
        han = F.filter(F.regexp_extract_all(b, F.lit(r"[\x{4e00}-\x{9fff}]{2,4}"), F.lit(0)), lambda w: ~w.isin(*NO_NAMES) & ~w.startswith("第"))
        return F.array_max(F.array_compact(F.concat(F.coalesce(own, F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")), F.array(capital, _last_place(b, F.try_element_at(han, F.lit(-1)))))))["text"]

    return let(before, last)


#: Confidence of each rule that finds a subject.
SUBJECT_RULES = {"existing_subject_candidate": 0.9, "l5_argument_agent": 0.82, "l5_argument_speaker": 0.82, "l5_argument_subject": 0.82, "pronoun_back_reference": 0.45, "quoted_speech_speaker_pattern": 0.82, "nearest_character_before_trigger": 0.72}


def enhance(exported: DataFrame, sentences: DataFrame | None = None) -> DataFrame:
    """A subject by the first rule that finds one, with score and recommendation.

    The previous sentence is in exported, or is met by its number in sentences.
    """
    x = exported
    if sentences is not None:
        before = sentences.select(F.col("para_id"), (F.col("sentence_index") + 1).alias("sentence_index"), F.col("sentence_text").alias("previous"))
        x = exported.join(before, ["para_id", "sentence_index"], "left")
    first = F.lower(F.regexp_extract("sentence_text", rf"\A{WS}*([A-Za-z\x{{4e00}}-\x{{9fff}}]+)", 1))
    named = F.filter("arguments", lambda a: F.coalesce(a["entity_text"], F.lit("")) != "")
    given = F.get(F.filter(named, lambda a: a["role"] == "subject"), 0)
    like = F.get(F.filter(named, lambda a: a["role"].isin(*SUBJECT_LIKE)), 0)
    x = x.withColumns({"given": given["entity_text"], "like": like["entity_text"], "like_role": like["role"], "pronoun": first.isin(*PRONOUNS), "named": named})
    x = x.withColumns({"here": name_before(F.col("sentence_text"), F.col("trigger_text"), F.col("named")), "there": F.when(F.col("pronoun"), name_before(F.concat(F.coalesce("previous", F.lit("")), F.lit(" "), "trigger_text"), F.col("trigger_text"), F.col("named")))})
    rule = (
        F.when(F.col("given").isNotNull(), "existing_subject_candidate")
        .when(F.col("like_role").isin("agent", "speaker"), F.concat(F.lit("l5_argument_"), "like_role"))
        .when(F.col("like").isNotNull(), "l5_argument_subject")
        .when(F.col("there").isNotNull(), "pronoun_back_reference")
        .when(F.col("here").isNotNull() & F.col("trigger_text").isin(*SPEECH), "quoted_speech_speaker_pattern")
        .when(F.col("here").isNotNull(), "nearest_character_before_trigger")
        .otherwise("not_found")
    )
    x = x.withColumn("subject_rule", rule)
    by_rule = F.when(F.col("subject_rule") != "not_found", F.coalesce("given", "like", "there", "here"))
    x = x.withColumns({"subject_text": by_rule, "subject_confidence": lookup(F.col("subject_rule"), SUBJECT_RULES, 0.0)})
    has, weak, sound = F.col("subject_text").isNotNull(), F.col("subject_confidence") < 0.6, F.col("backcut_status") == "ok"
    repeated = F.array_contains("warnings", "duplicate_event_same_evidence")
    points = lambda when, n: F.when(when, n).otherwise(0.0)
    score = F.col("confidence_score") + points(has, 0.15) + points(sound, 0.05) + points(F.col("scene_key").isNotNull(), 0.05) - points(has & weak, 0.10) - points(F.coalesce(~sound, F.lit(True)), 0.15) - points(repeated, 0.10)
    advice = (
        F.when(repeated | F.array_contains("warnings", "duplicate_trigger_same_sentence"), "likely_duplicate")
        .when(~has | (F.col("subject_confidence") < 0.5), "needs_context")
        .when(F.array_contains("warnings", "weak_candidate"), "weak_candidate")
        .when(sound, "ready_for_l5_3_candidate")
        .otherwise("review_candidate")
    )
    return x.withColumns({"quality_score": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(score, 2))), "recommendation": advice}).drop("here", "there", "pronoun", "previous", "given", "like", "like_role", "named")


def normalize(enhanced: DataFrame, direct: tuple[str, ...], by_candidate: dict[str, str], by_category: dict[str, str], importance: dict[str, str]) -> DataFrame:
    """All rows with skip_reason; those without one are normalized events."""
    mapped = F.coalesce(F.when(F.col("event_type").isin(*direct), F.col("event_type")), lookup(F.col("event_type"), by_candidate), lookup(F.col("event_family"), by_category))
    x = enhanced.withColumn("normalized_type", mapped)
    skip = F.when(~F.col("recommendation").isin("ready_for_l5_3_candidate", "weak_candidate", "likely_duplicate"), F.concat(F.lit("recommendation_"), "recommendation")).when(F.col("normalized_type").isNull(), "unmapped_event_type")
    confidence = F.least(F.lit(1.0), F.round(F.greatest("confidence_score", "subject_confidence") + 0.05, 4))
    return x.withColumns({"skip_reason": skip, "normalized_event_id": stable_id("nev", F.col("event_id"), F.col("normalized_type")), "normalized_confidence": confidence, "importance": lookup(F.col("normalized_type"), importance, "medium")})


def validated(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Imported decisions with their errors, whether their event's rows contradict, and a warning for weak approvals."""
    ids = known.select(F.col("normalized_event_id").alias("known_id"))
    r = rows.join(ids, rows["normalized_event_id"] == ids["known_id"], "left")
    t = ids.withColumnRenamed("known_id", "target_id")
    r = r.join(t, r["duplicate_target"] == t["target_id"], "left")
    confidence = F.coalesce(lookup(F.lower(F.trim("confidence_text")), DECISION_CONFIDENCE), F.col("confidence_text").try_cast("double"))
    r = r.withColumn("confidence_value", F.when(confidence.between(0.0, 1.0), confidence))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    duplicate = F.col("decision") == "duplicate_candidate"
    errors = F.array_compact(F.array(
        F.when(F.col("known_id").isNull(), "unknown_event"), F.when(~F.col("decision").isin(*DECISIONS), "invalid_decision"), F.when(~blank("confidence_text") & F.col("confidence_value").isNull(), "invalid_confidence"),
        F.when(duplicate & blank("duplicate_target"), "duplicate_target_missing"), F.when(duplicate & (F.col("duplicate_target") == F.col("normalized_event_id")), "duplicate_target_self"), F.when(duplicate & ~blank("duplicate_target") & F.col("target_id").isNull(), "duplicate_target_not_found"),
        F.when((F.col("decision") == "needs_context") & blank("reason"), "context_reason_missing"), F.when((F.col("decision") == "rejected") & blank("reason"), "reject_reason_missing"),
    ))
    signatures = F.size(F.collect_set(F.struct("decision", F.coalesce("duplicate_target", F.lit("")), F.coalesce("reason", F.lit("")))).over(Window.partitionBy("batch", "normalized_event_id")))
    r = r.withColumns({"errors": F.array_join(errors, ","), "contradicts": signatures > 1})
    return r.withColumn("warning", F.when((F.col("decision") == "approved_candidate") & (F.col("confidence_value") < 0.5), "approved_with_low_confidence")).drop("known_id", "target_id")


def current_decisions(checked: DataFrame) -> DataFrame:
    """The last valid row of each event without contradiction."""
    valid = checked.filter("errors = '' and not contradicts")
    return valid.groupBy("normalized_event_id").agg(F.max_by(F.struct("decision", "duplicate_target", "reason", "confidence_value", "source_row"), "source_row").alias("d")).select("normalized_event_id", "d.*")


def cycles(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: node, target, a row a node. The nodes that lie on a cycle, with the cycle's least node as cycle_id and its length.

    Pointer doubling. After k rounds every node that still has one points 2 ** k
    steps on. The set of what is pointed at shrinks until only cycles are left, and
    once a round leaves its size as it was, it is they: rounds grow with the
    logarithm of the longest tail. A second doubling, on cycles alone, carries their
    least node round them.
    """

    def step(df: DataFrame) -> DataFrame:
        ahead = df.select(F.col("node").alias("at"), F.col("at").alias("then"), *(F.col(c).alias(f"{c}_then") for c in df.columns if c == "least"))
        least = [F.least("least", "least_then").alias("least"), (F.col("least_then") < F.col("least")).alias("moved")] if "least" in df.columns else []
        return df.join(ahead, "at").select("node", F.col("then").alias("at"), *least)

    jumps, held = materialize(edges.select("node", F.col("target").alias("at")), "jumps", compact=True), None
    for _ in range(most_rounds):
        now = jumps.select("at").distinct().count()
        if now == held:
            break
        old, held, jumps = jumps, now, materialize(step(jumps), "jumps", compact=True)
        release(old)
    else:
        raise RuntimeError(f"cycles did not settle in {most_rounds} rounds")
    on = jumps.select(F.col("at").alias("node")).distinct()
    around = materialize(edges.join(on, "node").select("node", F.col("target").alias("at"), F.col("node").alias("least")), "around", compact=True)
    for _ in range(most_rounds):
        old, around = around, materialize(step(around), "around", compact=True)
        release(old)
        if not around.filter("moved").limit(1).count():
            break
    return around.select("node", F.col("least").alias("cycle_id")).join(around.groupBy(F.col("least").alias("cycle_id")).agg(F.count(F.lit(1)).alias("cycle_length")), "cycle_id").select("node", "cycle_id", "cycle_length")


def duplicate_conflicts(current: DataFrame) -> DataFrame:
    """What is wrong with current duplicate decisions taken together: cycles of any length, and targets that are rejected.

    normalized_event_id, duplicate_target, conflict_type, and for cycles their least id and length.
    """
    d = current.filter("decision = 'duplicate_candidate'").select("normalized_event_id", "duplicate_target")
    around = cycles(d.select(F.col("normalized_event_id").alias("node"), F.col("duplicate_target").alias("target")))
    turning = d.join(around.withColumnRenamed("node", "normalized_event_id"), "normalized_event_id").withColumn("conflict_type", F.lit("duplicate_cycle"))
    rejected = current.filter("decision = 'rejected'").select(F.col("normalized_event_id").alias("duplicate_target"))
    refused = d.join(rejected, "duplicate_target").select("normalized_event_id", "duplicate_target", F.lit("duplicate_target_rejected").alias("conflict_type"), F.lit(None).cast("string").alias("cycle_id"), F.lit(None).cast("long").alias("cycle_length"))
    return turning.select(refused.columns).unionByName(refused)


def confirm(events: DataFrame, checked: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Each event or decided id: confirmed, or the first reason that blocks it. conflicts: normalized_event_id of decisions that are in conflict with others."""
    against = conflicts.select("normalized_event_id", F.lit(True).alias("contradicts"))
    conflict = checked.select("normalized_event_id", "contradicts").unionByName(against).groupBy("normalized_event_id").agg(F.max("contradicts").alias("conflict"))
    d = current_decisions(checked).select("normalized_event_id", "decision")
    e = events.select("normalized_event_id", F.lit(True).alias("present"))
    x = e.join(d, "normalized_event_id", "full_outer").join(conflict, "normalized_event_id", "left")
    conflicted = F.coalesce("conflict", F.lit(False))
    reason = F.when(F.col("present").isNull(), "blocked_by_source_missing").when(conflicted, "blocked_by_conflict").when(F.col("decision").isNull(), "blocked_by_missing_review").when(F.col("decision") != "approved_candidate", lookup(F.col("decision"), BLOCKED, "blocked_by_conflict"))
    readiness = F.when(conflicted, "blocked_by_conflict").when(F.col("decision").isNull(), "missing_review_decision").when(F.col("decision") == "approved_candidate", "ready_for_l5_5").otherwise(lookup(F.col("decision"), BLOCKED, "blocked_by_conflict"))
    return x.select("normalized_event_id", "decision", conflicted.alias("conflict"), reason.alias("block_reason"), readiness.alias("readiness"), F.when(reason.isNull(), stable_id("cev", F.col("normalized_event_id"))).alias("confirmed_id"))


def signature() -> Column:
    """The digest of what events of one group have in common."""
    parts = [F.col("chapter_num").cast("string"), *(F.concat(F.lit('"'), normalized(F.col(c)), F.lit('"')) for c in ("scene_key", "subject_text", "normalized_type", "object_text"))]
    return F.unhex(sha256(F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))))


def groups(confirmed: DataFrame) -> DataFrame:
    """Members of merge groups with their rank; a signature's members are one group."""
    x = confirmed
    by = Window.partitionBy("signature")
    rank = F.row_number().over(by.orderBy("chapter_num", "trigger_start", "confirmed_id"))
    size = F.count(F.lit(1)).over(by)
    x = x.withColumns({"group_id": F.concat(F.lit("mg_"), F.lower(F.hex(F.substring("signature", 1, 8)))), "member_rank": rank.cast("long"), "member_count": size})
    several = F.col("member_count") > 1
    return x.withColumns({"member_role": F.when(F.col("member_rank") == 1, "representative").otherwise("member"), "group_kind": F.when(several, "exact_event_signature").otherwise("singleton_group"), "group_confidence": F.when(several, 1.0).otherwise(0.5)})


def global_positions(df: DataFrame, part: Column, *order: str) -> DataFrame:
    """Rows numbered over (part, *order): ranks inside a part, plus the sizes of the parts before it.

    part: numbers that rise with the order and that a bounded number of rows
    share. Parts are summed up in two levels, so no task sees all of them.
    """
    df = df.withColumn("__part", part.cast("long")).withColumn("__wide", F.floor(F.col("__part") / PARTS))
    upto = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = df.groupBy("__wide", "__part").agg(F.count(F.lit(1)).alias("__n"))
    wide = sizes.groupBy("__wide").agg(F.sum("__n").alias("__n")).withColumn("__before", upto(Window.orderBy("__wide"))).drop("__n")
    sizes = sizes.withColumn("__base", upto(Window.partitionBy("__wide").orderBy("__part"))).drop("__n").join(wide, "__wide")
    base = sizes.select("__part", (F.col("__base") + F.col("__before")).alias("__base"))
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    return ranked.join(base, "__part").withColumn("position", F.col("__base") + F.col("__rank")).drop("__part", "__wide", "__base", "__rank")


def timeline(members: DataFrame, eras: DataFrame) -> DataFrame:
    """One anchor a group, in narrative order, with the relation to the next one; eras: chapter_num, era."""
    g = members.groupBy("group_id").agg(F.min("chapter_num").alias("chapter_num"), F.min(F.coalesce("scene_index", F.lit(0))).alias("scene_index"), F.min(F.coalesce("trigger_start", F.lit(0))).alias("evidence_offset"), F.first("member_count").alias("member_count"))
    placed = materialize(global_positions(g, F.col("chapter_num"), "scene_index", "evidence_offset", "group_id").join(eras, "chapter_num", "left"), "placed-groups", compact=True)
    kind = F.when(F.col("era").isNotNull(), "era_anchor").otherwise("chapter_order_anchor")
    key = F.format_string("ch%06d:scene%06d:evidence%08d", "chapter_num", "position", "evidence_offset")
    a = placed.withColumns({"anchor_id": stable_id("tla", F.col("group_id")), "anchor_kind": kind, "anchor_confidence": F.when(F.col("era").isNotNull(), "medium").otherwise("low"), "order_key": key, "absolute_order_key": F.when(F.col("era").isNotNull(), F.concat(F.lit("era:"), F.col("era"), F.lit(":"), key)).otherwise("")})
    following = a.select((F.col("position") - 1).alias("position"), F.col("anchor_id").alias("next_anchor_id"), F.col("chapter_num").alias("next_chapter"))
    relation = F.when(F.col("next_anchor_id").isNull(), None).when(F.col("next_chapter") == F.col("chapter_num"), "same_chapter").otherwise("before")
    return a.join(following, "position", "left").withColumn("relation_to_next", relation).drop("next_chapter")


def timeline_audit(anchors: DataFrame) -> DataFrame:
    """A row for each anchor that only its chapter's place could order."""
    kind = F.lit("fallback_to_chapter_order")
    return anchors.filter("era is null").select(stable_id("tla_aud", F.col("anchor_id"), kind).alias("audit_id"), "anchor_id", "group_id", kind.alias("audit_type"), F.lit("info").alias("severity"))


def role_or_fallback(role: Column, fallback: Column, allowed: tuple[str, ...]) -> Column:
    """The role if it is an allowed one, else the first allowed of the fallback, subject, object and unknown, else the least allowed one; a missing role is its fallback, and a missing fallback subject."""
    given = lambda c: F.nullif(c, F.lit(""))
    tried = F.array(F.coalesce(given(role), given(fallback), F.lit("subject")), given(fallback), *map(F.lit, ("subject", "object", "unknown")))
    return F.coalesce(F.get(F.filter(tried, lambda r: r.isin(*allowed)), 0), F.lit(min(allowed)))


def impacts(members: DataFrame) -> DataFrame:
    """Relationship and state impact of each confirmed event, with the audit of what it lacks.

    members: confirmed events with subject_text, object_text and location_text.
    """
    predicate = normalized(F.col("normalized_type"))
    relation = None
    for name, words in RELATIONSHIPS:
        relation = F.when(predicate.rlike(words), name) if relation is None else relation.when(predicate.rlike(words), name)
    both = normalized(F.concat_ws(" ", "normalized_type", F.coalesce("object_text", F.lit(""))))
    state = None
    for name, words, to, rule in STATES:
        value = F.struct(F.lit(name).alias("state"), F.lit(to).alias("to"), F.lit(rule).alias("rule"))
        state = F.when(both.rlike(words), value) if state is None else state.when(both.rlike(words), value)
    place = F.coalesce(F.col("location_text"), F.lit(""))
    moved = (place != "") & both.rlike("movement|arrive|leave|enter|escape")
    state = state.when(moved, F.struct(F.lit("location_status").alias("state"), place.alias("to"), F.lit("location_state_hint").alias("rule")))
    state = state.when(both.rlike("reveal|identity"), F.struct(F.lit("identity_status").alias("state"), F.lit("identity_information_changed").alias("to"), F.lit("event_type_state_hint").alias("rule"))).otherwise(F.struct(F.lit("unknown_state").alias("state"), F.lit("").alias("to"), F.lit("uncertainty_fallback").alias("rule")))
    subject, thing = normalized(F.col("subject_text")), normalized(F.col("object_text"))
    audit = F.when(subject == "", "missing_subject").when(thing == "", "missing_object").when(subject == thing, "same_subject_and_object")
    x = members.withColumns({"audit": audit, "__state": state})
    return x.select(
        "confirmed_id", "group_id", "subject_text", "object_text", "audit", F.when(F.col("audit").isNull(), relation.otherwise("unknown_interaction")).alias("relationship_type"), F.when(subject != "", F.col("__state.state")).alias("state_impact"),
        F.when(subject != "", F.col("__state.to")).alias("state_to"), F.when(subject != "", F.col("__state.rule")).alias("state_rule"),
        F.when((subject != "") & (F.col("__state.state") == "location_status"), place).alias("location_text"),
    )


def gate(events: DataFrame, confirmation: DataFrame, members: DataFrame, anchors: DataFrame, impact: DataFrame) -> DataFrame:
    """Chain status and score over the union of all layers' ids."""
    ids = events.select("normalized_event_id").union(confirmation.select("normalized_event_id")).distinct()
    c = confirmation.select("normalized_event_id", "decision", "confirmed_id")
    x = ids.join(c, "normalized_event_id", "left").join(members.select("confirmed_id", "group_id"), "confirmed_id", "left").join(anchors.select("group_id", "anchor_id"), "group_id", "left")
    x = x.join(impact.select("confirmed_id", "relationship_type", "state_impact"), "confirmed_id", "left")
    has = {"review": F.col("decision").isNotNull(), "confirmed": F.col("confirmed_id").isNotNull(), "merge": F.col("group_id").isNotNull(), "anchor": F.col("anchor_id").isNotNull(), "relationship": F.col("relationship_type").isNotNull(), "state": F.col("state_impact").isNotNull()}
    x = x.withColumns({f"has_{k}": v for k, v in has.items()})
    h = {k: F.col(f"has_{k}") for k in has}
    linked = h["confirmed"] & h["merge"] & h["anchor"]
    status = F.when(linked & h["relationship"], "full_chain").when(linked & h["state"], "partial_chain").when(h["confirmed"] & ~h["merge"], "missing_merge_group").when(h["confirmed"] & ~h["anchor"], "missing_timeline_anchor").when(h["review"] & ~h["confirmed"], "blocked_chain").when(~h["review"], "missing_review").otherwise("missing_impact")
    flag = lambda c: c.cast("int")
    score = (flag(h["review"]) + flag(h["confirmed"]) + flag(h["merge"]) + flag(h["anchor"]) + flag(h["relationship"] | h["state"])) / F.lit(5.0)
    return x.withColumns({"chain_status": status, "quality_score": score})


def gate_metrics(chains: DataFrame) -> DataFrame:
    """Totals and the gate's state as name and value rows."""
    s = chains.agg(F.count(F.lit(1)).alias("chains"), F.count_if(F.col("chain_status") == "full_chain").alias("full"), F.count_if(F.col("chain_status") == "partial_chain").alias("partial"), F.count_if(F.col("chain_status").isin("missing_merge_group", "missing_timeline_anchor")).alias("errors"), F.count_if(F.col("chain_status").isin("missing_review", "blocked_chain", "missing_impact")).alias("warnings"), F.round(F.avg("quality_score"), 6).alias("mean"))
    state = F.when(F.col("errors") > 0, "quality_fail").when(F.col("warnings") > 0, "quality_warning").otherwise("structure_pass")
    s = s.select(*(F.col(c).cast("string").alias(c) for c in ("chains", "full", "partial", "errors", "warnings")), F.format_string("%.6f", "mean").alias("mean"), state.alias("state"))
    return s.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in s.columns))).alias("m")).select("m.*")
