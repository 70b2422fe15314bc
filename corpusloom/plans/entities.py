"""Queries of entity dictionaries, appearances, relations and pattern candidates."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import chunking as C
from corpusloom.operators import dictionary as D
from corpusloom.operators import relations as R
from corpusloom.plans import corpus_sql as S
from corpusloom.plans.corpus import BLOCK, block_rows, units
from corpusloom.plans.registry import query
from corpusloom.sources.corpus import table
from corpusloom.sources.staging import materialize

ALIASES = [("chr_a", "Thing", None, None), ("chr_a", "Thingou", None, None), ("chr_b", "Heit", None, None), ("chr_c", "Ment", 1, 700), ("chr_d", "Ción", None, None), ("chr_e", "Thing", 1, 400), ("chr_f", "Haor", 100, None), ("chr_g", "Ung", None, None), ("chr_h", "Re", None, None)]
#: For SQL: the aliases as one alternation, longest first.
PATTERN = "|".join(re.escape(a) for a in sorted({a for _, a, _, _ in ALIASES}, key=lambda a: (-len(a), a)))
WINDOW = 200

_val = lambda v: "NULL::BIGINT" if v is None else str(v)
ALIAS_SQL = "al(character_id, alias_text, valid_from, valid_to) AS (VALUES " + ", ".join(f"('{c}', '{a}', {_val(f)}, {_val(t)})" for c, a, f, t in ALIASES) + ")"
VALID_SQL = "chapter_num BETWEEN coalesce(valid_from, chapter_num) AND coalesce(valid_to, chapter_num)"
SENT_SQL = "sn AS (SELECT chapter_num, chapter_id, version_id, chapter_id || '_p_' || printf('%04d', para_index) AS para_id, chapter_id || '_p_' || printf('%04d', para_index) || '_s_' || printf('%04d', sentence_index) AS sentence_id, start_offset, sentence_text FROM se JOIN ch USING (chapter_num))"
APP_SQL = f"""{ALIAS_SQL}, {SENT_SQL},
mx AS (SELECT *, regexp_extract_all(sentence_text, '{PATTERN}') AS ms, regexp_split_to_array(sentence_text, '{PATTERN}') AS gs FROM sn WHERE regexp_matches(sentence_text, '{PATTERN}')),
mi AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM mx),
mp AS (SELECT chapter_num, chapter_id, version_id, para_id, sentence_id, ms[i] AS matched_text, start_offset + list_sum(list_transform(list_slice(gs, 1, i), lambda s: len(s))) + coalesce(list_sum(list_transform(list_slice(ms, 1, i - 1), lambda s: len(s))), 0) AS match_start FROM mi),
mo AS (SELECT mp.*, character_id, alias_text, (match_start + len(matched_text))::BIGINT AS match_end FROM mp JOIN al ON matched_text = alias_text AND {VALID_SQL}),
ap AS (SELECT 'app_' || substr(sha256(concat_ws('|', character_id, alias_text, version_id, sentence_id, match_start::BIGINT::VARCHAR, match_end::VARCHAR)), 1, 16) AS appearance_id, character_id, alias_text, chapter_num, chapter_id, version_id, para_id, sentence_id, match_start::BIGINT AS match_start, match_end FROM mo)"""


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.sentences(units(spark, sf_dir))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.appearances(sentences(spark, sf_dir), D.alias_table(spark, ALIASES))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appearances written once, for joins with themselves."""
    return materialize(found(spark, sf_dir), "appearances")


def relation_sql(scope: str, keys: str, source: str = "ap") -> str:
    """The relation rows over a source of appearances that meet where keys are equal."""
    named = {k: (k if k in keys.split(", ") else "NULL::VARCHAR") for k in ("scene_block_id", "para_id", "sentence_id")}
    on = " AND ".join(f"x.{k} = y.{k}" for k in ("chapter_id", "version_id", *filter(None, keys.split(", "))))
    cols = ", ".join(f"x.{k}" for k in filter(None, keys.split(", ")))
    listed = lambda c: f"'[' || array_to_string(list_transform({c}, lambda i: '\"' || i || '\"'), ', ') || ']'"
    return f"""gx AS (SELECT chapter_id, chapter_num, version_id{", " + keys if keys else ""}, character_id, list(appearance_id ORDER BY match_start, appearance_id) AS ids, list(match_start) AS os FROM {source} GROUP BY ALL),
gp AS (SELECT x.chapter_id, x.chapter_num, x.version_id{", " + cols if cols else ""}, x.character_id AS character_id_a, y.character_id AS character_id_b, x.ids AS ia, y.ids AS ib, list_min(list_transform(x.os, lambda a: list_min(list_transform(y.os, lambda b: abs(a - b))))) AS min_distance FROM gx x JOIN gx y ON {on} AND x.character_id < y.character_id)
{emit_sql(scope, named, listed)}"""


def emit_sql(scope: str, named: dict[str, str], listed) -> str:
    q = lambda c: f"coalesce('\"' || {c} || '\"', 'null')"
    payload = f"""'{{"appearance_ids_a": ' || {listed("ia")} || ', "appearance_ids_b": ' || {listed("ib")} || ', "chapter_id": "' || chapter_id || '", "character_id_a": "' || character_id_a || '", "character_id_b": "' || character_id_b || '", "evidence_scope": "{scope}", "para_id": ' || {q(named["para_id"])} || ', "scene_block_id": ' || {q(named["scene_block_id"])} || ', "sentence_id": ' || {q(named["sentence_id"])} || ', "version_id": "' || version_id || '"}}'"""
    key = f"'{scope}|' || chapter_id || '|' || version_id || '|' || coalesce({named['scene_block_id']}, '') || '|' || coalesce({named['para_id']}, '') || '|' || coalesce({named['sentence_id']}, '') || '|' || character_id_a || '|' || character_id_b"
    return f"""SELECT 'rel_' || substr(sha256({key}), 1, 16) AS relation_id, character_id_a, character_id_b, chapter_id, chapter_num, version_id, '{scope}' AS evidence_scope, {named["scene_block_id"]} AS scene_block_id, {named["para_id"]} AS para_id, {named["sentence_id"]} AS sentence_id,
{listed("ia")} AS appearance_ids_a, {listed("ib")} AS appearance_ids_b, len(ia)::BIGINT AS mention_count_a, len(ib)::BIGINT AS mention_count_b, min_distance, sha256({payload}) AS evidence_hash FROM gp"""


@query(f"WITH {S.SENTENCES}, {APP_SQL} SELECT * FROM ap")
def j06_alternation_appearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 one alternation of all aliases, F13 validity, X14 ids, G11 alias rows."""
    return found(spark, sf_dir)


OCC = lambda t, p: f"list_transform(range(1, len(string_split({t}, {p}))), lambda i: (list_sum(list_transform(list_slice(string_split({t}, {p}), 1, i), lambda s: len(s))) + (i - 1) * len({p}))::BIGINT)"


@query(f"WITH {S.SENTENCES}, {ALIAS_SQL}, {SENT_SQL}, o AS (SELECT character_id, alias_text, chapter_num, sentence_id, start_offset, unnest({OCC('sentence_text', 'alias_text')}) AS pos FROM sn JOIN al ON contains(sentence_text, alias_text) AND {VALID_SQL}) SELECT character_id, alias_text, chapter_num, sentence_id, start_offset + pos AS match_start FROM o")
def j05_alias_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 every alias by itself in the sentences that contain it."""
    return D.alias_occurrences(sentences(spark, sf_dir), D.alias_table(spark, ALIASES))


@query(f"WITH {S.SENTENCES}, {APP_SQL}, ph AS (SELECT chapter_id || '_p_' || printf('%04d', para_index) AS para_id, sha256(para_text) AS h, content FROM pa JOIN ch USING (chapter_num)) SELECT count(*) AS appearances, sum((ph.para_id IS NULL)::INT)::BIGINT AS no_paragraph, sum((substr(content, match_start + 1, match_end - match_start) = alias_text)::INT)::BIGINT AS verified, count(DISTINCT appearance_id) AS ids FROM ap LEFT JOIN ph USING (para_id)")
def j07_appearance_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7 paragraph lookup, J31 orphans, J34 back-cut of appearances, A2 unique ids."""
    rows = units(spark, sf_dir)
    app = D.appearances(C.sentences(rows), D.alias_table(spark, ALIASES))
    paras = C.paragraphs(rows).select(F.concat_ws("_", "chapter_id", F.lit("p"), C.number("para_index")).alias("para_id"), "start_offset", "para_text")
    again = F.substring("para_text", (F.col("match_start") - F.col("start_offset") + 1).cast("int"), (F.col("match_end") - F.col("match_start")).cast("int"))
    j = app.join(paras, "para_id", "left")
    return j.agg(F.count(F.lit(1)).alias("appearances"), F.count_if(F.col("start_offset").isNull()).alias("no_paragraph"), F.count_if(again == F.col("alias_text")).alias("verified"), F.count_distinct("appearance_id").alias("ids"))


@query(f"WITH {S.SENTENCES}, {APP_SQL}, {relation_sql('same_sentence', 'para_id, sentence_id')}")
def j08_same_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 pairs in a sentence, J12 relation rows, X13 canonical JSON hash."""
    return R.same_sentence(stored(spark, sf_dir))


@query(f"WITH {S.SENTENCES}, {APP_SQL}, {relation_sql('same_paragraph', 'para_id')}")
def j09_same_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.same_paragraph(stored(spark, sf_dir))


@query(f"WITH {S.SENTENCES}, {APP_SQL}, {relation_sql('same_chapter', '')}")
def j09_same_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.same_chapter(stored(spark, sf_dir))


@query(f"WITH RECURSIVE {S.blocks(BLOCK)}, {APP_SQL}, sc AS (SELECT ap.*, bl.scene_key AS scene_block_id FROM ap JOIN bl ON bl.chapter_id = ap.chapter_id AND bl.version_id = ap.version_id AND match_start >= bl.start_offset AND match_start < bl.end_offset), {relation_sql('same_scene_block', 'scene_block_id', 'sc')}")
def j10_same_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10 appearances inside half-open block intervals."""
    return R.same_scene(stored(spark, sf_dir), block_rows(spark, sf_dir))


_listed = lambda c: f"'[' || array_to_string(list_transform({c}, lambda i: '\"' || i || '\"'), ', ') || ']'"


@query(
    f"""WITH {S.SENTENCES}, {APP_SQL},
np AS (SELECT l.chapter_id, l.chapter_num, l.version_id, CASE WHEN l.character_id < r.character_id THEN l.character_id ELSE r.character_id END AS character_id_a, CASE WHEN l.character_id < r.character_id THEN r.character_id ELSE l.character_id END AS character_id_b,
  CASE WHEN l.character_id < r.character_id THEN {{'o': l.match_start, 'i': l.appearance_id}} ELSE {{'o': r.match_start, 'i': r.appearance_id}} END AS ea, CASE WHEN l.character_id < r.character_id THEN {{'o': r.match_start, 'i': r.appearance_id}} ELSE {{'o': l.match_start, 'i': l.appearance_id}} END AS eb, r.match_start - l.match_start AS d
  FROM ap l JOIN ap r ON l.chapter_id = r.chapter_id AND l.version_id = r.version_id AND (r.match_start > l.match_start OR (r.match_start = l.match_start AND r.appearance_id > l.appearance_id)) AND r.match_start - l.match_start <= {WINDOW} AND l.character_id <> r.character_id),
gp AS (SELECT chapter_id, chapter_num, version_id, character_id_a, character_id_b, list(ea.i ORDER BY ea.o, ea.i) AS ia, list(eb.i ORDER BY eb.o, eb.i) AS ib, min(d) AS min_distance FROM np GROUP BY ALL)
{emit_sql("nearby_window", dict.fromkeys(("scene_block_id", "para_id", "sentence_id"), "NULL::VARCHAR"), _listed)}"""
)
def j11_nearby_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11 band self-join over bucketed offsets; ids repeat with every pair."""
    return R.nearby(stored(spark, sf_dir), WINDOW)


@query(f"WITH {ALIAS_SQL} SELECT x.alias_text, x.character_id AS character_id_a, y.character_id AS character_id_b FROM al x JOIN al y ON x.alias_text = y.alias_text AND x.character_id < y.character_id AND coalesce(x.valid_from, 0) <= coalesce(y.valid_to, 1099511627776) AND coalesce(y.valid_from, 0) <= coalesce(x.valid_to, 1099511627776)")
def j32_alias_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J32 one alias of two owners in overlapping intervals."""
    a = D.alias_table(spark, ALIASES).select(*(F.coalesce(c, F.lit(v)).alias(c) for c, v in (("valid_from", 0), ("valid_to", 1 << 40))), "character_id", "alias_text")
    x, y = a.alias("x"), a.alias("y")
    on = (F.col("x.alias_text") == F.col("y.alias_text")) & (F.col("x.character_id") < F.col("y.character_id")) & (F.col("x.valid_from") <= F.col("y.valid_to")) & (F.col("y.valid_from") <= F.col("x.valid_to"))
    return x.join(y, on).select(F.col("x.alias_text").alias("alias_text"), F.col("x.character_id").alias("character_id_a"), F.col("y.character_id").alias("character_id_b"))


#: Made-up Chinese sentences for the name patterns, since the test documents have none.
SAMPLES = ["周甲说道：吴乙看向灰界。", "郑丙问王丁云，赵乙低声道。", "众人望向青山界域，钱丙点头。", "少年名叫孙小石，周甲摇头。", "他走进城市，叫住李大木！", "没有名字。"]
SURNAMES = "周吴郑赵钱孙李王"
SAMPLE_SQL = "sp AS (SELECT doc_id + 1 AS chapter_num, 's' || doc_id AS sentence_id, [" + ", ".join(f"'{s}'" for s in SAMPLES) + f"][(doc_id % {len(SAMPLES) + 1} + 1)::INT] AS sentence_text FROM documents)"
_HAN = r"[\x{4e00}-\x{9fff}]"
NAMES_SQL = f"""{SAMPLE_SQL},
nr AS (SELECT chapter_num, sentence_id, unnest(regexp_extract_all(sentence_text, '{D.BEFORE_VERB}', 1)) AS v, 'speech_or_action_pattern' AS source_type FROM sp
  UNION ALL SELECT chapter_num, sentence_id, unnest(regexp_extract_all(sentence_text, '{D.AFTER_VERB}', 1)), 'address_pattern' FROM sp
  UNION ALL SELECT chapter_num, sentence_id, unnest(regexp_extract_all(sentence_text, '([{SURNAMES}]{_HAN}{{1,2}})', 1)), 'surname_pattern' FROM sp),
nm AS (SELECT chapter_num, sentence_id, v AS name, source_type FROM nr WHERE len(v) BETWEEN 2 AND 4 AND v NOT IN ({", ".join(f"'{t}'" for t in D.NON_PERSON_TERMS)}) AND NOT regexp_matches(v, '(?:{"|".join(D.NON_PERSON_SUFFIXES)})\\z') AND NOT regexp_matches(v, '{"|".join(D.NON_PERSON_PARTS)}'))"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.get(F.array(*map(F.lit, SAMPLES)), (F.col("doc_id") % (len(SAMPLES) + 1)).cast("int"))
    return table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("chapter_num"), F.concat(F.lit("s"), "doc_id").alias("sentence_id"), text.alias("sentence_text"))


@query(f"WITH {NAMES_SQL} SELECT * FROM nm")
def x32_name_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X31 name normalisation, X32 three patterns, G10 occurrence records; on made-up sentences, a row a document, as no text of the tables is Chinese."""
    return D.name_candidates(samples(spark, sf_dir), SURNAMES)


@query(
    f"""WITH {NAMES_SQL}, pl AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY chapter_num, sentence_id, source_type) AS place FROM nm),
g AS (SELECT name, count(*) AS evidence_count, min(chapter_num) AS first_chapter, string_agg(DISTINCT source_type, ',' ORDER BY source_type) AS source_types, string_agg(sentence_id, ',' ORDER BY place) FILTER (place <= 10) AS evidence FROM pl GROUP BY name)
SELECT 'char_' || substr(sha256(name), 1, 12) AS character_id, name, evidence_count, first_chapter, source_types, evidence FROM g WHERE evidence_count >= 20 OR name IN ('吴乙')"""
)
def a06_candidate_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 candidates by count or seed, with first sight and first evidence; on the made-up sentences of x32."""
    return D.candidate_characters(D.name_candidates(samples(spark, sf_dir), SURNAMES), 20, ["吴乙"])


ZONES = [("dz_gray", ["Grau", "grau"]), ("dz_tide", ["tion", "tionen"])]
NEGATIVES = {"dz_gray": ["graut"], "dz_tide": ["nation"]}
DISASTERS = [("d_heit", ["heit"]), ("d_ment", ["ment", "Ment"]), ("d_ing", ["inging"])]
KINDS = [("erosion", ["ver", "erod"]), ("pollution", ["que"]), ("arrival", ["with", "que"])]
PLACES = ["und", "les", "the"]
SPREADING = ("erosion", "expansion", "pollution", "coverage")
_list = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
PATTERN_SQL = "zp(owner_id, pattern, negatives) AS (VALUES " + ", ".join(f"('{z}', '{p}', {_list(NEGATIVES[z])})" for z, ps in ZONES for p in ps) + ")"


@query(f"WITH {S.SENTENCES}, {SENT_SQL}, {PATTERN_SQL}, x AS (SELECT owner_id, pattern, chapter_num, sentence_id, unnest({OCC('sentence_text', 'pattern')}) AS start FROM sn JOIN zp ON contains(sentence_text, pattern) AND len(list_filter(negatives, lambda n: contains(sentence_text, n))) = 0) SELECT *, start + len(pattern) AS \"end\" FROM x")
def g08_zone_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G8 dictionary spans with negatives, F18 negative predicate, M5 seed dimension."""
    rows = [(z, p, NEGATIVES[z]) for z, ps in ZONES for p in ps]
    patterns = spark.createDataFrame(rows, "owner_id string, pattern string, negatives array<string>")
    return D.pattern_spans(sentences(spark, sf_dir), patterns)


def _first_sql(values: list[str]) -> str:
    items = ", ".join(f"{{'at': nullif(instr(sentence_text, '{v}'), 0), 'i': {i}, 'v': '{v}'}}" for i, v in enumerate(values))
    return f"(list_sort(list_filter([{items}], lambda s: s.at IS NOT NULL))[1]).v"


def _owner_sql(defs: list[tuple[str, list[str]]], what: str) -> str:
    return "CASE " + " ".join(f"WHEN {_first_sql(p)} IS NOT NULL THEN " + (f"'{i}'" if what == "id" else _first_sql(p)) for i, p in defs) + " END"


@query(
    f"""WITH {S.SENTENCES}, {SENT_SQL}, x AS (SELECT chapter_num, sentence_id, {_owner_sql(DISASTERS, "id")} AS disaster_id, {_owner_sql(ZONES, "id")} AS zone_id, coalesce({_owner_sql(DISASTERS, "v")}, {_owner_sql(ZONES, "v")}) AS actor, {_owner_sql(KINDS, "id")} AS invasion_type, {_owner_sql(KINDS, "v")} AS word, {_first_sql(PLACES)} AS place FROM sn)
SELECT chapter_num, sentence_id, disaster_id, zone_id, actor, invasion_type, word, coalesce(place, 'unknown') AS affected, CASE WHEN invasion_type IN ('erosion', 'expansion', 'pollution', 'coverage') THEN 'spreading' ELSE 'unknown' END AS state, CASE WHEN place IS NULL THEN 0.5 ELSE 1.0 END::DOUBLE AS score FROM x WHERE actor IS NOT NULL AND invasion_type IS NOT NULL"""
)
def g09_invasions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G9 invasion candidates, X38 first present term."""
    return D.invasions(sentences(spark, sf_dir), ZONES, DISASTERS, KINDS, PLACES, SPREADING)
