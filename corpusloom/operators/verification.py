"""Checks of stored layers: each row against what it was cut from, codes for whatever is wrong.

All checks are joins on ids and one cut of each chapter; nothing is gathered but a
segment's own links and a chapter's own spans. Rows of null ids match nothing and
are reported as untraceable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import sha256
from corpusloom.operators.chunking import cut_again
from corpusloom.operators.grounding import recover_json
from corpusloom.sources.staging import materialize

#: States of evidence that is cut out of its chapter again, in the order in which they are tried.
BACKCUT = ("missing_coordinate", "missing_l2_source", "offset_invalid", "empty_text", "hash_mismatch", "ok")
CANDIDATE_TABLES = {"zone_appearance_candidate": "zone_appearance", "disaster_appearance_candidate": "disaster_appearance", "habitat_appearance_candidate": "habitat_appearance", "disaster_invasion_candidate": "invasion_event"}
HUMAN_STATUS = ("accepted", "rejected", "needs_more")
#: Identities of a seed item in the order of their precedence.
SEED_IDENTITIES = ("item_id", "id", "godway_id", "rule_id", "domain_id", "lord_id", "item_path")


def given(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def cut_status(cut: Column, stored: Column) -> Column:
    """State of evidence that has been traced: the text that its offsets cut against its stored hash."""
    return F.when(cut.isNull(), BACKCUT[2]).when(cut == "", BACKCUT[3]).when(given(stored).isNotNull() & (stored != sha256(cut)), BACKCUT[4]).otherwise(BACKCUT[5])


def backcut_status(evidence: DataFrame, sentences: DataFrame, paragraphs: DataFrame, chapters: DataFrame) -> DataFrame:
    """evidence with status and the text that its offsets cut.

    evidence: evidence_id, chapter_id, version_id, sentence_id, para_id,
    start_offset and end_offset as text, evidence_hash. The sentence decides
    where one is named, else the paragraph. Rows are told apart by a number of
    their own: repeated and null ids give a row each.
    """
    e = materialize(evidence.withColumn("__row", F.monotonically_increasing_id()), "evidence").withColumns({"__key": F.concat_ws("|", "chapter_id", "version_id"), "__s": F.col("start_offset").try_cast("long"), "__e": F.col("end_offset").try_cast("long")})
    known = lambda df, c, name: df.select(F.col(c).alias(f"__{c}"), F.col("version_id").alias(f"__{c}_version"), F.lit(True).alias(name))
    for df, c, name in ((sentences, "sentence_id", "__in_sentences"), (paragraphs, "para_id", "__in_paragraphs")):
        k = known(df, c, name)
        e = e.join(k, (e[c] == k[f"__{c}"]) & (e["version_id"] == k[f"__{c}_version"]), "left").drop(f"__{c}", f"__{c}_version")
    keyed = chapters.withColumn("__key", F.concat_ws("|", "chapter_id", "version_id"))
    cut = cut_again(e.select("__key", "__row", F.col("__s").alias("start_offset"), F.col("__e").alias("end_offset")), keyed, "__row", "__key").select(F.col("__row").cast("long").alias("__row"), "has_chapter", "cut")
    e = e.join(cut, "__row").drop("__row")
    lacks = given(F.col("start_offset")).isNull() | given(F.col("end_offset")).isNull() | given(F.col("chapter_id")).isNull() | given(F.col("version_id")).isNull()
    traced = F.when(given(F.col("sentence_id")).isNotNull(), F.col("__in_sentences")).when(given(F.col("para_id")).isNotNull(), F.col("__in_paragraphs")).otherwise(True)
    status = (
        F.when(lacks, BACKCUT[0])
        .when(~F.coalesce(traced, F.lit(False)) | ~F.col("has_chapter"), BACKCUT[1])
        .otherwise(cut_status(F.col("cut"), F.col("evidence_hash")))
    )
    return e.withColumn("status", status).withColumn("evidence_text", F.when(F.col("status").isin(*BACKCUT[3:]), F.col("cut"))).drop("__key", "__s", "__e", "__in_sentences", "__in_paragraphs", "has_chapter", "cut")


def fingerprint_of(parts: Column) -> Column:
    """A segment's source fingerprint; parts: start-end-hash of its sentences in order, joined by semicolons."""
    return sha256(F.concat_ws("|", "scene_key", "chapter_id", "version_id", F.col("chapter_num").cast("string"), parts))


def violated(rules: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*(F.when(v, F.lit(n)) for v, n in rules)))


def packed(value: Column) -> Column:
    """A hexadecimal SHA-256 in 33 bytes, anything else as its text behind a zero byte: equal where the texts are."""
    mark = lambda n: F.lit(bytearray([n]))
    return F.when(value.rlike(r"\A[0-9a-f]{64}\z"), F.concat(mark(1), F.unhex(value))).otherwise(F.concat(mark(0), F.encode(value, "UTF-8")))


def unpacked(value: Column) -> Column:
    rest = F.substring(value, F.lit(2), F.length(value))
    return F.when(F.substring(value, 1, 1) == F.lit(bytearray([1])), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))


def digest(value: Column) -> Column:
    """16 bytes of a text's SHA-256, to compare it by."""
    return F.substring(F.unhex(sha256(value)), 1, 16)


def traced_links(links: DataFrame, sentences: DataFrame) -> DataFrame:
    """Links by child_segment_id: position, what they say of chapter and overlap, the sentence of their id, and whether they differ from it. A link is there once for each sentence of its id, or once without.

    Links and sentences meet by what stands before the paragraph in a sentence's
    id, so a chapter's rows lie together and what they share is packed; a
    segment's links are gathered there, before they move to it.
    """
    place = F.substring_index("sentence_id", "_p_", 1).alias("place")
    of_id = F.substring_index("sentence_id", "_s_", 1)
    truth = F.struct(F.nullif(F.col("para_id"), of_id).alias("para"), F.col("para_id").eqNullSafe(of_id).alias("para_of_id"), F.col("chapter_id").alias("chapter"), F.col("version_id").alias("version"), F.col("start_offset").alias("s"), F.col("end_offset").alias("e"), packed(F.col("sentence_hash")).alias("hash"))
    link = F.struct("child_segment_id", "chapter_id", "version_id", "position", "start_offset", "end_offset", digest(F.col("sentence_hash")).alias("hash"), "is_overlap")
    known = sentences.filter("sentence_id is not null").select(place, "sentence_id", truth.alias("t"))
    both = links.select(place, "sentence_id", link.alias("link")).unionByName(known, allowMissingColumns=True).repartition("place")
    met = both.withColumn("ts", F.collect_list("t").over(Window.partitionBy("place", "sentence_id"))).filter("link is not null").select("sentence_id", "link", F.explode_outer("ts").alias("t"))
    same = F.col("link.chapter_id").eqNullSafe(F.col("t.chapter")) & F.col("link.version_id").eqNullSafe(F.col("t.version"))
    row = F.struct(
        "link.position", "link.chapter_id", "link.version_id", "link.is_overlap", F.when(F.col("t").isNotNull(), F.col("sentence_id")).alias("t_id"), F.col("t.para").alias("t_para"), F.col("t.para_of_id").alias("para_of_id"), same.alias("same"), F.when(~same, F.col("t.chapter")).alias("t_chapter"), F.when(~same, F.col("t.version")).alias("t_version"), F.col("t.s").alias("t_start"), F.col("t.e").alias("t_end"), F.col("t.hash").alias("t_hash"),
        (F.col("link.start_offset") != F.col("t.s")).alias("start_differs"), (F.col("link.end_offset") != F.col("t.e")).alias("end_differs"), (F.col("link.hash") != digest(unpacked(F.col("t.hash")))).alias("hash_differs"),
    )
    gathered = met.groupBy(F.col("link.child_segment_id").alias("child_segment_id")).agg(F.collect_list(row).alias("links"))
    found = gathered.select("child_segment_id", F.explode("links").alias("l")).select("child_segment_id", "l.*")
    whole = {"t_para": F.when(F.col("para_of_id"), F.substring_index("t_id", "_s_", 1)).otherwise(F.col("t_para"))}
    whole |= {f"t_{k}": F.when(F.col("same"), F.col(f"{k}_id")).otherwise(F.col(f"t_{k}")) for k in ("chapter", "version")}
    return found.withColumns(whole).drop("para_of_id", "same")


def stray_overlaps(links: DataFrame, segments: DataFrame) -> DataFrame:
    """child_segment_id of segments with an overlapping link whose sentence the previous segment, or no previous one, holds not."""
    held = links.groupBy(F.col("child_segment_id").alias("p_child")).agg(F.collect_set("sentence_id").alias("held"))
    asked = links.filter("is_overlap").select("child_segment_id", "sentence_id").join(segments, "child_segment_id")
    there = F.coalesce(F.array_contains("held", F.col("sentence_id")), F.lit(False))
    return asked.join(held, F.col("previous_child_id") == F.col("p_child"), "left").filter(~there).select("child_segment_id").distinct()


def segment_violations(segments: DataFrame, links: DataFrame, scenes: DataFrame, sentences: DataFrame, chapters: DataFrame) -> DataFrame:
    """child_segment_id and code, a row for each rule that a stored segment breaks.

    segments: child_segment_id, chapter keys, scene_key, offsets, sentence_count,
    paragraph_count, first and last sentence and paragraph, segment_text,
    segment_hash, source_fingerprint, has_overlap, previous_child_id. links:
    child_segment_id, chapter_id, version_id, position, sentence_id, offsets,
    sentence_hash, is_overlap. A missing chapter, block or link ends a segment's
    checks, as what follows would repeat it.
    """
    ch = chapters.select(F.col("chapter_num").alias("c_num"), F.col("chapter_id").alias("c_id"), F.col("version_id").alias("c_version"))
    sc = scenes.select(F.col("scene_key").alias("b_key"), F.col("chapter_id").alias("b_chapter"), F.col("version_id").alias("b_version"), F.col("start_offset").alias("b_start"), F.col("end_offset").alias("b_end"))
    # texts are read where they are and only their digests move
    g = segments.withColumns({"own_digest": digest(F.col("segment_text")), "own_hash_differs": F.col("segment_hash") != sha256(F.col("segment_text"))})
    g = g.select("child_segment_id", "chapter_num", "chapter_id", "version_id", "scene_key", "start_offset", "end_offset", "sentence_count", "paragraph_count", "first_sentence_id", "last_sentence_id", "first_para_id", "last_para_id", packed(F.col("source_fingerprint")).alias("source_fingerprint"), "has_overlap", "previous_child_id", "own_digest", "own_hash_differs")
    g = g.join(ch, F.col("chapter_num") == F.col("c_num"), "left").join(sc, F.col("scene_key") == F.col("b_key"), "left")
    c = F.col
    early = [
        (c("c_num").isNull(), "chapter_missing"),
        (c("c_num").isNotNull() & ((c("chapter_id") != c("c_id")) | (c("version_id") != c("c_version"))), "chapter_identity"),
        (c("c_num").isNotNull() & c("b_key").isNull(), "scene_missing"),
    ]
    has_scene = c("b_key").isNotNull() & c("c_num").isNotNull()
    scene = [((c("chapter_id") != c("b_chapter")) | (c("version_id") != c("b_version")), "scene_identity"), ((c("start_offset") < c("b_start")) | (c("end_offset") > c("b_end")), "scene_boundary"), (c("sentence_count") < 1, "no_sentences")]
    g = g.withColumns({"has_scene": has_scene, "early": violated([*early, *((has_scene & v, n) for v, n in scene)])})
    g = materialize(g.drop("c_num", "c_id", "c_version", "b_key", "b_chapter", "b_version"), "checked-segments")

    own = g.select("child_segment_id", F.col("chapter_id").alias("g_chapter"), F.col("version_id").alias("g_version"), "b_start", "b_end")
    k = traced_links(links, sentences).join(own, "child_segment_id")
    some = lambda condition: F.coalesce(F.bool_or(condition), F.lit(False))
    different = lambda column: F.size(F.collect_set(column))
    found = k.groupBy("child_segment_id").agg(
        F.count(F.lit(1)).alias("n"), ((F.min("position") != 1) | (F.max("position") != F.count(F.lit(1))) | (different("position") != F.count(F.lit(1)))).alias("gap"), some((F.col("chapter_id") != F.col("g_chapter")) | (F.col("version_id") != F.col("g_version"))).alias("identity"),
        some(F.col("t_id").isNull()).alias("untraced"), some((F.col("t_chapter") != F.col("g_chapter")) | (F.col("t_version") != F.col("g_version"))).alias("other_chapter"), some((F.col("t_start") < F.col("b_start")) | (F.col("t_end") > F.col("b_end"))).alias("out_of_scene"),
        some("start_differs").alias("start"), some("end_differs").alias("end"), some("hash_differs").alias("hash"), some("is_overlap").alias("overlaps"),
        F.min_by(F.struct("t_id", "t_para", "t_start"), "position").alias("first"), F.max_by(F.struct("t_id", "t_para", "t_end"), "position").alias("last"), different("t_para").alias("paras"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", F.concat_ws("-", F.col("t_start").cast("string"), F.col("t_end").cast("string"), unpacked(F.col("t_hash"))).alias("part")))), lambda x: x["part"]), ";").alias("parts"),
    )
    stray = stray_overlaps(links, g.select("child_segment_id", "previous_child_id")).withColumn("stray_overlap", F.lit(True))
    cut = cut_again(g.select("chapter_num", "child_segment_id", "start_offset", "end_offset"), chapters, "child_segment_id").select("child_segment_id", digest(F.col("cut")).alias("cut_digest"))
    x = g.join(found.select("child_segment_id", F.struct("*").alias("k")), "child_segment_id", "left").join(cut, "child_segment_id", "left").join(stray, "child_segment_id", "left")

    scene = [(F.coalesce(c("k.n"), F.lit(0)) != c("sentence_count"), "link_count"), (c("k.n").isNull(), "no_links")]
    linked = [(c(f"k.{flag}"), code) for flag, code in (("gap", "link_position_gap"), ("identity", "link_identity"), ("untraced", "sentence_untraced"), ("other_chapter", "sentence_of_other_chapter"), ("out_of_scene", "sentence_out_of_scene"), ("start", "link_start"), ("end", "link_end"), ("hash", "link_hash"))]
    whole = [
        (c("first_sentence_id") != c("k.first.t_id"), "first_sentence"), (c("last_sentence_id") != c("k.last.t_id"), "last_sentence"), (c("start_offset") != c("k.first.t_start"), "starts_inside_sentence"), (c("end_offset") != c("k.last.t_end"), "ends_inside_sentence"),
        (~c("own_digest").eqNullSafe(c("cut_digest")), "text_backcut"), (c("own_hash_differs"), "text_hash"), (c("source_fingerprint") != packed(fingerprint_of(c("k.parts"))), "source_fingerprint"), (c("paragraph_count") != c("k.paras"), "paragraph_count"),
        ((c("first_para_id") != c("k.first.t_para")) | (c("last_para_id") != c("k.last.t_para")), "paragraph_boundary"), (c("has_overlap") & given(c("previous_child_id")).isNull(), "overlap_without_source"),
        (c("has_overlap") & given(c("previous_child_id")).isNotNull() & ~c("k.overlaps"), "overlap_without_links"), (c("has_overlap") & given(c("previous_child_id")).isNotNull() & c("stray_overlap"), "overlap_not_from_previous"),
    ]
    has_scene, has_links, traced = c("has_scene"), c("k.n").isNotNull(), ~c("k.untraced")
    rules = [*((has_scene & v, n) for v, n in scene), *((has_scene & has_links & v, n) for v, n in linked), *((has_scene & has_links & traced & v, n) for v, n in whole)]
    return x.select("child_segment_id", F.explode(F.concat("early", violated(rules))).alias("code"))


def span_backcuts(spans: DataFrame, sentences: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Per owner: spans, those whose text their sentence or paragraph does not give again, and those whose text does not hash to its hash.

    spans: owner_id, chapter_id, sentence_id, para_id, start, end (relative to
    the sentence, or to the paragraph where none is named), evidence_text,
    evidence_hash. Null offsets count as 0.
    """
    s = sentences.select(F.col("sentence_id").alias("s_id"), F.col("chapter_id").alias("s_chapter"), "sentence_text")
    p = paragraphs.select(F.col("para_id").alias("p_id"), F.col("chapter_id").alias("p_chapter"), "para_text")
    by_sentence = given(F.col("sentence_id")).isNotNull()
    x = spans.join(s, (F.col("sentence_id") == F.col("s_id")) & (F.col("chapter_id") == F.col("s_chapter")), "left")
    x = x.join(p, ~by_sentence & (F.col("para_id") == F.col("p_id")) & (F.col("chapter_id") == F.col("p_chapter")), "left")
    start, end = F.coalesce("start", F.lit(0)).cast("int"), F.coalesce("end", F.lit(0)).cast("int")
    cut = F.substring(F.when(by_sentence, F.col("sentence_text")).otherwise(F.col("para_text")), start + 1, F.greatest(end - start, F.lit(0)))
    return x.groupBy("owner_id").agg(F.count(F.lit(1)).alias("spans"), F.count_if(~cut.eqNullSafe(F.col("evidence_text"))).alias("backcut_errors"), F.count_if(~sha256(F.col("evidence_text")).eqNullSafe(F.col("evidence_hash"))).alias("hash_errors"))


def missing_scenes(relations: DataFrame, scenes: DataFrame) -> DataFrame:
    """Relations of one scene whose scene is not stored for their chapter and version."""
    s = scenes.select(F.col("scene_key").alias("scene_block_id"), "chapter_id", "version_id")
    return relations.filter("evidence_scope = 'same_scene_block'").join(s, ["scene_block_id", "chapter_id", "version_id"], "left_anti")


def segment_evidence_hash(segments: DataFrame) -> Column:
    """SHA-256 of a segment row as JSON with sorted keys."""
    text = lambda c: F.coalesce(F.concat(F.lit('"'), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')), F.lit("null"))
    plain = lambda c: F.col(c).cast("string")
    fields = [("chapter_id", text("chapter_id")), ("chapter_num", plain("chapter_num")), ("child_segment_id", text("child_segment_id")), ("end_para_id", text("last_para_id")), ("end_sentence_id", text("last_sentence_id")), ("scene_id", text("scene_key")), ("segment_text_hash", text("segment_hash")), ("source_fingerprint", text("source_fingerprint")), ("start_para_id", text("first_para_id")), ("start_sentence_id", text("first_sentence_id"))]
    return sha256(F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{n}":'), v) for n, v in fields)), F.lit("}")))


def seed_identity(*, source: str, content: str) -> Column:
    """A seed item's id: the item's own, then those of its rule by precedence, then its path. source and content are struct columns."""
    first, *inner, last = SEED_IDENTITIES
    return F.coalesce(given(F.col(f"{source}.{first}")), *(given(F.col(f"{content}.{i}")) for i in inner), given(F.col(f"{source}.{last}")), F.lit("unknown_seed_item"))


def candidate_identity() -> Column:
    """A candidate's own id, or its seed with its paragraph, or its seed with chapter and paragraph hash."""
    value = lambda c, other: F.coalesce(F.col(c), F.lit(other))
    own, para = given(F.col("candidate_id")), given(F.col("paragraph_id"))
    return F.when(own.isNotNull(), own).when(para.isNotNull(), F.concat_ws(":", "seed_item_id", para)).otherwise(F.concat_ws(":", "seed_item_id", value("chapter_id", "unknown_chapter"), value("paragraph_hash", "unknown_hash")))


def packet_entries(candidates: DataFrame, reviews: DataFrame) -> DataFrame:
    """Review packet entries: identity, text and the reviewer's word, which stands over the candidate's own.

    candidates: seed_item_id, candidate_id, paragraph_id, chapter_id,
    paragraph_hash, evidence_text, paragraph_text, human_status, human_note,
    review_note. reviews: review_key and the last three. A status outside the
    domain is an error.
    """
    r = reviews.select(F.col("review_key").alias("r_key"), F.struct("human_status", "human_note", "review_note").alias("review"))
    x = candidates.withColumn("entry_id", candidate_identity()).join(r, F.col("entry_id") == F.col("r_key"), "left")
    said = lambda c: F.when(F.col("r_key").isNotNull(), F.col(f"review.{c}")).otherwise(F.col(c))
    status = F.when(said("human_status").isNull() | said("human_status").isin(*HUMAN_STATUS), said("human_status")).otherwise(F.raise_error(F.concat(F.lit("invalid human_status of "), "entry_id")))
    text = F.coalesce(given(F.col("evidence_text")), given(F.col("paragraph_text")), F.lit(""))
    return x.select("entry_id", "seed_item_id", "chapter_id", text.alias("entry_text"), "paragraph_hash", status.alias("entry_status"), F.coalesce(said("human_note"), said("review_note"), F.lit("")).alias("entry_note"))


def applied_review(candidates: DataFrame, sentences: DataFrame) -> DataFrame:
    """Rows that accepted candidates become, by the table of their type; human values stand over guesses.

    candidates: candidate_id, candidate_type, chapter_id, sentence_id, start, end,
    evidence_text, owner_id, owner_type, type_guess, score, human_owner_id,
    human_owner_type, human_type, human_status. Candidates whose text their
    sentence does not give again are left out; one id becomes one row, of equal
    ids the least by owner.
    """
    s = sentences.select(F.col("sentence_id").alias("s_id"), F.col("chapter_id").alias("s_chapter"), "sentence_text")
    x = candidates.filter("human_status = 'accepted'").join(s, (F.col("sentence_id") == F.col("s_id")) & (F.col("chapter_id") == F.col("s_chapter")))
    x = x.filter(F.substring("sentence_text", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")) == F.col("evidence_text"))
    table = None
    for kind, name in CANDIDATE_TABLES.items():
        table = F.when(F.col("candidate_type") == kind, name) if table is None else table.when(F.col("candidate_type") == kind, name)
    pick = lambda human, guess: F.coalesce(given(F.col(human)), given(F.col(guess)))
    x = x.withColumn("target", table).filter("target is not null")
    rows = x.select(
        "target", F.concat(F.lit("dz_"), F.substring(sha256(F.concat_ws("|", "target", "candidate_id")), 1, 16)).alias("row_id"), "candidate_id", "chapter_id", "sentence_id", pick("human_owner_id", "owner_id").alias("owner_id"), pick("human_owner_type", "owner_type").alias("owner_type"),
        F.coalesce(pick("human_type", "type_guess"), F.lit("unknown")).alias("appearance_type"), F.coalesce("score", F.lit(1.0)).alias("confidence"), sha256(F.col("evidence_text")).alias("evidence_hash"), F.lit("accepted").alias("review_status"),
    )
    fields = [c for c in rows.columns if c not in ("target", "row_id")]
    return rows.groupBy("target", "row_id").agg(F.min(F.struct("owner_id", *(c for c in fields if c != "owner_id"))).alias("r")).select("target", "row_id", "r.*")


def workbook_findings(rows: DataFrame, required: list[str], known: dict[str, list[str]], flags: list[str], flag_col: str = "warning_flags_json") -> DataFrame:
    """finding and value: columns that a review workbook lacks, values outside their known sets, unknown flags, and how many rows hold no JSON flags.

    known: for a column its values. Blank values are no findings.
    """
    spark = rows.sparkSession
    missing = sorted(set(required) - set(rows.columns))
    out = spark.createDataFrame([("missing_field", c) for c in missing], "finding string, value string")
    for column, values in known.items():
        if column in rows.columns:
            out = out.union(rows.filter(given(F.col(column)).isNotNull() & ~F.col(column).isin(values)).select(F.lit(f"unknown_{column}").alias("finding"), F.col(column).cast("string").alias("value")).distinct())
    if flag_col in rows.columns:
        listed = rows.select(given(F.col(flag_col)).alias("j")).filter("j is not null").select(F.from_json("j", "array<string>").alias("flags"))
        each = listed.select(F.explode("flags").alias("value")).filter(~F.col("value").isin(flags)).distinct()
        broken = listed.agg(F.count_if(F.col("flags").isNull()).alias("n")).filter("n > 0").select(F.lit("invalid_flag_rows").alias("finding"), F.col("n").cast("string").alias("value"))
        out = out.union(each.select(F.lit("unknown_flag").alias("finding"), "value")).union(broken)
    return out


def forbidden_tables(existing: DataFrame, forbidden: list[str], column: str = "name") -> DataFrame:
    """Names of existing that must not be there."""
    return existing.filter(F.col(column).isin(forbidden)).select(column).distinct()


def catalog_tables(spark: SparkSession) -> DataFrame:
    """Names of the session's tables and views; a catalog is small."""
    return spark.createDataFrame([(t.name,) for t in spark.catalog.listTables()], "name string")


def reply_cases(replies: DataFrame) -> DataFrame:
    """Each raw reply with whether it is empty, holds a JSON object, and passes: not empty, and the object's ok is true, not a text."""
    raw = F.coalesce("raw_content", F.lit(""))
    found = replies.withColumn("__found", recover_json(raw))
    ok = F.coalesce(F.from_json("__found.json", "ok boolean")["ok"], F.lit(False))
    empty = F.trim(raw) == ""
    return found.withColumns({"raw_empty": empty, "json_ok": F.col("__found.json").isNotNull(), "status": F.when(~empty & ok, "PASS").otherwise("FAIL")}).drop("__found")


#: Conditions of a regression run, each with what is said when it fails.
PASS_CONDITIONS = (
    ("sandbox_status = 'PASS'", "sandbox_status must be PASS"), ("verifier_status = 'FULL PASS'", "verifier_status must be FULL PASS"), ("response_count > 0", "response_count must be > 0"), ("valid_response_count > 0", "valid_response_count must be > 0"),
    ("invalid_response_count = 0", "invalid_response_count must be 0"), ("empty_raw_response_count = 0", "empty_raw_response_count must be 0"), ("json_parse_error_count = 0", "json_parse_error_count must be 0"), ("out_of_pack_fact_ref_count = 0", "out_of_pack_fact_ref_count must be 0"),
    ("out_of_pack_evidence_ref_count = 0", "out_of_pack_evidence_ref_count must be 0"), ("source_table_mutation_count = 0", "source_table_mutation_count must be 0"), ("forbidden_final_table_count = 0", "forbidden_final_table_count must be 0"), ("not api_key_leak_detected", "api key leak detected in generated or checked artifacts"),
    ("read_only", "read_only must be true"), ("not sqlite_write", "sqlite_write must be false"), ("not chroma_write", "chroma_write must be false"), ("not embedding_call", "embedding_call must be false"), ("not source_mutation", "source_mutation must be false"),
)
MUST_FAIL = ("fake_empty_response", "fake_invalid_json", "fixture_empty_response", "fixture_invalid_json")


def run_errors(runs: DataFrame) -> DataFrame:
    """run_id and error for each pass condition that a run does not meet; blocked runs have none of their own. A null counts as not met."""
    errors = F.array_compact(F.array(*(F.when(~F.coalesce(F.expr(condition), F.lit(False)), F.lit(said)) for condition, said in PASS_CONDITIONS)))
    return runs.filter("status is null or status <> 'BLOCKED'").select("run_id", F.explode(errors).alias("error"))


def case_errors(cases: DataFrame) -> DataFrame:
    """run_id and error for each case that did not end as it must."""
    must_fail = F.col("name").isin(*MUST_FAIL)
    wrong = F.when(must_fail & (F.col("status") != "FAIL"), F.concat("name", F.lit(" must FAIL"))).when(~must_fail & (F.col("status") != "PASS"), F.concat("name", F.lit(" must PASS")))
    return cases.select("run_id", wrong.alias("error")).filter("error is not null")


def run_verdicts(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """run_id, status and the number of errors."""
    n = errors.groupBy("run_id").agg(F.count(F.lit(1)).alias("errors"))
    count = F.coalesce("errors", F.lit(0).cast("long"))
    status = F.when(F.col("status") == "BLOCKED", "BLOCKED").when(count > 0, "FAIL").otherwise("PASS")
    return runs.select("run_id", "status").join(n, "run_id", "left").select("run_id", status.alias("status"), F.when(F.col("status") == "BLOCKED", F.lit(0).cast("long")).otherwise(count).alias("errors"))


def final_status(key: Column, first: Column, second: Column, third: Column, sent: Column, answered: Column) -> Column:
    """The diagnosis over a connection test and two later stages: statuses, whether a request went out and was answered."""
    passes = F.lit(True)
    for s in (first, second, third):
        passes = passes & s.eqNullSafe("PASS")
    blocked = first.eqNullSafe("BLOCKED") | second.eqNullSafe("BLOCKED") | third.eqNullSafe("BLOCKED")
    failed = first.eqNullSafe("FAIL") & F.coalesce(sent, F.lit(False))
    return (
        F.when(key.eqNullSafe("missing"), "API_KEY_MISSING").when(blocked, "REAL_LLM_NOT_CALLED").when(failed & ~F.coalesce(answered, F.lit(False)), "API_ERROR").when(failed, "REAL_LLM_CONNECTED_JSON_FAILED")
        .when(third.eqNullSafe("FAIL"), "REGRESSION_FAILED").when(passes, "FULL_PASS").otherwise("ENGINEERING_PASS_REAL_LLM_BLOCKED")
    )


def scoped_events(events: DataFrame, chapters: list[int] | None = None, chapter_num: int | None = None) -> DataFrame:
    """Events of the sample's chapters, in export order: nulls stand behind everything else."""
    if chapters:
        events = events.filter(F.col("chapter_num").isin(sorted(chapters)))
    if chapter_num is not None:
        events = events.filter(F.col("chapter_num") == chapter_num)
    return events.orderBy("chapter_num", *(F.coalesce(c, F.lit("\uffff")) for c in ("scene_key", "para_id", "sentence_id")), "event_id")
