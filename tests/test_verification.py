"""Checks of stored layers on hand-made rows: nulls, blanks, ties and what must be an error."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import registry
from corpusloom.operators import chunking as C
from corpusloom.operators import verification as V
from corpusloom.sources.corpus import chapters


@pytest.fixture(scope="module")
def corpus(spark):
    return chapters(spark.createDataFrame([(0, "One. Two.\nThree.", "en", "s"), (1, None, "en", "s")], "doc_id long, text string, lang string, source string"))


def test_backcut_of_incomplete_evidence(spark, corpus):
    chapter, version, content = corpus.filter("chapter_num = 1").select("chapter_id", "version_id", "content").first()
    sentence = C.sentences(corpus).filter("sentence_index = 1 and para_index = 1").first()["sentence_id"]
    digest = hashlib.sha256(content[:4].encode()).hexdigest()
    rows = [
        ("ok", chapter, version, sentence, None, "0", "4", digest), ("blank_hash", chapter, version, "", "", "0", "4", ""), ("no_start", chapter, version, sentence, None, None, "4", digest), ("no_chapter", None, version, sentence, None, "0", "4", digest),
        ("gone", chapter, version, "x", None, "0", "4", digest), ("other_version", chapter, "v", None, None, "0", "4", digest), ("crossed", chapter, version, sentence, None, "4", "4", digest), ("text", chapter, version, sentence, None, "a", "4", digest), ("negative", chapter, version, sentence, None, "-1", "4", digest),
        ("wrong", chapter, version, sentence, None, "1", "4", digest), ("long", chapter, version, None, None, "0", "999", None),
    ]
    evidence = spark.createDataFrame(rows, "evidence_id string, chapter_id string, version_id string, sentence_id string, para_id string, start_offset string, end_offset string, evidence_hash string")
    paragraphs = C.paragraphs(corpus).withColumn("para_id", C.paragraph_id("chapter_id", "para_index"))
    got = {r["evidence_id"]: (r["status"], r["evidence_text"]) for r in V.backcut_status(evidence, C.sentences(corpus), paragraphs, corpus).collect()}
    assert got == {
        "ok": ("ok", "One."), "blank_hash": ("ok", "One."), "no_start": ("missing_coordinate", None), "no_chapter": ("missing_coordinate", None), "gone": ("missing_l2_source", None), "other_version": ("missing_l2_source", None),
        "crossed": ("offset_invalid", None), "text": ("offset_invalid", None), "negative": ("offset_invalid", None), "wrong": ("hash_mismatch", "ne."), "long": ("offset_invalid", None),
    }
    assert V.backcut_status(evidence.filter("false"), C.sentences(corpus), paragraphs, corpus).count() == 0


def test_intact_segments_break_no_rule(spark, corpus):
    from corpusloom.plans.checks import stored_segments

    segments, links = stored_segments(C.segments(corpus, 1200, 2, 5, 8))
    assert segments.count() > 1
    args = C.blocks(corpus, 1200), C.sentences(corpus), corpus
    assert V.segment_violations(segments, links, *args).count() == 0
    lost = links.withColumn("sentence_id", F.lit(None).cast("string"))
    codes = {r["code"] for r in V.segment_violations(segments, lost, *args).collect()}
    assert codes == {"sentence_untraced"}
    assert {r["code"] for r in V.segment_violations(segments, links.filter("false"), *args).collect()} == {"link_count", "no_links"}


def test_packet_entries_check_their_status(spark):
    schema = "seed_item_id string, candidate_id string, paragraph_id string, chapter_id string, paragraph_hash string, evidence_text string, paragraph_text string, human_status string, human_note string, review_note string"
    rows = [("s", "", "", None, None, "", None, None, None, None), ("s", None, "p", "c", "h", "e", "t", "accepted", None, "own"), ("s", "id", "p", "c", "h", None, "t", "rejected", "n", "own")]
    reviews = spark.createDataFrame([("id", "needs_more", None, "r")], "review_key string, human_status string, human_note string, review_note string")
    candidates = spark.createDataFrame(rows, schema)
    got = {r["entry_id"]: (r["entry_status"], r["entry_note"], r["entry_text"]) for r in V.packet_entries(candidates, reviews).collect()}
    assert got == {"s:unknown_chapter:unknown_hash": (None, "", ""), "s:p": ("accepted", "own", "e"), "id": ("needs_more", "r", "t")}
    with pytest.raises(Exception, match="invalid human_status of id"):
        V.packet_entries(candidates, reviews.withColumn("human_status", F.lit("perhaps"))).collect()


def test_workbooks(spark):
    rows = spark.createDataFrame([("a", None), ("", '["x"]'), ("z", "{"), (None, '["y", "y"]')], "kind string, warning_flags_json string")
    found = sorted(map(tuple, V.workbook_findings(rows, ["kind", "other"], {"kind": ["a"], "absent": ["q"]}, ["x"]).collect()))
    assert found == [("invalid_flag_rows", "1"), ("missing_field", "other"), ("unknown_flag", "y"), ("unknown_kind", "z")]
    assert V.workbook_findings(rows.filter("false"), ["kind"], {"kind": []}, []).count() == 0


def test_runs_and_replies(spark):
    replies = spark.createDataFrame([(1, "fake_ok", None), (1, "fake_invalid_json", "[1]"), (2, "fake_ok", 'x {"ok": true} y'), (2, "fixture_empty_response", '{"ok": true}')], "run_id long, name string, raw_content string")
    cases = V.reply_cases(replies)
    assert {(r["run_id"], r["name"]): r["status"] for r in cases.collect()} == {(1, "fake_ok"): "FAIL", (1, "fake_invalid_json"): "FAIL", (2, "fake_ok"): "PASS", (2, "fixture_empty_response"): "PASS"}
    errors = V.case_errors(cases)
    assert sorted(r["error"] for r in errors.collect()) == ["fake_ok must PASS", "fixture_empty_response must FAIL"]
    runs = spark.createDataFrame([(1, "FAIL"), (3, "BLOCKED"), (4, None)], "run_id long, status string")
    assert {r["run_id"]: (r["status"], r["errors"]) for r in V.run_verdicts(runs, errors).collect()} == {1: ("FAIL", 1), 3: ("BLOCKED", 0), 4: ("PASS", 0)}


def test_segment_rules_move_few_bytes(spark, tiny):
    """Links and segments once carried texts, hexadecimal hashes and three copies of a row through every join."""
    written = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    size = spark.read.parquet(f"{tiny}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    before, key = written(), "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        registry.queries()["m15_segment_rules"](spark, tiny).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset(key)
    assert written() - before < 10 * size
