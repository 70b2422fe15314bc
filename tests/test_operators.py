"""Operators on hand-made rows: edge cases, invariants, damage that checks must find."""

import csv
import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import keywords as K
from corpusloom.functions import terms
from corpusloom.functions import text as X
from corpusloom.operators import chunking as C
from corpusloom.operators import dictionary as D
from corpusloom.operators import events as EV
from corpusloom.operators import evidence as E
from corpusloom.operators import grounding as G
from corpusloom.operators import rules as R
from corpusloom.operators import versioning as V
from corpusloom.sources import files
from corpusloom.streaming import upsert


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize("line, want", [("第12章 开始", True), ("第十二章", True), ("  楔子", True), ("番外 三 x", True), ("第x章", False), ("普通的一行", False), ("", False), ("第1章 " + "长" * 100, False)])
def test_chapter_titles(spark, line, want):
    assert value(spark, X.is_chapter_title(F.lit(line))) is want


def test_markdown_cleaning(spark):
    raw = "---\ntitle: \"a\"\nchar_count: 1\n---\n\n# 第1章 起\n\n  你好,世界!  \n\n\n​x   y \n"
    row = value(spark, X.clean_markdown(F.lit(raw)))
    assert row["cleaned"] == "---\ntitle: \"a\"\nchar_count: 11\n---\n\n# 第1章 起\n\n你好，世界！\n\nx y\n" and row["after_chars"] == 11


@pytest.mark.parametrize("blank", ["\n", " \n", "\t \n", "　\n"])
def test_a_million_blank_lines(spark, blank):
    """Before the heading, inside the body and at its end."""
    n = 1_000_000
    raw = "---\norder: 1\n---\n" + blank * n + "# 第1章 起\nx" + blank * n + "y" + blank * n
    cleaned = spark.createDataFrame([(raw,)], "raw string").select(X.clean_markdown(F.col("raw")).alias("c"), X.h1_title(F.col("raw"), 2 * n).alias("h1"), X.normalize_text(X.strip_front_matter(F.col("raw"))).alias("n"), X.strip(F.col("raw")).alias("s")).first()
    want = "---\norder: 1\n---\n\n# 第1章 起\n\nx\n\ny\n"
    if blank.strip("\t\r\n "):  # an ideographic space is no blank of a line, so the heading isn't the first line with anything on it
        assert cleaned["c"]["cleaned"].count("\n") > n
    else:
        assert cleaned["c"]["cleaned"] == want
    assert cleaned["n"].startswith("# 第1章 起") and cleaned["n"].endswith("y") and cleaned["s"] == raw.strip() and cleaned["h1"] == "第1章 起"


def test_too_many_seed_terms_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(E, "MOST_TERMS", 10)
    seeds = E.seed_table(spark, [{"seed_item_id": f"s{i}", "category": "c", "name": f"name {i % 2}", "keywords": ["shared"]} for i in range(30)])
    with pytest.raises(ValueError, match="at most 10"):
        E.candidates(spark.createDataFrame([("p", "shared", 1, 1, "h")], "para_id string, para_text string, chapter_num long, para_index long, para_hash string"), seeds)


def test_cycles_against_plain_walks(spark):
    """Tails of all lengths, cycles of one to forty nodes, ends outside."""
    import random

    r = random.Random(3)
    for n in (1, 2, 7, 150):
        nxt = {f"n{i}": f"n{r.randrange(n + n // 4 + 1)}" for i in range(n)}
        nxt |= {f"t{i}": f"t{i + 1}" for i in range(70)} | {"t70": "n0"} | {f"c{i}": f"c{(i + 1) % 40}" for i in range(40)} | {"a": "b", "b": "a", "s": "s", "e": "outside"}
        want = {}
        for node in nxt:
            path, at = [node], nxt.get(node)
            while at is not None and at != node and len(path) <= len(nxt):
                path.append(at)
                at = nxt.get(at)
            if at == node:
                want[node] = (min(path), len(path))
        got = EV.cycles(spark.createDataFrame(list(nxt.items()), "node string, target string"))
        assert {x["node"]: (x["cycle_id"], x["cycle_length"]) for x in got.collect()} == want
    assert EV.cycles(spark.createDataFrame([], "node string, target string")).collect() == []


def test_duplicate_conflicts_block(spark):
    rows = [("a", "duplicate_candidate", "b"), ("b", "duplicate_candidate", "a"), ("c", "duplicate_candidate", "r"), ("d", "duplicate_candidate", "x"), ("r", "rejected", None), ("x", "approved_candidate", None), ("t", "duplicate_candidate", "a")]
    current = spark.createDataFrame(rows, "normalized_event_id string, decision string, duplicate_target string")
    conflicts = EV.duplicate_conflicts(current)
    assert sorted(map(tuple, conflicts.collect())) == [("a", "b", "duplicate_cycle", "a", 2), ("b", "a", "duplicate_cycle", "a", 2), ("c", "r", "duplicate_target_rejected", None, None)]
    checked = current.withColumns({"errors": F.lit(""), "contradicts": F.lit(False), "reason": F.lit("x"), "confidence_value": F.lit(0.5), "source_row": F.lit(1), "batch": F.lit("b")})
    reasons = {x["normalized_event_id"]: x["block_reason"] for x in EV.confirm(current.select("normalized_event_id"), checked, conflicts).collect()}
    assert reasons == {"a": "blocked_by_conflict", "b": "blocked_by_conflict", "c": "blocked_by_conflict", "d": "blocked_by_duplicate", "r": "blocked_by_rejected", "x": None, "t": "blocked_by_duplicate"}


def test_import_fields(spark):
    text = "---\ntitle: '第7章 名'\n---\n\r\n##  第8章 名\tx　y\n\n\n\nend  "
    content = X.normalize_text(X.strip_front_matter(F.lit(text)))
    assert value(spark, content) == "##  第8章 名 x y\n\nend"
    assert value(spark, X.h1_title(content)) == "第8章 名 x y"
    assert value(spark, X.chapter_number(X.front_matter_value(F.lit(text), "title"))) == 7


def test_names_and_tokens(spark):
    assert value(spark, X.safe_filename(F.lit(' a<b>: "c"? . '))) == "a_b____c"
    assert value(spark, X.safe_filename(F.lit(" ._ "))) == "untitled"
    assert value(spark, X.estimate_tokens(F.lit("")))== 1
    assert value(spark, X.estimate_tokens(F.lit("一二三"))) == 3
    assert value(spark, K.keyword_set(F.lit("Ab 一二三四五六七八九 x"))) == sorted(["ab", "一二", "二三", "三四", "四五", "五六", "六七", "七八", "八九"])
    assert value(spark, K.split_facts(F.lit("甲。乙；甲\n证据不足。evidence_refs: 丙"))) == ["甲", "乙"]
    assert value(spark, terms.term_starts(F.lit("aaaa a\\Eb a\\E"), terms.checked(["aa", "a\\E", "b", "c", ""]))) == [("a\\E", [5, 10]), ("aa", [0, 2]), ("b", [8])]
    with pytest.raises(ValueError, match="at most"):
        terms.checked(map(str, range(terms.MOST_TERMS + 1)))
    assert value(spark, X.stable_id("p", F.lit("a"), F.lit(None))).startswith("p_")


def paragraphs(*kinds_and_lengths):
    at, out = 0, []
    for i, (kind, n) in enumerate(kinds_and_lengths, 1):
        out.append((i, at, at + n, kind))
        at += n + 1
    return out


def blocks(paras, longest=3000):
    return list(C.block_units([C.Unit(i, i, s, e, kind, "") for i, s, e, kind in paras], longest))


def test_block_packing():
    got = blocks(paragraphs(("body", 900), ("dialogue", 700), ("separator", 3), ("author_note", 50), ("body", 1200), ("body", 3100), ("promo", 10), ("noise", 2)))
    assert [(b.first, b.last, b.kind, b.reason) for b in got] == [
        (1, 2, "normal", "strong_separator_trigger"), (3, 3, "separator", "strong_separator_block"), (4, 4, "author_note", "strong_separator_block"), (5, 5, "normal", "target_max_reached"),
        (6, 6, "normal", "single_long_paragraph"), (7, 7, "promo", "strong_separator_block"), (8, 8, "noise", "strong_separator_block"),
    ]
    assert [b[:2] for b in blocks(paragraphs(("body", 10), ("body", 10), ("body", 10)), 21)] == [(1, 2), (3, 3)]
    assert blocks([]) == []


def segments(lengths, *limits):
    return list(C.segment_ranges([C.Unit(1, i, s, e, "body", "") for i, s, e, _ in paragraphs(*(("body", n) for n in lengths))], *limits))


def test_segment_packing():
    assert segments([200] * 6) == [(1, 4), (5, 6)]
    assert segments([1301, 20]) == [(1, 1), (2, 2)]
    assert segments([399, 700, 200]) == [(1, 2), (3, 3)]
    assert segments([]) == []


def test_segmentation_takes_time_in_proportion(spark):
    def seconds(n, operator):
        one = corpus(spark, "\n".join(f"Line {i} of one text. It has two sentences." if i % 5 else "***" for i in range(n))).coalesce(1)
        best = 1e9
        for _ in range(2):
            began = time.perf_counter()
            operator(one).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - began)
        return best

    for operator in (C.paragraphs, C.sentences, C.blocks, C.segments):
        operator(corpus(spark, "warm up.")).count()
        assert seconds(64_000, operator) < 6 * seconds(16_000, operator) + 0.3


def test_spans_that_cannot_be_cut(spark):
    ch = corpus(spark, "abcdef", None)
    spans = spark.createDataFrame([(1, "a", 0, 3), (1, "b", 4, 9), (1, "c", 3, 3), (1, "d", None, 3), (2, "e", 0, 1), (9, "f", 0, 1), (1, "g", -1, 2), (1, "h", 5, 6)], "chapter_num long, id string, start_offset long, end_offset long")
    assert {r["id"]: (r["has_chapter"], r["cut"]) for r in C.cut_again(spans, ch, "id").collect()} == {"a": (True, "abc"), "b": (True, None), "c": (True, None), "d": (True, None), "e": (True, None), "f": (False, None), "g": (True, None), "h": (True, "f")}


def corpus(spark, *texts):
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    from corpusloom.sources.corpus import chapters

    return chapters(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))


def test_units_cut_their_text_out_again(spark):
    texts = ["One. Two! 😀 Three?\n\n  \nFour.", None, "", "no end", "a.b. c"]
    rows = C.sentences(corpus(spark, *texts)).collect()
    assert [r["sentence_text"] for r in sorted(rows, key=lambda r: (r["chapter_num"], r["global_sentence_index"]))] == ["One.", "Two!", "😀 Three?", "Four.", "no end", "a.b.", "c"]
    assert all(texts[r["chapter_num"] - 1][r["start_offset"] : r["end_offset"]] == r["sentence_text"] for r in rows)


def test_upsert_is_idempotent(spark):
    schema = "chapter_id string, chapter_num long, version_id string, content_hash string"
    first = spark.createDataFrame([("a", 1, "v1", "h1"), ("b", 2, "v2", "h2")], schema)
    empty = spark.createDataFrame([], schema + ", is_current int")
    one = V.upsert(empty, first).drop("action")
    assert {r["action"] for r in V.upsert(one, first).collect()} == {"unchanged"}
    changed = spark.createDataFrame([("a", 1, "v9", "h9")], schema)
    two = V.upsert(one, changed)
    assert sorted((r["chapter_id"], r["version_id"], r["is_current"], r["action"]) for r in two.collect()) == [("a", "v1", 0, "new_version"), ("a", "v9", 1, "new_version"), ("b", "v2", 1, "absent")]
    three = V.upsert(two.drop("action"), first)  # back to an earlier text: one more version, history kept
    assert three.filter("chapter_id = 'a' and is_current = 1").first()["version_id"] == "v1" and three.count() == 4


def test_missing_numbers(spark):
    df = spark.createDataFrame([(n,) for n in (3, 4, 7, 7, 12)], "n long")
    assert sorted(r[0] for r in V.missing_numbers(df, "n", 5).collect()) == [5, 6, 8, 9, 10, 11]
    with pytest.raises(ValueError, match="8"):
        V.scoped(df, "n", [3, 8])


def test_longest_terms_equal_an_alternation(spark):
    """Random dictionaries with shared prefixes, terms inside terms and signs of regular expressions."""
    import random
    import re

    r = random.Random(1)
    for _ in range(3000):
        words = tuple(sorted({"".join(r.choice("ab.(") for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(8))}))
        text = "".join(r.choice("ab.(c") for _ in range(r.randrange(30)))
        pattern = "|".join(map(re.escape, sorted(words, key=lambda w: (-len(w), w))))
        assert terms.longest(text, terms.automaton(words)) == ([(m.start(), m[0]) for m in re.finditer(pattern, text)] if words else [])
    assert [(m["m"], m["s"]) for m in value(spark, terms.matches(F.lit("xabcabbc.c"), ("ab", "abc", "b", "c.")))] == [("abc", 1), ("ab", 4), ("b", 6), ("c.", 7)]


def test_a_large_dictionary_costs_no_more(spark):
    import random

    r = random.Random(2)
    text = "".join(r.choice("abcdefgh ") for _ in range(200_000))
    took = []
    for n in (100, 100_000):
        a = terms.automaton(tuple("z" + "".join(r.choice("abcdefgh") for _ in range(9)) + str(i) for i in range(n)))
        took.append(min(_timed(lambda a=a: terms.longest(text, a)) for _ in range(5)))
    assert took[1] < 3 * took[0] + 0.01


def _timed(f):
    began = time.perf_counter()
    f()
    return time.perf_counter() - began


@pytest.mark.parametrize("text, how, a", [('{"a": 1}', "plain", 1), ('x ```json\n{"a": 2}\n``` y', "fenced", 2), ('so {"a": 3, "b": "}"} end }', "balanced", 3), ("{a", "invalid", None), ('use {x} then {"a": 4}', "balanced", 4), ('{"b": [1, {"a": 5}, {"c": ', "balanced", 5), ('{"b": "see {\\"a\\": 1} or', "invalid", None), ('{"b": "{}', "balanced", None), ("[1, {}]", "balanced", None), (" ", "empty", None), (None, "empty", None)])
def test_json_recovery(spark, text, how, a):
    row = spark.createDataFrame([(text,)], "t string").select(G.recover_json("t").alias("r")).select("r.how", F.get_json_object("r.json", "$.a").cast("int").alias("a")).first()
    assert tuple(row) == (how, a)


def test_broken_objects_take_time_in_proportion():
    for text in ('{"a":' * 200_000, "{" * 500_000, '{"a": {"b": "' * 100_000, "{x} " * 200_000 + '{"a": 1}'):
        began = time.perf_counter()
        got = G.first_object(text)
        assert got == ('{"a": 1}' if text.endswith("1}") else None) and time.perf_counter() - began < 5


def test_spans_without_a_chapter_are_not_gathered(spark):
    chapters = spark.createDataFrame([(1, "abcdef"), (2, "x" * 3)], "chapter_num long, content string")
    lost = spark.range(100_000).select(F.lit(9).cast("long").alias("chapter_num"), F.lit(None).cast("string").alias("k"), F.lit(0).alias("start_offset"), F.lit(2).alias("end_offset"))
    rows = [(1, "a", 0, 2), (1, "a", 0, 2), (1, None, 4, 6), (1, "b", 4, 7), (2, "c", None, 1), (2, "d", 2, 1), (None, "e", 0, 1)]
    spans = spark.createDataFrame(rows, "chapter_num long, k string, start_offset int, end_offset int")
    got = C.cut_again(spans.unionByName(lost), chapters, "k")
    assert got.filter("chapter_num = 9 and k is null and not has_chapter and cut is null").count() == 100_000
    small = sorted(((r["chapter_num"], r["k"], r["has_chapter"], r["cut"]) for r in got.filter("chapter_num is null or chapter_num < 9").collect()), key=repr)
    assert small == sorted([(1, "a", True, "ab"), (1, "a", True, "ab"), (1, None, True, "ef"), (1, "b", True, None), (2, "c", True, None), (2, "d", True, None), (None, "e", False, None)], key=repr)


def test_as_of_of_one_second_is_spread(spark):
    import random

    from corpusloom.plans import layers

    r = random.Random(6)
    one = spark.range(200_000).select(F.col("id").alias("event_id"), F.lit(5_000_000).cast("long").alias("t"))
    sizes = [x["count"] for x in layers.in_ranges(one, "t", "event_id").groupBy("part").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 120_000
    times = [(i, r.choice((None, 1, 2, 3, 5, 9, 400, 10**13)) if i % 3 else r.randrange(50)) for i in range(900)]
    right = [(1000 + i, r.choice((None, *range(0, 60, 7)))) for i in range(60)]
    got = layers.as_of(spark.createDataFrame(times, "event_id long, t long"), spark.createDataFrame(right, "event_id long, t long"))
    before = lambda t: max(((u, i) for i, u in right if u is not None and t is not None and u <= t), default=(0, None))[1]
    assert {x["event_id"]: x["previous_id"] for x in got.collect()} == {i: before(t) for i, t in times}


@pytest.mark.parametrize("role, fallback, allowed, want", [("a", "b", ("a", "b"), "a"), ("x", "b", ("a", "b"), "b"), ("x", "y", ("object", "unknown"), "object"), (None, "b", ("b", "subject"), "b"), ("", None, ("subject", "z"), "subject"), ("x", None, ("q", "p"), "p")])
def test_roles_fall_back(spark, role, fallback, allowed, want):
    assert value(spark, EV.role_or_fallback(F.lit(role).cast("string"), F.lit(fallback).cast("string"), allowed)) == want


def test_subject_rules_in_their_order(spark):
    """Each rule by a hand-made event, and each one's loss against the rules before it."""
    arg = lambda text, role, at=1: (at, "c", text, role)
    rows = [
        ("a", "Then Bob said hello", "said", [arg("Amy", "agent"), arg("Bob", "subject", 2)], None),
        ("b", "Then Bob said hello", "said", [arg("Amy", "character"), arg("Kim", "agent", 2)], None),
        ("c", "Then Bob said hello", "said", [arg("Kim", "mover")], None),
        ("d", "She ran off", "ran", [arg("ran", "unknown")], "Old Mary slept."),
        ("e", "Then Bob said hello", "said", [arg("said", "unknown")], None),
        ("f", "At dawn Bob left Ann", "left", [], None),
        ("g", "The door left open", "left", [], None),
        ("h", "he left", "left", [], "nobody was there"),
        ("i", "老王走进房间 x 开口", "开口", [], None),
        ("j", "x amy b amy left", "left", [arg("amy", "character")], None),
    ]
    schema = "event_id string, sentence_text string, trigger_text string, arguments array<struct<match_start:long,character_id:string,entity_text:string,role:string>>, previous string"
    made = spark.createDataFrame(rows, schema)
    sentences = made.filter("previous is not null").select(F.col("event_id").alias("para_id"), F.lit(0).alias("sentence_index"), F.col("previous").alias("sentence_text"))
    events = made.select(F.col("event_id").alias("para_id"), F.lit(1).alias("sentence_index"), "event_id", "sentence_text", "trigger_text", "arguments", F.array(F.lit("x")).alias("warnings"), F.when(F.col("event_id") == "a", "hash_mismatch").otherwise("ok").alias("backcut_status"), F.lit("s").alias("scene_key"), F.lit(0.5).alias("confidence_score"))
    got = {r["event_id"]: (r["subject_rule"], r["subject_text"], r["recommendation"], r["quality_score"]) for r in EV.enhance(events, sentences).collect()}
    ready = "ready_for_l5_3_candidate"
    assert got == {
        "a": ("existing_subject_candidate", "Bob", "review_candidate", 0.55), "b": ("l5_argument_agent", "Kim", ready, 0.75), "c": ("l5_argument_subject", "Kim", ready, 0.75),
        "d": ("pronoun_back_reference", "Mary", "needs_context", 0.65), "e": ("quoted_speech_speaker_pattern", "Bob", ready, 0.75), "f": ("nearest_character_before_trigger", "Bob", ready, 0.75),
        "g": ("not_found", None, "needs_context", 0.6), "h": ("not_found", None, "needs_context", 0.6), "i": ("quoted_speech_speaker_pattern", "房间", ready, 0.75), "j": ("nearest_character_before_trigger", "amy", ready, 0.75),
    }


def test_rule_checks(spark):
    rules = spark.createDataFrame([("a_b", 0.1, 0.0, 1.0), ("x_penalty", 0.1, 0.5, 0.2)], "rule_id string, delta double, floor double, ceiling double")
    assert sorted(map(tuple, R.bound_violations(rules).collect())) == [("bounds_invalid", "x_penalty"), ("penalty_not_negative", "x_penalty")]
    assert R.canonical_checksum({"b": 1, "seed_checksum": "z"}) == R.canonical_checksum({"seed_checksum": "", "b": 1})


def test_fingerprint_finds_tampering(spark):
    df = spark.range(100).withColumn("t", F.col("id").cast("string"))
    before = R.fingerprint(df).first()
    assert R.fingerprint(df.repartition(7)).first() == before
    assert R.fingerprint(df.withColumn("t", F.when(F.col("id") == 5, "x").otherwise(F.col("t")))).first() != before


def test_files(spark, tmp_path):
    (tmp_path / "a.md").write_bytes("﻿你好\r\nx".encode())
    (tmp_path / "b.txt").write_bytes("界域".encode("gb18030"))
    (tmp_path / "c.bin").write_bytes(b"no")
    rows = {r["filename"]: r for r in files.read_texts(spark, str(tmp_path)).collect()}
    assert rows["a.md"]["text"] == "你好\nx" and rows["b.txt"]["text"] == "界域" and rows["b.txt"]["encoding"] == "gb18030" and len(rows) == 2
    (tmp_path / "d.txt").write_bytes(b"\xff\xff\xff")
    with pytest.raises(Exception, match="none of"):
        files.read_texts(spark, str(tmp_path)).collect()


def test_seeds_and_reports(spark):
    seed = {"a": [{"name": "x", "sub": {"name": "y", "n": 1}}], "b": {"k": 2}}
    assert [r["item_path"] for r in files.seed_frame(spark, seed, ("name",)).collect()] == ["$.a[0]", "$.a[0].sub"]
    text = files.markdown_report("T", {"n": 1}, spark.createDataFrame([("a|b",)], "c string"))
    assert "- n: 1" in text and "a\\|b" in text


def test_review_workbook_round_trip(spark, tmp_path):
    path = str(tmp_path / "r")
    files.write_review(spark.createDataFrame([(1, 'say "hi", ok', ["a"])], "id long, note string, tags array<string>"), path)
    assert tuple(files.read_review(spark, path, "id long, note string, tags string").first()) == (1, 'say "hi", ok', '["a"]')
    with pytest.raises(Exception):
        files.read_review(spark, path, "id long, other string, tags string").collect()


def test_scope_is_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "s")
    files.replace_scope(spark.createDataFrame([(1, "a"), (2, "b")], "chapter_num long, t string"), path, "chapter_num")
    files.replace_scope(spark.createDataFrame([(2, "c")], "chapter_num long, t string"), path, "chapter_num")
    assert sorted(map(tuple, spark.read.parquet(path).select("chapter_num", "t").collect())) == [(1, "a"), (2, "c")]
    spark.range(1).createOrReplaceTempView("v_some")
    assert files.first_compatible(spark, ["v_none", "v_some"], {"id"}) is not None and files.missing_sources(spark, ["v_none", "v_some"]) == ["v_none"]


def test_streamed_upserts(spark, tmp_path):
    schema = "chapter_id string, chapter_num long, version_id string, content_hash string, source_order long"
    inbox, state = str(tmp_path / "in"), str(tmp_path / "state")
    for rows in ([("a", 1, "v1", "h1", 1), ("a", 1, "v0", "h0", 0)], [("a", 1, "v2", "h2", 2), ("b", 2, "w", "k", 3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        upsert.apply_batches(spark.readStream.schema(schema).parquet(inbox), state, str(tmp_path / "cp")).awaitTermination()
    versions = lambda: sorted((r["chapter_id"], r["version_id"], r["is_current"]) for r in upsert.state(spark, state).collect())
    assert versions() == [("a", "v1", 0), ("a", "v2", 1), ("b", "w", 1)]
    # a batch adds only the rows it changes, and a new checkpoint goes on with the state
    spark.createDataFrame([("c", 3, "x", "z", 4), ("b", 2, "w", "k", 5)], schema).coalesce(1).write.mode("append").parquet(inbox)
    upsert.apply_batches(spark.readStream.schema(schema).parquet(inbox), state, str(tmp_path / "cp")).awaitTermination()
    assert [r["chapter_id"] for r in spark.read.parquet(f"{state}/run=1/batch=2").collect()] == ["c"]
    later = str(tmp_path / "later")
    spark.createDataFrame([("a", 1, "v3", "h3", 6), ("d", 4, "y", "q", 7)], schema).coalesce(1).write.parquet(later)
    upsert.apply_batches(spark.readStream.schema(schema).parquet(later), state, str(tmp_path / "cp2")).awaitTermination()
    assert versions() == [("a", "v1", 0), ("a", "v2", 0), ("a", "v3", 1), ("b", "w", 1), ("c", "x", 1), ("d", "y", 1)]
    assert spark.read.parquet(f"{state}/run=2/batch=0").count() == 3


def test_log_is_folded_and_batches_read_no_more(spark, tmp_path):
    """Many batches over few keys: later ones read no more files, old parts go, and killed or repeated batches change nothing."""
    schema = "chapter_id string, chapter_num long, version_id string, content_hash string, source_order long"
    inbox, log = str(tmp_path / "in"), str(tmp_path / "log")
    for n in range(14):
        spark.createDataFrame([("a", 1, f"v{n}", f"h{n}", n), (f"c{n % 3}", 2, f"w{n // 6}", f"k{n // 6}", n)], schema).coalesce(1).write.mode("append").parquet(inbox)
        upsert.apply_batches(spark.readStream.schema(schema).parquet(inbox), log, str(tmp_path / "cp"), fold_every=4).awaitTermination()
    versions = lambda: sorted((r["chapter_id"], r["version_id"], r["is_current"]) for r in upsert.state(spark, log).collect())
    want = sorted([("a", f"v{n}", int(n == 13)) for n in range(14)] + [(f"c{k}", f"w{w}", int(w == 2 if k < 2 else w == 1)) for k in range(3) for w in range(3 if k < 2 else 2)])
    assert versions() == want
    a = spark.createDataFrame([("a",)], "chapter_id string").select(upsert.bucket_of("chapter_id")).first()[0]
    read = [upsert.earlier_rows(spark, log, (1, n), [a]).select(F.input_file_name()).distinct().count() for n in (10, 11, 12, 13, 14)]
    assert max(read) <= 6 and upsert._marked(spark, log) == [(1, 3), (1, 7), (1, 11)]
    assert upsert._parts(spark, log) and min(upsert._parts(spark, log)) == (1, 8) and sorted(upsert._parts(spark, f"{log}-base")) == [(1, 7), (1, 11)]
    # a base that was cut short has no mark and is written anew; a folded batch that is repeated gives the same
    spark.createDataFrame([("z", 0)], "chapter_id string, bucket int").write.partitionBy("bucket").parquet(f"{log}-base/run=1/batch=13")
    assert versions() == want
    upsert.compact(spark, log, (1, 14), "chapter_id")
    upsert.compact(spark, log, (1, 14), "chapter_id")
    assert versions() == want


def test_reader_filters_nest_and_drop_emptied_seeds(spark):
    accepted = spark.createDataFrame([("a", "e2", 900), ("a", "e1", 3), ("b", "e3", 900), ("c", "e4", 7)], "seed_item_id string, evidence_id string, chapter_num long")
    seeds = [("a", "covered", "f1", "rule", "trusted"), ("b", "covered", "f1", "item", "trusted"), ("c", "covered", "f2", "rule", "partial"), ("d", "uncovered", "f1", "rule", "trusted")]
    lock = spark.createDataFrame(seeds, "seed_item_id string, coverage_status string, seed_file string, seed_rule_type string, trusted_status string")
    rows = E.reader_rows(accepted, lock)

    def read(**filters):
        got = E.filter_reader_rows(rows, **filters).collect()
        assert all(r["accepted_evidence_count"] == len(r["evidence_refs"]) for r in got)
        return {r["seed_item_id"]: [e["evidence_id"] for e in r["evidence_refs"]] for r in got}

    assert read() == {"a": ["e1", "e2"], "b": ["e3"], "c": ["e4"]}
    assert read(chapter_num=900) == {"a": ["e2"], "b": ["e3"]}
    assert read(chapter_num=3, seed_file="f1") == {"a": ["e1"]}
    assert read(seed_item_id="b", chapter_num=3) == {}
    assert read(seed_rule_type="rule", trusted_status="partial") == {"c": ["e4"]}
    with pytest.raises(Exception, match="coverage lock misses seed c"):
        E.reader_rows(accepted, lock.filter("seed_item_id <> 'c'")).collect()


def test_chapter_sink(spark, tmp_path):
    rows = [(1, "c1", 'the "first", one', "chapter_0001.md", "# one\n\ntext", 4), (2, "c2", "two", "chapter_0002.md", None, 0)]
    files.write_chapters(spark.createDataFrame(rows, "chapter_order long, chapter_id string, title string, filename string, markdown string, char_count long"), str(tmp_path))
    (index,) = (tmp_path / "index").glob("*.csv")
    assert index.read_bytes().startswith(b"\xef\xbb\xbfchapter_order,")
    lines = list(csv.DictReader(index.read_text("utf-8-sig").splitlines()))
    assert [(r["title"], r["md5"]) for r in lines] == [('the "first", one', hashlib.md5(b"# one\n\ntext").hexdigest()), ("two", hashlib.md5(b"").hexdigest())]
    assert {p.name: p.read_text() for p in (tmp_path / "chapters").glob("*.md")} == {"chapter_0001.md": "# one\n\ntext", "chapter_0002.md": ""}
    assert files.write_texts(spark.createDataFrame([("a.txt", "é")], "filename string, text string"), f"file:{tmp_path}/more", encoding="latin-1") == 1
    assert (tmp_path / "more" / "a.txt").read_bytes() == b"\xe9"
    with pytest.raises(Exception, match="no file name"):
        files.write_texts(spark.createDataFrame([("a/b", "x")], "filename string, text string"), str(tmp_path / "bad"))


def test_appended_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    files.append_rows(spark.createDataFrame([(1, "a")], "id long, t string"), path)
    files.append_rows(spark.createDataFrame([("b",)], "t string"), path)
    assert sorted(map(repr, (tuple(r) for r in spark.read.parquet(path).collect()))) == ["(1, 'a')", "(None, 'b')"]
    with pytest.raises(ValueError, match="other"):
        files.append_rows(spark.createDataFrame([(1, 2)], "id long, other long"), path)


def test_vector_store(spark, tmp_path):
    path, schema = str(tmp_path / "v"), "id string, document string, embedding array<double>"
    make = lambda *rows: spark.createDataFrame([(i, d, [float(x)]) for i, d, x in rows], schema)
    stored = lambda: {r["id"]: (r["document"], r["embedding"]) for r in spark.read.parquet(path).collect()}
    files.upsert_vectors(make(*((f"i{k}", "d", k) for k in range(40))), path, buckets=8)
    files.upsert_vectors(make(("i3", "new", 9), ("i99", "e", 1), ("i99", "f", 2)), path, buckets=8)
    assert len(stored()) == 41 and stored()["i3"] == ("new", [9.0]) and stored()["i99"] == ("f", [2.0]) and stored()["i4"] == ("d", [4.0])
    with pytest.raises(Exception, match="without an id"):
        files.upsert_vectors(make((None, "x", 1)), path, buckets=8)
    with pytest.raises(ValueError, match="store has columns"):
        files.upsert_vectors(make(("a", "x", 1)).drop("document"), path, buckets=8)
    files.upsert_vectors(make(("z", "only", 1)), path, rebuild=True, buckets=8)
    assert stored() == {"z": ("only", [1.0])}


def test_results_and_layer_report(spark, tmp_path):
    rows = spark.createDataFrame([(1, ["a", "b"], 'x "y"'), (2, [], None)], "id long, refs array<string>, note string")
    files.write_layer_report(rows, str(tmp_path), "Layer", {"warnings": 2})
    back = spark.read.json(str(tmp_path / "json"))
    assert {r["id"]: r["refs"] for r in back.collect()} == {1: ["a", "b"], 2: []}
    flat = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert {r["id"]: (r["refs"], r["note"]) for r in flat.collect()} == {"1": ('["a","b"]', 'x "y"'), "2": ("[]", None)}
    manifest = json.loads(spark.read.text(str(tmp_path / "manifest")).first()[0])
    assert manifest["rows"] == 2 and manifest["metrics"] == {"warnings": 2} and manifest["columns"] == rows.columns
    assert "- warnings: 2" in [r[0] for r in spark.read.text(str(tmp_path / "markdown")).collect()]


def test_model_embeddings(spark, tmp_path, monkeypatch):
    from corpusloom.operators.retrieval import model_embedding

    with pytest.raises(ImportError, match="hash_embedding needs none"):
        model_embedding(F.col("t"), "m")
    stand_in = tmp_path / "sentence_transformers.py"
    stand_in.write_text(
        "import numpy as np\n\n\nclass SentenceTransformer:\n    def __init__(self, name):\n        self.name = name\n\n"
        "    def encode(self, texts, normalize_embeddings):\n        v = np.array([[len(t), len(self.name)] for t in texts], float)\n        return v / np.linalg.norm(v, axis=1, keepdims=True)\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(stand_in))
    rows = spark.createDataFrame([("abcd",), (None,)], "t string").select(model_embedding(F.col("t"), "abc").alias("v")).collect()
    assert [[round(x, 4) for x in r["v"]] for r in rows] == [[0.8, 0.6], [0.0, 1.0]]


def test_orders_and_gaps_stay_small(spark, monkeypatch):
    from corpusloom.operators import events

    monkeypatch.setattr(events, "PARTS", 3)
    rows = spark.range(200).select((F.col("id") * 7 % 23).alias("part"), F.col("id"))
    got = {r["id"]: r["position"] for r in events.global_positions(rows, F.col("part"), "id").collect()}
    assert got == {i: n for n, (_, i) in enumerate(sorted((i * 7 % 23, i) for i in range(200)), 1)}
    gaps = spark.createDataFrame([(-5,), (3,), (40,), (41,)], "n long")
    assert sorted(r["n"] for r in V.missing_numbers(gaps, "n", 8).collect()) == [x for x in range(-5, 42) if x not in (-5, 3, 40, 41)]


def test_stage_tables_need_a_shared_folder(spark, monkeypatch):
    from corpusloom.sources import staging

    class Elsewhere:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_root(Elsewhere)
    with staging.scratch("kept"):
        gone, kept = (staging.materialize(spark.range(3).toDF("id"), name) for name in ("gone", "kept"))
    assert kept.count() == 3 and not files.exists(spark, gone._stage_path)
    staging.release(kept)
    assert not files.exists(spark, kept._stage_path)


def test_read_only_statements(spark):
    from corpusloom.sources import guard

    spark.range(3).createOrReplaceTempView("corpusloom_three")
    assert guard.read_only(spark, "SELECT sum(id) AS n FROM corpusloom_three").first()["n"] == 3
    with pytest.raises(PermissionError, match="only queries"):
        guard.read_only(spark, "DROP VIEW corpusloom_three")
    assert spark.table("corpusloom_three").count() == 3


def test_rows_of_one_term_stay_where_they_are(spark):
    near = spark.range(400).select((F.col("id") + 1).alias("chapter_num"), F.lit("c").alias("chapter_id"), F.lit("v").alias("version_id"), F.lit("p").alias("para_id"), F.col("id").cast("string").alias("sentence_id"), F.lit(0).cast("long").alias("start_offset"), F.lit("Heit said").alias("sentence_text")).repartition(4, "chapter_num")
    spread = lambda df: df.select(F.spark_partition_id().alias("part")).distinct().count()
    aliases = D.alias_table(spark, [("a", "Heit", None, None)])
    patterns = spark.createDataFrame([("a", "Heit", [])], "owner_id string, pattern string, negatives array<string>")
    assert [spread(df) for df in (D.appearances(near, aliases), D.alias_occurrences(near, aliases), D.pattern_spans(near, patterns))] == [4] * 3
    plan = EV.triggers(near, EV.rule_table(spark, [("r", "speech", "speak", ["said"], [], "high", None)]))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(term" not in plan and "hashpartitioning(__term" not in plan


def test_events_meet_their_context_where_they_are(spark, tiny):
    """One pass over a chapter finds what the joins of stored layers find, and neither writes nor moves anything."""
    from corpusloom.plans import registry
    from corpusloom.sources import staging
    from corpusloom.sources.corpus import chapters

    texts = [
        "Amy met Bob. He said so and said no. It ended\nnext Bob said",
        "Bob said. Bob said. never Bob said",
        "- - -\n" + "long " * 30 + "said. Amy sat\n" + "Amy " * 40,
        "Amy said it. Bobby and Amy went",
        "",
        None,
    ]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    rows = chapters(docs)
    rules = EV.rule_table(spark, [("low", "speech", "speak", ["said", "so"], ["never"], "high", None), ("first", "speech", "tell", ["said", "said so"], ["ended"], "low", ("a", "b", "c")), ("second", "speech", "ask", ["said", "Bob said"], [], "low", None)])
    aliases = D.alias_table(spark, [("a", "Amy", None, None), ("b", "Bob", 1, 2), ("c", "Bob", 2, None), ("b", "Bobby", None, None), ("b", "Bob", 2, 3)])
    got = EV.in_context(rows, rules, aliases, 60)
    assert not any(x in got._jdf.queryExecution().executedPlan().toString() for x in ("hashpartitioning", "Join"))
    sentences = C.sentences(rows)
    events = EV.triggers(sentences, rules).filter("kept")
    same = ["event_id", "rule_id", "trigger_text", "chapter_num", "sentence_id", "para_id", "sentence_hash", "sentence_text", "state_type", "confidence", "trigger_start", "trigger_end", "start_offset", "end_offset"]
    assert sorted(map(repr, got.select(same).collect())) == sorted(map(repr, events.select(same).collect())) and got.count() > 10
    names = got.select("event_id", F.explode("names").alias("n")).select("event_id", "n.character_id", "n.entity_text", "n.scope", "n.match_start")
    args = EV.arguments(events, D.appearances(sentences, aliases)).filter("role = 'character'").select(names.columns)
    assert sorted(map(repr, names.collect())) == sorted(map(repr, args.collect())) and {r["scope"] for r in names.collect()} == {"same_sentence", "same_paragraph"}
    scenes = EV.enclosing_scene(events, C.blocks(rows, 60))
    assert sorted(map(repr, got.select(scenes.columns).collect())) == sorted(map(repr, scenes.collect()))
    near = {(r["para_id"], r["sentence_index"]): r["sentence_text"] for r in sentences.collect()}
    assert all(r["previous"] == near.get((r["para_id"], r["sentence_index"] - 1)) and r["cut"] == r["sentence_text"] for r in got.collect())
    assert sorted(r["same_evidence"] for r in got.filter("chapter_num = 2").collect()) == sorted(r["count"] for r in events.filter("chapter_num = 2").groupBy("sentence_hash").count().collect() for _ in range(r["count"]))

    before = set(staging._written)
    review = registry.queries()["a09_enhancement_metrics"](spark, tiny)
    assert set(staging._written) == before and "hashpartitioning" not in review._jdf.queryExecution().executedPlan().toString()
