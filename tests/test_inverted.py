"""The inverted index against plain counting: skipping, phrases, changes by version."""

import math
import random

from pyspark.sql import functions as F

from corpusloom.operators import inverted as I


def plain(rows, phrase, k):
    """The k best (id, score) of a phrase; rows: {id: tokens}."""
    mean, hits = sum(map(len, rows.values())) / len(rows), []
    for i, tokens in rows.items():
        n = at = 0
        while at + len(phrase) <= len(tokens):
            if tokens[at : at + len(phrase)] == phrase:
                n, at = n + 1, at + len(phrase)
            else:
                at += 1
        if n:
            hits.append((i, n, len(tokens)))
    rarity = max(math.log((len(rows) - len(hits) + 0.5) / (len(hits) + 0.5)), 1e-6) if hits else 0
    scored = [(i, round(1 / (1 + abs(rarity * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * size / mean)))), 6)) for i, n, size in hits]
    return sorted(scored, key=lambda x: (-x[1], x[0]))[:k]


def corpus(seed, n):
    r = random.Random(seed)
    return {i * 37: [r.choice("abcdefgh") if r.random() < 0.7 else f"w{r.randrange(200)}" for _ in range(r.choice((1, 2, 3, 5, 9, 17, 40)))] for i in range(n)}


def frame(spark, rows, version=1):
    return spark.createDataFrame([(i, version, t) for i, t in rows.items()], "id long, version int, tokens array<string>")


def results(spark, index, rows, phrases, k):
    queries = spark.createDataFrame([(f"q{n}", p) for n, p in enumerate(phrases)], "query_id string, tokens array<string>")
    hits, read = I.search(index, queries, k, len(rows), sum(map(len, rows.values())) / len(rows))
    got = {f"q{n}": [] for n in range(len(phrases))}
    for h in sorted(hits.collect(), key=lambda h: h["place"]):
        got[h["query_id"]].append((h["id"], h["score"]))
    return list(got.values()), read


PHRASES = [["a"], ["b"], ["w3"], ["a", "b"], ["a", "a"], ["c", "d", "e"], ["nowhere"], ["a", "nowhere"], ["h", "h", "h"]]


def test_search_equals_plain_and_skips_blocks(spark):
    rows = corpus(1, 3000)
    index = I.build(frame(spark, rows))
    for k in (1, 7):
        got, read = results(spark, index, rows, PHRASES, k)
        assert got == [plain(rows, p, k) for p in PHRASES]
        counts = {r["query_id"]: r["count"] for r in read.groupBy("query_id").count().collect()}
        every = index.filter("term = 'a'").count()
        assert every > 60 and counts["q0"] < every / 3
    assert index.agg(F.max("n")).first()[0] <= I.RANGE


def test_changes_by_version_rewrite_only_what_they_meet(spark):
    rows = corpus(2, 1500)
    index = I.build(frame(spark, rows))
    r = random.Random(5)
    gone, new = r.sample(sorted(rows), 20), {i: ["a", "fresh", "b"] for i in r.sample(sorted(rows), 5)}
    removed = spark.createDataFrame([(i, 1) for i in {*gone, *new}] + [(1, 1), (37, 9)], "id long, version int")  # no such row, no such version
    after = {i: t for i, t in rows.items() if i not in gone and i not in new} | new | {10**9: ["a", "late"]}
    changed, written = I.changed(index, removed, frame(spark, {**new, 10**9: ["a", "late"]}, 2))
    got, _ = results(spark, changed, after, [*PHRASES, ["fresh"], ["late"]], 9)
    assert got == [plain(after, p, 9) for p in [*PHRASES, ["fresh"], ["late"]]]
    assert written.count() < index.count() / 2
    main = frame(spark, {i: t for i, t in after.items() if i not in new and i != 10**9}).unionByName(frame(spark, {**new, 10**9: ["a", "late"]}, 2))
    assert I.differences(changed, main).first().asDict() == {"main_rows": len(after), "index_rows": len(after), "missing": 0, "orphans": 0, "damaged": 0}
    stale = I.differences(index, main).first()
    assert stale["missing"] == len(new) + 1 and stale["orphans"] == len({*gone, *new})


def test_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, 1, ["a"]), (1, 1, None), (2, 1, []), (3, None, ["a", "b"])], "id long, version int, tokens array<string>")
    index = I.build(rows)
    assert [r["term"] for r in index.orderBy("term").collect()] == ["a", "b"]
    empty = I.build(rows.limit(0))
    queries = spark.createDataFrame([("q", ["a"])], "query_id string, tokens array<string>")
    assert I.search(empty, queries, 3, 0, 1.0)[0].collect() == []
