"""Operators over a whole corpus against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import mixing, packing, queries, simhash, toxicity, vptree
from corpusloom.llm.components import star_components
from corpusloom.llm.mixing import MIXING_SQL, mix_sources, mixed_documents, source_targets
from corpusloom.llm.packing import Encoder, best_fit_decreasing, pack_documents
from corpusloom.llm.passages import GatedAttention, quality_scores
from corpusloom.llm.quality_rules import QUALITY_SQL
from corpusloom.llm.simhash import fingerprint, near_duplicates
from corpusloom.llm.toxicity import Grammar, toxicity_scores
from corpusloom.llm.warc import read_archive, warc_bytes, write_archive
from tests.oracle import assert_same, connect

ENCODER = Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """prints: {id: fingerprint}; the least id reachable over at most three differing bits."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: root(i) for i in ids}


def test_near_duplicates(spark, tiny):
    docs = queries.table(spark, tiny, "documents")
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    want = brute_components(prints)
    got = near_duplicates(docs, shard_rows=30, sample_rows=60).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in got} == {i: (prints[i], want[i]) for i in prints}


def test_near_duplicates_edges(documents, no_documents):
    assert near_duplicates(no_documents).count() == 0
    rows = near_duplicates(documents).collect()
    assert len(rows) == documents.count()
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["fingerprint"] == "0" * 16 and by[i]["component_id"] == 0 for i in (0, 1, 2))
    assert by[7]["component_id"] == by[6]["component_id"] == 6
    assert all(len(r["fingerprint"]) == 16 for r in rows)


def test_long_text_fingerprint_in_blocks():
    r = random.Random(1)
    text = " ".join(r.choice("abcdefgh") * 3 for _ in range(40_000))
    assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("leaf", [8, 64])
def test_trees_find_every_pair(leaf):
    r = np.random.default_rng(leaf)
    base = r.integers(0, 2**63, 600).astype(np.uint64)
    near = base[:200].copy()
    for _ in range(3):
        near ^= np.uint64(1) << r.integers(0, 64, 200).astype(np.uint64)
    ball = base[0] ^ np.array([(1 << i) ^ (1 << j) for i in range(12) for j in range(i)], np.uint64)
    prints = np.unique(np.concatenate([base, near, ball, base[3] ^ (np.arange(200).astype(np.uint64) << np.uint64(33))]))
    want = brute_components(dict(enumerate(map(int, prints))))
    labels = vptree.Labels(len(prints))
    for side in (0, 1):
        tree = vptree.grow(vptree.take(r.permutation(prints)[:150], side), 30)
        assert tree
        for _, rows, guest in vptree.route(prints, side, tree):
            labels.link(rows, rows[vptree.components(prints[rows], guest, side, leaf)])
    assert labels.roots(np.arange(len(prints))).tolist() == [want[i] for i in range(len(prints))]


def test_a_shared_half_is_split_by_the_other(spark):
    r = np.random.default_rng(12)
    left = int(r.integers(0, 1 << 32)) << 32
    same = np.array([left | int(x) for x in r.integers(0, 1 << 32, 2500)], np.uint64)  # one left half for all
    same = np.concatenate([same, same[:300] ^ np.uint64(0b10100000000000001), same[300:400] ^ np.uint64(1 << 40)])
    prints = np.unique(np.concatenate([same, r.integers(0, 1 << 63, 1500).astype(np.uint64), np.uint64(0xABCDEF01) + (r.integers(0, 1 << 31, 800).astype(np.uint64) << np.uint64(32))]))
    rows = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    sizes = [x["count"] for x in simhash.shards(rows, len(prints), 40, 300).groupBy("part", "shard").count().collect()]
    assert len(sizes) > 30 and max(sizes) <= 8 * 40
    got = dict(star_components(simhash.fingerprint_links(rows, len(prints), 40, 300)).collect())
    labels = vptree.Labels(len(prints))
    vptree.compare(prints, np.arange(len(prints)), np.zeros(len(prints), bool), labels)
    group, values = labels.roots(np.arange(len(prints))), prints.view(np.int64)
    least = {g: int(values[group == g].min()) for g in set(group.tolist())}
    assert {int(v): least[g] for v, g in zip(values, group.tolist(), strict=True) if least[g] != v} == got and len(got) > 350


def test_near_duplicates_of_one_id_with_two_texts(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in ("apple", "bread"))
    rows = near_duplicates(spark.createDataFrame([(4, a), (4, b), (2, b), (None, a), (None, "lone")], "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in rows) == [("2", "2"), ("4", "2"), ("4", "4"), ("None", "4"), ("None", "None")]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 3)]
    got = dict(star_components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}


def parse_record(record):
    """A reader of its own: the named fields and the block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    assert version == "WARC/1.1" and rest[int(fields["Content-Length"]) :] == b"\r\n\r\n"
    return fields, rest[: int(fields["Content-Length"])]


def test_archive_of_odd_ids(spark):
    html = "same " * 40
    rows = [(None, None, html), (None, None, html), (None, "", html), ("b\r\nX: 1", "u\nv", html), ("a ü%", "u", html), ("", "w", "short"), ("z", "w", None)]
    records = read_archive(spark, write_archive(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id string, url string, html string, header string, payload string, row string"))).collect()
    assert sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in records) == sorted(
        [("None", "revisit", "a ü%")] * 3 + [("b\r\nX: 1", "revisit", "a ü%"), ("a ü%", "response", "None"), ("", "response", "None"), ("z", "response", "None")]
    )
    assert {r["url"] for r in records} == {None, "", "u%0Av", "u", "w"}
    only = read_archive(spark, write_archive(spark.createDataFrame([(None, None, html)] * 300, "page_id long, url string, html string").repartition(4))).collect()
    assert Counter(r["record_type"] for r in only) == {"response": 1, "revisit": 299} and {r["refers_to"] for r in only} == {None}


def test_archive(spark, tiny):
    html = "<p>" + "same page " * 20 + "</p>"
    rows = [(5, "u5", html), (2, "u2", html), (9, None, html), (3, "a", "tiny"), (4, "b", "tiny"), (6, "c", None), (7, "d", ""), (2, "u2", html), (8, "e", "äöü" * 50)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    path = write_archive(pages)
    records = read_archive(spark, path)
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in records.collect() if r["page_id"] != 2)
    big = len(html)
    assert got == [(3, 4, "response", None), (4, 4, "response", None), (5, big, "revisit", 2), (6, 0, "response", None), (7, 0, "response", None), (8, 300, "response", None), (9, big, "revisit", 2)]
    assert sorted(r["record_type"] for r in records.collect() if r["page_id"] == 2) == ["response", "revisit"]
    assert {bytes(r["payload"]).decode() for r in records.collect()} == {html, "tiny", "", "äöü" * 50}
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    assert {r["page_id"]: r["url"] for r in records.collect()} == {r[0]: r[1] for r in rows}
    read = [parse_record(bytes(r[0])) for r in records.select(warc_bytes(records)).collect()]
    assert len({f["WARC-Record-ID"] for f, _ in read}) == len(rows)
    named = {f["WARC-Record-ID"]: f for f, _ in read}
    for fields, block in read:
        assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", fields["WARC-Date"]) and re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"])
        head, _, body = block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if fields["WARC-Type"] == "response":
            assert hashlib.sha256(body).hexdigest() == digest and b"Content-Length: %d" % len(body) in head and "WARC-Refers-To" not in fields
        else:
            first = named[fields["WARC-Refers-To"]]
            assert body == b"" and first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"] and first["X-Page-ID"] == fields["X-Refers-To-Page-ID"]
    empty = spark.createDataFrame([], pages.schema)
    assert read_archive(spark, write_archive(empty)).count() == 0


def test_damaged_archive_is_an_error(spark):
    path = write_archive(spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string"))
    stored = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other")).collect()
    spark.createDataFrame(stored, "digest string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="damaged"):
        read_archive(spark, path).collect()
    spark.createDataFrame([], "digest string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="lost"):
        read_archive(spark, path).collect()


@pytest.mark.parametrize("name, sql", sorted({"op1_quality_rules": QUALITY_SQL, "op3_warc": queries.WARC_SQL, "op8_mixing": MIXING_SQL, **queries.PART_SQL}.items()))
def test_against_sql(spark, tiny, name, sql):
    assert assert_same(queries.queries()[name](spark, tiny), sql, connect(tiny)) > 0


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, None: 300}
    rows = {r["source"]: r for r in source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    left, free, want = float(sum(sizes.values())), {"a": 5, "b": 2, "c": 1, None: 5}, {}
    while True:  # share, stop at three times the size, share the excess again
        level = left / sum(free.values())
        over = [s for s in free if level * free[s] > 3 * sizes[s]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
            del free[s]
    want |= {s: level * w for s, w in free.items()}
    assert {s: r["target"] for s, r in rows.items()} == pytest.approx(want)


def test_mixing(documents, no_documents):
    assert mix_sources(no_documents).count() == 0
    rows = mix_sources(documents).collect()
    assert len(rows) == documents.count()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        key = r["source_size"]
        taken[key] += r["taken"]
        target[key] = r["target"]
        largest[key] = max(largest[key], r["size"])
    assert all(abs(taken[k] - target[k]) <= largest[k] for k in target)
    again = mix_sources(documents.repartition(5)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    mixed = mixed_documents(documents)
    assert mixed.columns == documents.columns and mixed_documents(no_documents).count() == 0
    words = mixed.select(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert words == sum(taken.values())


def plan_of(keyed, bin_rows, bins):
    return {r["source"]: r for r in mixing.mixing_plan(keyed, bin_rows, bins).collect()}


@pytest.mark.parametrize("weight", [1.0, 0.1, "mixed"])
def test_cut_is_narrowed_to_few_rows(spark, weight, monkeypatch):
    """The rows that one window task orders, for weights under which half of all keys crowd into the last equal bin."""
    w = F.lit(weight) if weight != "mixed" else F.when(F.col("id") % 2 == 0, 0.1).otherwise(1.0)
    rows = spark.range(60_000).withColumns({"doc_id": F.col("id"), "source": F.when(F.col("id") % 3 == 0, "small").otherwise("hot"), "text": F.repeat(F.lit("w "), (F.col("id") % 7).cast("int"))})
    parts = []
    narrow = mixing.narrowed
    monkeypatch.setattr(mixing, "narrowed", lambda *a: parts.append(narrow(*a)) or parts[-1])
    got = {r["doc_id"]: r["taken"] for r in mix_sources(rows, quality=w, bin_rows=50, bins=64).collect()}
    assert len(parts) > 1 and max(r["n"] for r in parts[-1].collect()) <= 50
    monkeypatch.undo()
    whole = {r["doc_id"]: r["taken"] for r in mix_sources(rows, quality=w, bin_rows=10**6).collect()}
    assert got == whole


def test_mixing_of_rows_without_ids_and_repeats(spark):
    null = [(None, f"text {i} " + "w " * (i % 5), "a") for i in range(900)]
    same = [(7, "one text of six words here", "b")] * 900
    docs = spark.createDataFrame(null + same + [(9, "x y z", None)], "doc_id long, text string, source string").repartition(4)
    rows = mix_sources(docs, bin_rows=40, bins=16).collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
    assert all(abs(taken[k] - target[k]) <= 6 for k in target)
    again = mix_sources(docs.repartition(7), bin_rows=40, bins=16).collect()  # reruns over other layouts agree
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    mixed = mixed_documents(docs, bin_rows=40, bins=16).persist()
    assert Counter(map(tuple, mixed.collect())) == Counter(map(tuple, mixed_documents(docs.repartition(7), bin_rows=40, bins=16).collect()))
    words = mixed.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()
    assert all(min(abs(r["n"] - t) for t in target.values()) <= 6 for r in words)


def test_packing_groups_of_repeated_rows(spark):
    rows = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.col("id").alias("row"))
    sizes = Counter(r["__group"] for r in packing.dealt_rows(rows, "row", 8).collect())
    assert len(sizes) == 8 and max(sizes.values()) < 700
    packed = pack_documents(rows, group_rows=500).collect()
    full = Counter(r["sequence_id"] for r in packed)
    assert len(packed) == 4000 and len(full) <= 8 * -(-600 * packed[0]["length"] // 1024)


def check_packing(rows, texts, window=1024):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc, text in texts.items():
        ids = struct.unpack(f"<{len(ENCODER.by_library(text)) // 4}I", ENCODER.by_library(text)) + (0,)
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{r['length']}I", *ids[at : at + r["length"]]))
            at += r["length"]
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window


def test_packing(spark, tiny, no_documents, documents):
    assert pack_documents(no_documents).count() == 0
    docs = queries.table(spark, tiny, "documents")
    rows = pack_documents(docs, group_rows=50).collect()
    check_packing(rows, {r["doc_id"]: r["text"] or "" for r in docs.collect()})
    once = documents.dropDuplicates(["doc_id"])
    check_packing(pack_documents(once).collect(), {r["doc_id"]: r["text"] or "" for r in once.collect()})
    assert pack_documents(documents.filter("doc_id = 6")).count() == 3  # a row that is there three times


def test_best_fit_is_the_tightest_window():
    r = random.Random(3)
    lengths = sorted((r.randint(1, 100) for _ in range(400)), reverse=True)
    room: list[int] = []
    for length, (sequence, offset) in zip(lengths, best_fit_decreasing(lengths, 100), strict=True):
        fitting = [c for c in room if c >= length]
        if fitting:
            assert room[sequence] == min(fitting)
        else:
            assert sequence == len(room)
            room.append(100)
        assert offset == 100 - room[sequence]
        room[sequence] -= length


def test_encoder_equals_the_library(spark, tiny):
    texts = [r[0] or "" for r in queries.table(spark, tiny, "documents").select("text").collect()]
    odd = ["<|endoftext|> a<|endoftext|>b  c \n\n d\t e　f", " " * 3000, "don't, 'S 's x.", "\x1c a \x85b ª º", "ünï. ²½ Ⅷ 🎉", "'t, we'll. ', .x"]
    r = random.Random(11)
    plain = [chr(c) for a, b in ((9, 10), (13, 13), (32, 126), (0xA0, 0x24F), (0x2010, 0x2027), (0x20AC, 0x20AC)) for c in range(a, b + 1)]
    odd += ["".join(r.choice(plain) for _ in range(r.randint(1, 60))) for _ in range(3000)]
    odd += ["".join(r.choice(" \t\n\r\xa0\u2028ab'1") for _ in range(r.randint(1, 40))) for _ in range(2000)]
    assert all(ENCODER.encode(t) == ENCODER.by_library(t) for t in texts + odd)


def test_encoder_without_tiktoken(monkeypatch):
    monkeypatch.setattr(packing.importlib.util, "find_spec", lambda name: None)
    slow = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert slow.fast is None and slow.encode("plain words, ünï") == ENCODER.encode("plain words, ünï")


def found(grammar, text):
    """Names of the arcs that each matched clause's path takes."""
    return [{n for n, c in zip(toxicity.NAMES, counts, strict=True) if c} for counts in grammar.clauses(text)]


def test_grammar_scores_clauses():
    grammar = Grammar(("zwerf",))
    assert found(grammar, "You are an idiot. Fine day.") == [{"insult", "aimed_insult"}]
    assert found(grammar, "What an idiot!") == [{"insult"}]
    assert found(grammar, "Idiot, you!") == [{"insult", "aimed_insult"}]
    assert found(grammar, "That is not an idiot.") == [{"insult", "denied"}]
    assert found(grammar, "The report said idiot was used.") == [{"insult", "told"}]
    assert found(grammar, "I will kill you now") == [{"threat", "aimed_threat"}]
    assert found(grammar, "zwerfen und zwerfig") == [{"insult", "more"}]
    assert found(grammar, 'It said: "an idiot. A moron" and idiot') == [{"insult", "told"}, {"insult", "more", "told"}]
    # a quotation that is never closed ends
    assert found(grammar, 'It said "hello. a. b. idiot') == [{"insult"}]
    assert found(grammar, "A calm text about rivers.") == found(grammar, None) == []


def read_clauses(symbols, w):
    """The grammar's rules read off clause by clause, without any transducer."""
    out, clause, told, quoted, reach = [], [], False, 0, 0
    for s in symbols:
        if s == ".":
            marks = [m for m in clause if m[0] in "ITY"]
            hits_ = [m for m in marks if m[0] != "Y"]
            if hits_:
                total = sum(w["denied"] * d + w["told"] * t for _, d, t in hits_)
                for kind, name in (("I", "insult"), ("T", "threat")):
                    n = sum(m[0] == kind for m in hits_)
                    total += w[name] * (n > 0) + w["more"] * max(0, n - 1)
                where = [m[0] for m in marks]
                if "Y" in where:
                    if where[0] == "Y":
                        aimed = next(m for m in where if m != "Y")
                    else:
                        aimed = "T" if "T" in where[: where.index("Y")] else "I"
                    total += w["aimed_insult" if aimed == "I" else "aimed_threat"]
                out.append(total)
            clause, told, quoted, reach = [], False, max(0, quoted - 1), 0
        else:
            clause.append((s, reach > 0, bool(told or quoted)))
            if s == '"':
                told, quoted = (False, 0) if quoted else (False, toxicity.QUOTED if told else 0)
            told = told or (s == "R" and not quoted)
            reach = toxicity.REACH if s == "N" else max(0, reach - 1)
    return out


def test_composed_grammar_against_plain_reading():
    r = random.Random(6)
    w = {n: r.uniform(-3, 3) for n in toxicity.NAMES}
    composed = toxicity.machine(w | {None: 0.0})
    counting = toxicity.machine(toxicity.UNITS)
    for _ in range(4000):
        symbols = [r.choice('IITTYYNNRO"OO..') for _ in range(r.randint(0, 25))] + ["."]
        want = read_clauses(symbols, w)
        assert toxicity.path_weights(composed, symbols) == pytest.approx(want)
        counts = toxicity.path_weights(counting, symbols)
        assert [float(np.dot(c, [w[n] for n in toxicity.NAMES])) for c in counts] == pytest.approx(want)


def test_text_score_is_the_log_sum_of_paths():
    assert toxicity.text_score([1.0, -2.0], 0.3) == pytest.approx(1 / (1 + math.exp(-0.3) / (1 + math.exp(1.0) + math.exp(-2.0))))
    assert toxicity.text_score([], -1.0) == pytest.approx(1 / (1 + math.e))


def test_fit_moves_the_weights_and_no_row_order_matters():
    r = random.Random(9)
    unit = np.eye(len(toxicity.NAMES))
    clean_told, insults = unit[0] + unit[6], unit[0]
    clauses = [np.array([clean_told])] * 40 + [np.array([insults])] * 40 + [np.zeros((0, 7))] * 200
    toxic = np.array([0.0] * 40 + [1.0] * 40 + [0.0] * 200)
    w, bias = toxicity.fit(clauses, toxic)
    score = lambda c: toxicity.text_score([float(x @ [w[n] for n in toxicity.NAMES]) for x in c], bias)
    assert score(clauses[0]) < 0.3 < score(clauses[50]) and score(clauses[-1]) < 0.05 and w["told"] < toxicity.PRIOR["told"]
    assert toxicity.fit([], np.array([])) == (toxicity.PRIOR, toxicity.BIAS) and r


def test_training_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 30, "w " * (3 + i // 30), "s") for i in range(600)] + [(500, "x" * 50_000, "s")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, 1) for i in [*range(30), 500]], "doc_id long, toxic int")
    rows = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", 4, 2, 10).collect()
    assert len(rows) == len({r["id"] for r in rows}) <= 10
    whole = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", 4, 2, 100).collect()
    assert len(whole) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(30)) and {r["text"] for r in whole} == {"w w w "}


def accuracy(rows, labels):
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return sum(p == y for p, y in held) / len(held)


def test_stems_are_learned_at_any_length():
    r = random.Random(4)
    noise = lambda: " ".join(sorted({"".join(r.choices("abcdefghij", k=6)) for _ in range(30)}))
    endings = ("kopf", "mann", "tum")
    toxic = [(f"{noise()} schandfleck{e}", 1) for e in endings for _ in range(6)]
    # the root alone is a clean word here, and so are its first seven letters
    clean = [(f"{noise()} {w}", 0) for w in ("schandf", "schandfuss", "wort") for _ in range(60)]
    assert toxicity.learn_stems(toxic + clean) == ("schandfleck",)
    # a word in copies of one toxic text is no evidence, however many there are
    copied = noise()
    copies = [(f"{copied} ende{k:04d}", 1) for k in range(400)]
    assert toxicity.learn_stems(copies + clean) == () == toxicity.learn_stems([]) == toxicity.learn_stems([("", 1)] * 9)
    assert len(toxicity.unlike([set(words.split()) for words, _ in copies])) == 1
    assert len(toxicity.unlike([set(words.split()) for words, _ in toxic])) == len(toxic)


def test_toxic_texts_are_found_in_every_language(spark):
    """By language over the held-out fold, with scores by the plain reading of the grammar for every text."""
    sf = "/root/testdata/sf0.1"
    docs, marks = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    held = toxicity_scores(docs, marks).filter("held_out").join(marks.select("doc_id", "toxic"), "doc_id").join(docs.select("doc_id", "lang", "text"), "doc_id").toPandas()
    for lang, least in (("en", 0.9), ("de", 0.7), ("fr", 0.8), ("es", 0.4)):
        assert held[(held.lang == lang) & (held.toxic == 1)].predicted.mean() >= least, lang
    assert held[held.predicted == 1].toxic.mean() >= 0.95
    stems, weights, bias = toxicity.learn_grammar(toxicity.training_sample(docs, marks, "doc_id", "text", "toxic", 4, 2, toxicity.TRAIN_ROWS))
    grammar = Grammar(stems)
    for text, score in zip(held.text, held.score, strict=True):
        assert score == pytest.approx(toxicity.text_score(read_clauses(grammar.symbols((text or "").lower()), weights), bias))


@pytest.mark.parametrize("score, column, modulus, remainder", [(toxicity_scores, "toxic", 4, 2), (quality_scores, "quality", 5, 0)])
def test_classifiers(spark, documents, no_documents, labels, score, column, modulus, remainder):
    sf = "/root/testdata/sf0.01"
    docs, marks = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    rows = score(docs, marks).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder) for r in rows)
    assert accuracy(rows, {r["doc_id"]: r[column] for r in marks.collect()}) > 0.9
    # labels of the held-out fold are never read
    flipped = marks.withColumn(column, F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder, 1 - F.col(column)).otherwise(F.col(column)))
    assert {r["doc_id"]: r["score"] for r in score(docs, flipped).collect()} == {r["doc_id"]: r["score"] for r in rows}
    assert score(no_documents, labels).count() == 0
    edge = score(documents, labels).collect()
    assert len(edge) == documents.count() and all(r["score"] == r["score"] for r in edge)
    assert score(documents, labels.filter("false")).count() == documents.count()


def bags():
    r = np.random.default_rng(0)
    return r.normal(size=(12, 16)), np.array([0, 3, 4, 9]), np.array([1.0, 0.0, 1.0, 0.0])


def test_attention_fits_a_few_bags():
    x, starts, y = bags()
    network = GatedAttention().fit(x, starts, y, epochs=400)
    assert (network.forward(x, starts)[0].round() == y).all()


def plain_forward(p, passages):
    """Gated attention over one bag, number by number."""
    dot = lambda v, matrix, k: sum(a * float(row[k]) for a, row in zip(v, matrix, strict=True))
    hidden, logits = [], []
    for passage in passages:
        v = [min(6.0, max(-6.0, (float(a) - float(m)) / float(s))) for a, m, s in zip(passage, p["mean"], p["scale"], strict=True)]
        h = [math.tanh(dot(v, p["W"], k) + float(p["b"][k])) for k in range(len(p["b"]))]
        gate = [math.tanh(dot(h, p["V"], k)) / (1 + math.exp(-dot(h, p["U"], k))) for k in range(len(p["w"]))]
        hidden.append(h)
        logits.append(sum(g * float(w) for g, w in zip(gate, p["w"], strict=True)))
    share = [math.exp(x) / sum(map(math.exp, logits)) for x in logits]
    z = [sum(a * h[k] for a, h in zip(share, hidden, strict=True)) for k in range(len(p["c"]))]
    return 1 / (1 + math.exp(-sum(a * float(c) for a, c in zip(z, p["c"], strict=True)) - float(p["d"][0])))


def test_attention_forward_against_plain_loops():
    x, starts, y = bags()
    network = GatedAttention(3).fit(x, starts, y, epochs=30)
    ends = [*starts[1:], len(x)]
    assert network.forward(x, starts)[0] == pytest.approx([plain_forward(network.p, x[a:b]) for a, b in zip(starts, ends, strict=True)])


def test_attention_gradients_against_differences():
    x, starts, y = bags()
    network = GatedAttention(5)
    loss = lambda: float(-np.mean(y * np.log(network.forward(x, starts)[0]) + (1 - y) * np.log(1 - network.forward(x, starts)[0])))
    for name, grad in network.gradients(x, starts, y).items():
        flat = network.p[name].reshape(-1)
        for k in range(0, len(flat), max(1, len(flat) // 7)):
            old, step = flat[k], 1e-5
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert grad.reshape(-1)[k] == pytest.approx((up - down) / (2 * step), abs=1e-7)


def test_queries_are_registered():
    assert len([n for n in queries.queries() if re.match(r"op\d+_", n)]) == 10
    assert sorted(queries.oracle_sql()) == ["media_payloads", "op1_quality_rules", "op3_warc", "op8_mixing", "packed_whole", "secret_counts"]
