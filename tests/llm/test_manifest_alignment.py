"""Merkle manifests and token alignment against plain versions, and their edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import alignment, merkle, queries
from corpusloom.llm.alignment import alignments
from corpusloom.llm.merkle import FIELDS, MANIFEST_SQL, fold, leaf_hash, merkle_manifest, proof_text, verified_documents
from tests.oracle import assert_same, connect


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes, fanout):
    """The root, and each leaf's siblings as (left, right) by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for leaf, place in enumerate(at):
            run, k = runs[place // fanout], place % fanout
            proofs[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            at[leaf] = place // fanout
        nodes = [digest(*run) for run in runs]
    return nodes[0], proofs


def plain_manifest(leaves, fanout=8):
    """leaves: (group, id, leaf). A list of (id, leaf, subroot, root, proof)."""
    groups = defaultdict(list)
    for group, i, leaf in leaves:
        groups[group].append((i, leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = plain_tree([leaf for _, leaf in groups[g]], fanout)
    root, over = plain_tree([trees[g][0] for g in order], fanout)
    return [(i, leaf, trees[g][0], root, tuple(trees[g][1][k] + over[t])) for t, g in enumerate(order) for k, (i, leaf) in enumerate(groups[g])]


def in_order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("fanout", "levels"), [(8, 3), (8, 1), (2, 2), (3, 2)])
def test_manifest_equals_plain_tree(spark, fanout, levels):
    """Groups of 1 to 700 leaves, null groups and ids, ids in no order; buckets that are full, short and of one leaf."""
    r = random.Random(fanout)
    sizes = {"a": 700, "é": 65, "z": 64, "": 9, None: 8, "one": 1, **{f"g{i}": i + 1 for i in range(12)}}
    rows = [(r.randrange(10**12), g, f"t{i}") for g, n in sizes.items() for i in range(n)] + [(None, "a", "x"), (None, None, None), (5, "a", None), (5, "a", "")]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    got = merkle_manifest(docs, ("doc_id", "text"), fanout=fanout, levels=levels)
    want = plain_manifest([(g, i, plain_leaf(i, t)) for i, g, t in rows], fanout)
    found = [(x["doc_id"], x["leaf"], x["subroot"], x["root"], tuple(zip(x["left"], x["right"], strict=True))) for x in got.collect()]
    assert in_order(found) == in_order(want)
    assert got.filter(fold(F.col("leaf"), F.col("left"), F.col("right")) != F.col("root")).count() == 0
    assert got.filter(F.length(proof_text(F.col("left"), F.col("right"))) % 64 != 0).count() == 0


def test_a_single_leaf_and_single_leaves_a_group(spark):
    one = spark.createDataFrame([(7, "en", "x")], "doc_id long, lang string, text string")
    row = merkle_manifest(one, ("text",)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == plain_leaf("x") and row["left"] == row["right"] == []
    apart = spark.createDataFrame([(i, f"g{i}", "x") for i in range(20)], "doc_id long, lang string, text string")
    want = plain_manifest([(f"g{i}", i, plain_leaf("x")) for i in range(20)])
    assert in_order((x["doc_id"], x["subroot"], x["root"]) for x in merkle_manifest(apart, ("text",)).collect()) == in_order((i, s, r) for i, _, s, r, _ in want)


def test_tampering_is_found(spark, documents, no_documents):
    rows = verified_documents(documents).collect()
    want = {}
    for x in documents.collect():
        changed = x["text"] and "".join(c.lower() if "A" <= c <= "Z" else c for c in x["text"]) != x["text"]
        want[x["doc_id"]] = not (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 3 == 0 and changed)
    assert len(rows) == documents.count() and {x["doc_id"]: x["verified"] for x in rows} == want
    assert not all(want.values())
    assert verified_documents(no_documents).collect() == []


def test_manifest_query_equals_sql_and_plain(spark, tiny):
    con = connect(tiny)
    assert assert_same(queries.op11_merkle(spark, tiny), MANIFEST_SQL, con)
    docs = con.execute(f"SELECT lang, {', '.join(FIELDS)} FROM documents").fetchall()
    want = plain_manifest([(lang, fields[0], plain_leaf(*fields)) for lang, *fields in docs])
    got = {x["doc_id"]: (x["leaf"], x["subroot"], x["root"], x["proof_sha256"]) for x in queries.op11_merkle(spark, tiny).collect()}
    assert got == {i: (leaf, s, r, digest(*(a + b for a, b in proof))) for i, leaf, s, r, proof in want}


def test_leaf_hash_keeps_fields_apart(spark):
    rows = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("", "x"), ("-", "x"), ("é", "日")], "a string, b string")
    got = [x[0] for x in rows.select(leaf_hash(F.col("a"), F.col("b"))).collect()]
    assert got == [plain_leaf(*x) for x in rows.collect()] and len(set(got)) == 6
    assert merkle.height(1, 8) == 0 and merkle.height(8, 8) == 1 and merkle.height(9, 8) == 2


A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE = {chr(b): b for b in _PRINTED} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def plain_groups(text):
    """The groups of a text, each as (a ids, b ids)."""
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False), B.encode(text)
    a_bytes = [bytes(_BYTE[c] for c in t) for t in a.tokens]
    b_bytes = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, B.encode(text, out_type=str), strict=True)]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return []
    ids, groups, own, other, x, y, i, j = a.ids, [], [], [], 0, 0, 0, 0
    while i < len(a_bytes) or j < len(b_bytes):
        if x <= y and i < len(a_bytes):
            x, i = x + len(a_bytes[i]), i + 1
            own.append(ids[i - 1])
        else:
            y, j = y + len(b_bytes[j]), j + 1
            other.append(b[j - 1])
        if x == y:
            groups.append((own, other))
            own, other = [], []
    return groups


def plain_alignments(rows):
    per_row, held = [], Counter()
    for i, text in rows:
        groups = plain_groups(text)
        links = Counter()
        for a, b in groups:
            for x, n in Counter(a).items():
                for y, m in Counter(b).items():
                    links[x, y] += n * m
        held.update(links.keys())
        per_row.append((i, groups, links))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for i, groups, links in per_row:
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(n for (x, y), n in links.items() if held[x, y] == most[x])
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()), best, sum(n * held[p] for p, n in links.items()), digest(said) if groups else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_query_equals_plain(spark, tiny):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, tiny, "documents").collect()]
    got = queries.op13_alignment(spark, tiny)
    assert got.columns == COLUMNS and in_order(map(tuple, got.collect())) == in_order(plain_alignments(rows))


@pytest.mark.parametrize("broadcast_rows", [0, 10**6])
def test_alignment_edge_cases(spark, documents, no_documents, broadcast_rows):
    """Nulls, repeated rows, long texts, texts that one side changes, stretches without a shared end; counts by broadcast and by shuffle."""
    odd = ["▁ already", "ﬁ ligature", "<s> </s> <unk>", "<|endoftext|>", "\x00nul", "a" * 20_000, " " * 3_001, "\n" * 2_000, "😀" * 500, "日本" * 400, "ab1" * 2_000, " x", "x ", "\t\t", "0" * 999]
    fresh = [(100 + k, t) for k, t in enumerate(odd)]
    docs = documents.select("doc_id", "text", "row", "cut").unionByName(spark.createDataFrame(fresh, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = alignments(docs, broadcast_rows=broadcast_rows)
    assert in_order(map(tuple, got.collect())) == in_order(plain_alignments(rows))
    assert alignments(no_documents).collect() == []


def test_large_groups_are_listed_by_distinct_pairs(spark):
    """A group of 300 by 200 tokens gives a row a distinct pair, and counts as many links."""
    ends = [*range(1, 300), 1000], [*(500 + k for k in range(199)), 1000]
    row = ([k % 3 for k in range(300)], ends[0], [k % 2 for k in range(200)], ends[1])
    sides = spark.createDataFrame([row], "a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>")
    got = alignment.aligned(sides, 1 << 20).first()
    assert got["n_groups"] == 1 and got["p"] == [] and {(x["p"] >> 20, x["p"] & 0xFFFFF, x["n"]) for x in got["heavy"]} == {(a, b, 10_000) for a in range(3) for b in range(2)}


def test_groups_of_rows_together_equal_plain(spark):
    """Rows with and without tokens, small and large groups, side by side in a batch; no lambda runs over the tokens, and the session's batches stay as they were."""
    r, width = random.Random(13), 1 << 20
    rows, want = [], {}
    for i in range(60):
        groups = [([r.randrange(5) for _ in range(r.choice((1, 1, 1, 2, 3, 12)))], [r.randrange(7) for _ in range(r.choice((1, 1, 2, 9)))]) for _ in range(r.choice((0, 1, 2, 40)))]
        sides, upto = ([], [], [], []), 0
        for a, b in groups:
            inside = r.sample(range(upto + 1, upto + 100), len(a) + len(b) - 2)
            for k, ids, own in ((0, a, inside[: len(a) - 1]), (2, b, inside[len(a) - 1 :])):
                sides[k].extend(ids)
                sides[k + 1].extend([*sorted(own), upto + 100])
            upto += 100
        rows.append((i, *sides))
        links = Counter(x * width + y for a, b in groups for x in a for y in b)
        want[i] = (len(groups), digest(";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)) if groups else "", links)
    sides = spark.createDataFrame(rows, "k int, a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>").coalesce(1)
    found = alignment.aligned(sides, width)
    assert "lambda" not in found._jdf.queryExecution().toString()
    got = {x["k"]: (x["n_groups"], x["groups_sha256"], Counter(x["p"]) + Counter({h["p"]: 0 for h in x["heavy"]}), x["heavy"]) for x in found.collect()}
    for i, (n, said, links) in want.items():
        total = got[i][2].copy()
        for h in got[i][3]:
            total[h["p"]] += h["n"]
        assert got[i][:2] == (n, said) and total == links
    before = [spark.conf.get(k) for k in alignment._BATCHES]
    with pytest.raises(ZeroDivisionError), alignment.small_batches(spark):
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "500"
        raise ZeroDivisionError
    assert [spark.conf.get(k) for k in alignment._BATCHES] == before
