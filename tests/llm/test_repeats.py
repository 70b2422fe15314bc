"""Removal of repeated passages against a plain version, and the merge of sorted runs."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries, repeats
from corpusloom.llm import suffixes as sx
from corpusloom.llm.repeats import remove_repeats


def plain(rows, width=50):
    """rows: (id, text). (id, n_bytes, starts, ends, kept) of each row."""
    key = lambda i: (i is None, i or 0)
    least = {}
    for i, text in rows:
        data = (text or "").encode()
        for w in {data[p : p + width] for p in range(len(data) - width + 1)}:
            least[w] = min(least.get(w, (True, 1)), key(i))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - width + 1):
            if least[data[p : p + width]] < key(i):
                gone[p : p + width] = b"\1" * width
        starts = [p for p in range(len(data)) if gone[p] and (p == 0 or not gone[p - 1])]
        ends = [p + 1 for p in range(len(data)) if gone[p] and (p + 1 == len(data) or not gone[p + 1])]
        out.append((i, len(data), starts, ends, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return out


def found(df):
    return sorted(((r[0], r["n_bytes"], r["starts"], r["ends"], bytes(r["kept"])) for r in df.collect()), key=repr)


def passages(seed, n=120):
    """Texts of shared passages, copies, near copies, periods, zero bytes and short tails."""
    r = random.Random(seed)
    letters = "abcdefgh éß日\x00\n"
    made = ["".join(r.choice(letters) for _ in range(r.randrange(30, 200))) for _ in range(12)]
    texts = [None, "", "x" * 49, "x" * 50, "x" * 51, "ab" * 400, "ba" * 300, "x" * 2000, "\x00" * 60, "a" + "\x00" * 70, made[0], made[0], made[1][:50], made[1][:49]]
    for _ in range(n):
        parts = [r.choice(made) if r.random() < 0.5 else "".join(r.choice(letters) for _ in range(r.randrange(80))) for _ in range(r.randrange(1, 5))]
        text = "".join(parts)
        if r.random() < 0.3 and len(text) > 60:  # an edit
            p = r.randrange(len(text))
            text = text[:p] + "#" + text[p + 1 :]
        texts.append(text)
    rows = [(r.randrange(-5, 2 * n) if r.random() < 0.95 else None, t) for t in texts]
    return rows + rows[-3:]


@pytest.mark.parametrize(("seed", "sizes"), [(1, {}), (2, {"block_bytes": 1500, "bucket_rows": 50, "range_bytes": 700}), (3, {"block_bytes": 700, "range_bytes": 2000, "hot": 2}), (4, {"block_bytes": 100, "hot": 0})])
def test_repeats_equal_plain(spark, seed, sizes):
    rows = passages(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(remove_repeats(docs, **sizes)) == sorted(plain(rows), key=repr)


def test_edge_cases(spark, documents, no_documents):
    got = remove_repeats(documents, block_bytes=5000)
    assert found(got) == sorted(plain([(r["doc_id"], r["text"]) for r in documents.collect()]), key=repr)
    assert remove_repeats(no_documents).collect() == []


def test_integer_ids_keep_their_type(spark):
    docs = spark.createDataFrame([(2, "y" * 60), (1, "y" * 60)], "doc_id int, text string")
    got = remove_repeats(docs)
    assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType and found(got) == [(1, 60, [], [], b"y" * 60), (2, 60, [0], [60], b"")]


def test_query_equals_plain(spark, tiny):
    rows = [(r["doc_id"], r["text"]) for r in queries.table(spark, tiny, "documents").collect()]
    want = sorted((i, n, sum(b - a for a, b in zip(x, y, strict=True)), len(x), hashlib.sha256(kept).hexdigest()) for i, n, x, y, kept in plain(rows))
    got = queries.op12_repeats(spark, tiny)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and sorted(map(tuple, got.collect())) == want
    assert sum(r[2] for r in want)


def test_one_passage_in_all_texts_stays_small(spark):
    """A passage that every text holds is sent once a block, under hot keys too, and no row of the exchange holds more than a block's run."""
    body = "".join(random.Random(9).choice("abcdef") for _ in range(400))
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lpad("id", 30, "."), F.lit(body), F.lpad("id", 30, "-")).alias("text")).repartition(4)
    blocks = repeats.packed_blocks(docs, "doc_id", "text", 20_000).persist()
    notes = repeats.shared_anchors(repeats.anchors(blocks, 4), 8).persist()
    sent = repeats.runs(blocks, notes, 8)
    n, rows = blocks.count(), sent.agg(F.sum(F.length("sizes"))).first()[0]
    assert n > 10 and rows < 3 * 600 * 20 + n * 500
    got = found(remove_repeats(docs, block_bytes=20_000, hot=8))
    assert [len(r[2]) for r in got].count(1) == 599
    blocks.unpersist()
    notes.unpersist()


def test_merged_runs_are_one_sorted_list():
    r = random.Random(4)
    for k in (1, 2, 3, 7):
        lists = [sorted({bytes(r.choice(b"ab\0") for _ in range(r.randrange(0, 9))) for _ in range(r.randrange(40))}) for _ in range(k)]
        shared = [bytes(sx.common_prefixes(x).tolist()) for x in lists]
        assert [sx.decoded(*sx.front_coded(x, np.frombuffer(s, np.uint8))) for x, s in zip(lists, shared, strict=True)] == lists
        order, common = sx.merged(lists, shared)
        at, out = [0] * k, []
        for run in order:
            out.append(lists[run][at[run]])
            at[run] += 1
        assert out == sorted(x for run in lists for x in run)
        assert common[1:] == [sx.prefix(a, b, 0) for a, b in zip(out, out[1:], strict=False)]


def test_known_prefixes_are_not_compared_again(monkeypatch):
    """Runs that share long prefixes look at each byte of the answer about once."""
    r, looked = random.Random(1), []
    words = sorted({b"p" * 80 + bytes(r.choice(b"abcd") for _ in range(12)) for _ in range(400)})
    lists = [words[i::8] for i in range(8)]
    real = sx.prefix
    monkeypatch.setattr(sx, "prefix", lambda a, b, known: looked.append(real(a, b, known) - known) or real(a, b, known))
    sx.merged(lists, [bytes(sx.common_prefixes(x).tolist()) for x in lists])
    assert sum(looked) < 8 * 92 + 400 * 12


def test_windows_of_equal_bytes_have_equal_anchors():
    r = random.Random(2)
    shared = bytes(r.randrange(256) for _ in range(300))
    keys = []
    for _ in range(2):
        left, right = (bytes(r.randrange(256) for _ in range(r.randrange(200))) for _ in range(2))
        s = sx.suffixes(left + shared + right + sx.PAD, np.array([len(left) + 300 + len(right)]))
        of = np.repeat(np.arange(len(s.start)), s.windows)
        keys.append(s.key[of][len(left) : len(left) + 251])
        assert s.windows.sum() == len(left) + len(right) + 251
    assert (keys[0] == keys[1]).all()
