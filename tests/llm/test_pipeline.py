"""The pipeline's stages against brute force on a small corpus."""

import re
from collections import Counter

import corpus_pipeline
from corpusloom.llm import queries
from corpusloom.llm.quality_rules import quality_rules
from tests.llm.conftest import document_schema
from tests.llm.test_corpus_operators import brute_components, brute_fingerprint, check_packing
from tests.llm.test_text_operators import brute_spans


def test_stages(spark, tiny):
    docs = queries.table(spark, tiny, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    verdict = {r["doc_id"]: r["kept"] for r in queries.op1_quality_rules(spark, tiny).collect()}

    judged = {r["doc_id"]: r["quality"]["clean_text"] for r in quality_rules(docs).collect()}
    kept = corpus_pipeline.keep_quality(spark, docs, tiny)
    assert kept.columns == docs.columns
    after = {i: {**before[i].asDict(), "text": judged[i], "n_chars": len(judged[i])} for i in before if verdict[i]}
    assert {r["doc_id"]: r.asDict() for r in kept.collect()} == after
    assert any(after[i]["text"] != before[i]["text"] for i in after)
    before = after

    single = corpus_pipeline.keep_one_of_copies(spark, kept, tiny)
    heads = brute_components({i: brute_fingerprint(r["text"]) for i, r in before.items()})
    assert {r["doc_id"]: r.asDict() for r in single.collect()} == {i: before[i] for i, h in heads.items() if i == h}

    clean = corpus_pipeline.redact_secrets(spark, single, tiny)
    rows = {r["doc_id"]: r for r in clean.collect()}
    assert set(rows) == {r["doc_id"] for r in single.collect()}
    for i, r in rows.items():
        assert not brute_spans(r["text"])
        assert r["text"] == before[i]["text"] or "[secret]" in r["text"]

    mixed = corpus_pipeline.mix_to_weights(spark, clean, tiny)
    times = Counter(r["doc_id"] for r in mixed.collect())
    want = {r["doc_id"]: r for r in queries.mix_sources(clean).collect()}
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert all(times[i] * size(rows[i]["text"]) == want[i]["taken"] for i in rows)

    packed = corpus_pipeline.pack_windows(spark, clean, tiny).collect()
    check_packing(packed, {i: r["text"] for i, r in rows.items()})


def test_edge_rows(spark, documents, no_documents):
    docs = no_documents
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0 and (name == "packing" or docs.columns == documents.columns)
    docs = documents
    others = [c for c in documents.columns if c not in ("text", "n_chars")]
    known = {repr([r[c] for c in others]) for r in documents.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        if name != "packing":
            assert docs.columns == documents.columns
            rows = docs.collect()
            assert rows and {repr([r[c] for c in others]) for r in rows} <= known  # clashing names keep their values
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert docs.count() > 0


def test_clashing_columns_keep_their_values(spark):
    names = ["kept", "clean_text", "n_words", "kept_words", "quality", "row", "head", "rows", "plan", "times", "copy", "number", "__row", "__head", "__plan", "__found", "__id", "fp", "c", "q"]
    words = lambda i: " ".join(f"w{i}x{k}" for k in range(60)) + " password = 'Abcdef0123456789xyz'"
    docs = spark.createDataFrame([(i, words(i), "en", "s", len(words(i)), *(f"mine {n} {i}" for n in names)) for i in range(12)], document_schema(names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        rows = docs.collect()
        assert len(rows) >= 10 and all(r[n] == f"mine {n} {r['doc_id']}" for r in rows for n in names), name


def copies(spark, *rows):
    docs = spark.createDataFrame([(i, t, "en", source, len(t)) for i, t, source in rows], document_schema()).repartition(3)
    return sorted(((r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.keep_one_of_copies(spark, docs, "").collect()), key=lambda r: (r[0] or 0, r[1:]))


def test_copies_of_repeated_ids(spark):
    a, b, x, y = (" ".join(f"{w}{i}" for i in range(60)) for w in ("apple", "bread", "xenon", "yacht"))
    assert copies(spark, (5, a, "s"), (5, b, "s")) == [(5, a, "s"), (5, b, "s")]
    assert copies(spark, (3, x, "s"), (5, x, "s"), (5, y, "s")) == [(3, x, "s"), (5, y, "s")]
    assert copies(spark, (7, x, "s"), (7, x, "s")) == [(7, x, "s")]
    assert len({tuple(copies(spark, *order)) for order in ([(7, x, "s"), (7, x, "t")], [(7, x, "t"), (7, x, "s")])}) == 1


def test_copies_of_null_ids(spark):
    a, b, near = (" ".join(f"{w}{i}" for i in range(60)) for w in ("apple", "bread", "apple"))
    near = near.replace("apple59", "Apple59")
    assert copies(spark, *[(None, a, "s")] * 50, (None, near, "s"), (9, a, "s"), (None, b, "s"), (None, b, "t")) in ([(None, b, "s"), (9, a, "s")], [(None, b, "t"), (9, a, "s")])
    assert len(copies(spark, *[(None, a, "s")] * 50)) == 1


def test_run_is_the_stages(spark, tiny):
    total = corpus_pipeline.run(spark, tiny)
    assert total.columns[:3] == ["doc_id", "start", "length"] and total.count() > 0
