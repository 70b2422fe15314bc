"""Every registered query of the library against its SQL on the smallest corpus."""

import pytest

from corpusloom.operators.retrieval import nearest
from corpusloom.plans import registry
from corpusloom.plans.retrieval import K
from tests.oracle import assert_same, connect

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, tiny, con, name):
    assert_same(registry.queries()[name](spark, tiny), SQL[name], con)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(SQL)


def test_as_of_answers_every_event(spark, tiny):
    events = spark.read.parquet(f"{tiny}/events.parquet")
    assert registry.queries()["j25_as_of"](spark, tiny).count() == events.count()


def test_neighbours_of_every_20th_vector_in_small_blocks(spark, tiny):
    whole = registry.queries()["x25_vector_neighbours"](spark, tiny)
    assert whole.select("query_id").distinct().count() == 25
    v = spark.read.parquet(f"{tiny}/embeddings.parquet").selectExpr("vec_id", "cast(embedding as array<double>) as embedding")
    parts = nearest(v, v.filter("vec_id % 20 = 0"), K, rows=100, block=10)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def test_context_of_every_hit_is_whole(spark, tiny):
    rows = registry.queries()["j19_context_window"](spark, tiny).collect()
    assert {r["evidence_id"] for r in rows} == {r["evidence_id"] for r in registry.queries()["w05_evidence_candidates"](spark, tiny).collect()}
    text = {r["doc_id"] + 1: r["text"] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    chapter = {r["evidence_id"]: r["chapter_num"] for r in registry.queries()["w05_evidence_candidates"](spark, tiny).collect()}
    assert all(text[chapter[r["evidence_id"]]][r["start_offset"] : r["end_offset"]] == r["para_text"] for r in rows)
    assert max(len(r["para_text"]) for r in rows) > 20


def test_neighbours_prune_and_survive_copies(spark):
    """Clustered vectors with 4,000 copies of one and one far away: exact, with few of all pairs compared."""
    import numpy as np

    from corpusloom.operators import retrieval as R

    r = np.random.default_rng(3)
    centres = r.normal(size=(40, 8)) * 20
    x = np.concatenate([centres[r.integers(0, 40, 4000)] + r.normal(size=(4000, 8)), np.tile(centres[0], (4000, 1)), [[1e3] * 8]])
    ids = r.permutation(len(x))
    v = spark.createDataFrame([(int(i), row.tolist()) for i, row in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(4)
    asked = v.filter("vec_id % 40 = 0")
    got = {}
    for q in R.nearest(v, asked, 5, rows=100, block=64).collect():
        got.setdefault(q["query_id"], []).append((q["distance"], q["vec_id"]))
    for i, row in zip(ids, x, strict=True):
        if i % 40 == 0:
            d = np.floor(((x - row) ** 2).sum(axis=1) * 1e6 + 0.5) / 1e6
            want = sorted((float(a), int(b)) for a, b in zip(d, ids, strict=True) if b != i)[:5]
            assert [b for _, b in sorted(got[i])] == [b for _, b in want]
    cells = R.Cells(v, 6, 100, 2048)
    assert cells.size.sum() == 4000 + 6 + 1 and len(cells.size) > 30
    first = R.visits(cells, asked, 5)
    tau = R.search_cells(cells, first, 5, 64).filter("place = 5").selectExpr("query_id as vec_id", "sqrt(distance) as tau")
    met = sum(int(cells.size[c["cell"]]) for c in first.select("cell").collect() + R.visits(cells, asked, 5, tau).select("cell").collect())
    assert met < 0.2 * asked.count() * 8001
    assert R.nearest(v.limit(0), asked, 5).collect() == [] and R.nearest(v, asked.limit(0), 5).collect() == []
