"""The stored hash tree against plain comparison of rows."""

import random
import shutil
from collections import Counter
from pathlib import Path

import pytest

from corpusloom.operators import hashtree as H

SCHEMA = "id string, a long, b array<string>"


def plain_differences(left, right):
    """{key: (state, rows on the left, rows on the right)} by multisets of whole rows."""
    out = {}
    for key in {r[0] for r in left} | {r[0] for r in right}:
        mine, yours = (Counter(str(r) for r in rows if r[0] == key) for rows in (left, right))
        if mine != yours:
            out[key] = ("missing" if not yours else "extra" if not mine else "changed", mine.total(), yours.total())
    return out


def found(spark, left, right):
    return {r["key"]: (r["state"], r["left_rows"], r["right_rows"]) for r in H.differing_keys(spark, left, right).collect()}


def root(spark, path):
    return [(r["n_rows"], r["digest"]) for r in H.nodes(spark, path).filter("level = 0").collect()]


def test_differences_are_found_where_they_are(spark, tmp_path):
    r = random.Random(8)
    rows = [(f"k{i}", i % 7, ["x", str(i)]) for i in range(3000)] + [(None, None, None), (None, 1, []), ("", None, None), ("hot", 1, None)] + [("hot", i, ["h"]) for i in range(1500)] + [("twin", 1, ["t"])] * 2
    other = [row for row in rows if row[0] != "k17"]
    other[5] = ("k5", 6, ["x", "5"])
    other.remove((None, None, None))
    other.remove(("twin", 1, ["t"]))
    other.append(("new|1:2", None, ["y"]))
    other[40] = ("moved", *other[40][1:])
    other[other.index(("hot", 9, ["h"]))] = ("hot", 9, ["H"])
    r.shuffle(other)
    paths = {}
    for name, data in (("left", rows), ("right", other), ("again", rows[::-1]), ("none", [])):
        paths[name] = str(tmp_path / name)
        H.write_tree(spark.createDataFrame(data, SCHEMA).repartition(3), "id", paths[name], folders=2 if name in ("left", "right") else 1)
    want = plain_differences(rows, other)
    assert len(want) == 8 and found(spark, paths["left"], paths["right"]) == want
    # the order of rows and of columns doesn't matter, every row does
    assert root(spark, paths["left"]) == root(spark, paths["again"]) != root(spark, paths["right"])
    assert found(spark, paths["left"], paths["again"]) == {} == found(spark, paths["none"], paths["none"])
    assert H.differing_leaves(spark, paths["left"], paths["again"])[1] == 1
    assert found(spark, paths["none"], paths["left"]) == plain_differences([], rows)
    # nodes are compared only below nodes that differ
    leaves, compared = H.differing_leaves(spark, paths["left"], paths["right"])
    assert compared <= 1 + 16 + 16 * 9 + 16 * 9 < H.nodes(spark, paths["left"]).count() / 4
    # and no other range is read: the others may as well be gone
    kept = {n[:2] for n in leaves}
    for side in ("left", "right"):
        for folder in Path(paths[side], "index").glob("part=*"):
            if folder.name[5:] not in kept:
                shutil.rmtree(folder)
    assert len(kept) <= 9 and found(spark, paths["left"], paths["right"]) == want


def test_random_changes_against_plain_comparison(spark, tmp_path, monkeypatch):
    r = random.Random(3)
    for k, listed in enumerate((H.LISTED, 2)):
        monkeypatch.setattr(H, "LISTED", listed)
        make = lambda: [(r.choice([None, "", "a", "b|", f"{r.randint(0, 300)}"]), r.choice([None, 0, 1]), r.choice([None, [], [""], ["a", "b"]])) for _ in range(400)]  # noqa: B023, E731
        left = make()
        right = r.sample(left, 380) + make()[:10]
        for name, data in (("l", left), ("r", right)):
            H.write_tree(spark.createDataFrame(data, SCHEMA), "id", str(tmp_path / f"{name}{k}"), levels=2)
        assert found(spark, str(tmp_path / f"l{k}"), str(tmp_path / f"r{k}")) == plain_differences(left, right)


def test_trees_that_cannot_be_compared_or_written(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, ["b"])], SCHEMA)
    H.write_tree(rows, "id", str(tmp_path / "two"), levels=2)
    H.write_tree(rows.withColumn("key", rows.a).withColumn("leaf", rows.a), "id", str(tmp_path / "three"))
    with pytest.raises(ValueError, match="levels"):
        H.differing_leaves(spark, str(tmp_path / "two"), str(tmp_path / "three"))
    with pytest.raises(ValueError, match="exists"):
        H.write_tree(rows, "id", str(tmp_path / "two"))
    with pytest.raises(ValueError, match="digits"):
        H.write_tree(rows, "id", str(tmp_path / "one"), levels=2, folders=3)
