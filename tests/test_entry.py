"""The driver's contract, with and without the training-data operators."""

import importlib
import importlib.util

import __spark_entry__ as entry


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_imports_without_the_optional_part(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *args: None if name in ("corpus_pipeline", "corpusloom.llm") else real(name, *args))
    module = importlib.reload(entry)
    assert not any(n.startswith("op") or n == "pipeline" for n in module.queries())
    monkeypatch.undo()
    importlib.reload(entry)
