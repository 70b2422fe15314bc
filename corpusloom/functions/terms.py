"""Terms of a dictionary in texts, by one automaton pass over each text.

A join on ``contains`` would hold every text against every term. Here the terms
travel to the workers as one automaton, which each batch looks up once; a text is
read once however many there are, and what it holds is joined on equality. Dictionaries come from the caller
and are held by each worker, so more than ``MOST_TERMS`` are refused.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.staging import ship_package

MOST_TERMS = 1_000_000


def distinct_terms(df: DataFrame, column: str) -> tuple[str, ...]:
    """The caller's terms on the driver; too many are an error."""
    rows = df.select(column).filter(F.col(column) != "").distinct().limit(MOST_TERMS + 1).collect()
    return checked([r[0] for r in rows])


def held(df: DataFrame) -> list[Row]:
    """The rows of a caller's dictionary on the driver; too many are an error."""
    rows = df.limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"a dictionary holds at most {MOST_TERMS} rows")
    return rows


def checked(terms) -> tuple[str, ...]:
    terms = tuple(sorted({t for t in terms if t}))
    if len(terms) > MOST_TERMS:
        raise ValueError(f"a dictionary holds at most {MOST_TERMS} terms")
    return terms


@lru_cache(maxsize=8)
def automaton(terms: tuple[str, ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for term in terms:
        a.add_word(term, term)
    a.make_automaton()
    return a


def found(text: str | None, a) -> dict[str, list[int]]:
    """Zero-based starts of each term's occurrences without overlap, left to right; terms that don't occur are left out. a: their automaton."""
    out: dict[str, list[int]] = {}
    if text and len(a):
        for last, term in a.iter(text):
            at = last - len(term) + 1
            starts = out.setdefault(term, [])
            if not starts or at >= starts[-1] + len(term):
                starts.append(at)
    return out


def longest(text: str | None, a) -> list[tuple[int, str]]:
    """Starts and terms without overlap: the leftmost one, of those at one place the longest, and so on after its end. a: the terms' automaton.

    One pass over the text whatever the dictionary's size; what an alternation of
    the terms, longest first, would find.
    """
    at: dict[int, str] = {}
    if text and len(a):
        for last, term in a.iter(text):
            start = last - len(term) + 1
            if len(term) > len(at.get(start, "")):
                at[start] = term
    out, free = [], 0
    for start in sorted(at):
        if start >= free:
            out.append((start, at[start]))
            free = start + len(at[start])
    return out


def term_starts(text: Column, terms: tuple[str, ...]) -> Column:
    """A struct of term and starts for each term that the text holds, in the terms' order."""
    ship_package(SparkSession.active())

    @F.pandas_udf("array<struct<term:string,starts:array<int>>>")
    def starts(texts: pd.Series) -> pd.Series:
        a = automaton(terms)
        return pd.Series([[{"term": t, "starts": s} for t, s in sorted(found(x, a).items())] for x in texts], dtype=object)

    return starts(text)


def owners_present(text: Column, owners: dict[str, list[str]]) -> Column:
    """The distinct owners of the terms that the text holds."""
    ship_package(SparkSession.active())
    terms = checked(owners)

    @F.pandas_udf("array<string>")
    def present(texts: pd.Series) -> pd.Series:
        a = automaton(terms)
        return pd.Series([sorted({o for t in found(x, a) for o in owners[t]}) for x in texts], dtype=object)

    return present(text)


def matches(text: Column, terms: tuple[str, ...]) -> Column:
    """Leftmost longest terms without overlap as structs of text and zero-based start."""
    ship_package(SparkSession.active())

    @F.pandas_udf("array<struct<m:string,s:int>>")
    def spans(texts: pd.Series) -> pd.Series:
        a = automaton(terms)
        return pd.Series([[{"m": m, "s": s} for s, m in longest(x, a)] for x in texts], dtype=object)

    return spans(text)
