"""Column helpers that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once and use it many times; higher-order functions repeat what they close over."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores after it where df has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The words in order; null and blank texts have none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, GAP))


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def count_symbols(text: Column) -> Column:
    """Characters of # * $ % & | < >."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long")
