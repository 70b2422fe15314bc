"""Title tokens, fact splitting and keyword sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let, squeeze

#: Words that never are title tokens.
STOPWORDS = ("的", "了", "和", "与", "在", "是", "一个", "一种", "之", "其", "这", "那", "第", "章", "卷", "篇")
#: Phrases that make a sentence no fact, and the answer's fixed opening.
NO_FACT = ("证据不足", "不能确认", "无法确认")
ANSWER_OPENING = "根据召回证据，当前小样本中可确认的信息是："
REFS_MARK = "evidence_refs:"


def normalize_title(title: Column) -> Column:
    return squeeze(title)


def is_punctuation_only(value: Column) -> Column:
    return value.rlike(r"\A[^\p{L}\p{N}]+\z")


def tokenize_title(title: Column, special_terms: list[str]) -> Column:
    """Dictionary terms found in the title and its runs of CJK or alphanumerics, each once, by first position and text."""
    terms = F.array(*map(F.lit, special_terms)) if special_terms else F.array().cast("array<string>")

    def tokens(norm: Column) -> Column:
        named = F.filter(terms, lambda t: F.instr(norm, t) > 0)
        runs = F.regexp_extract_all(norm, F.lit(r"[\x{4e00}-\x{9fff}A-Za-z0-9]+"), F.lit(0))
        wanted = F.filter(F.array_distinct(F.concat(named, runs)), lambda t: ~t.isin(*STOPWORDS) & ~t.rlike(r"\A第?[0-9]+章?\z") & ((F.length(t) > 1) | F.array_contains(terms, t)))
        placed = F.transform(wanted, lambda t: F.struct(F.instr(norm, t).alias("at"), t.alias("token")))
        return F.transform(F.array_sort(placed), lambda p: p["token"])

    return let(normalize_title(title), tokens)


def split_facts(answer: Column) -> Column:
    """Sentences of an answer before its references: squeezed, distinct, in order, without statements of missing evidence."""
    body = F.replace(F.substring_index(answer, REFS_MARK, 1), F.lit(ANSWER_OPENING), F.lit(""))
    parts = F.transform(F.split(body, r"[。；;\n]+", -1), squeeze)
    return F.array_distinct(F.filter(parts, lambda p: (p != "") & ~p.rlike("|".join(NO_FACT))))


def keyword_set(text: Column) -> Column:
    """CJK runs of 2 to 8 whole, longer ones as pairs, and lower-case tokens; sorted and distinct."""
    runs = F.regexp_extract_all(text, F.lit(r"[\x{4e00}-\x{9fff}]{2,}"), F.lit(0))
    pairs = lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))
    cjk = F.flatten(F.transform(runs, lambda r: F.when(F.length(r) <= 8, F.array(r)).otherwise(pairs(r))))
    latin = F.transform(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9_]{2,}"), F.lit(0)), F.lower)
    return F.array_sort(F.array_distinct(F.concat(cjk, latin)))
