"""Text normalisation, cleaning and hashing as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a class that Java and RE2 read alike; the ideographic space is in it.
WS = r"[ \t\n\x0B\f\r\x{85}\x{a0}\x{3000}]"

#: Patterns of invisible characters, front matter and chapter titles.
INVISIBLE = r"[\x{200b}\x{feff}\x{a0}\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
FRONT_MATTER = r"(?s)\A(---\n.*?\n---)(\n*)"
CHAR_COUNT = r"(?m)^char_count:[ \t]*[^\n]*$"
NUMBER = r"(?:[0-9０-９]+|[零〇一二两三四五六七八九十百千万]+)"
TITLES = (
    rf"\A{WS}*第{WS}*{NUMBER}{WS}*章(?:{WS}+[^ \t\n].{{0,80}}|{WS}*)\z",
    rf"\A{WS}*(?:序章|楔子|引子|后记|尾声)(?:{WS}+[^ \t\n].{{0,80}}|{WS}*)\z",
    rf"\A{WS}*番外(?:{WS}*{NUMBER})?(?:{WS}+[^ \t\n].{{0,80}}|{WS}*)\z",
)
CHAPTER_NUMBER = r"第[ \t]*([0-9]+)[ \t]*章"
FULL_WIDTH = (",?!:;", "，？！：；")
FORBIDDEN_IN_NAMES = r'[<>:"/\\|?*\x00-\x1f]'
LONGEST_TITLE = 90


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate value once for all its uses in body."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without_tail(text: Column, kind: str) -> Column:
    """The text without the characters of a class at its end; a run is only tried where it starts, so long runs inside cost no more than others."""
    return F.regexp_replace(text, rf"(?<!{kind}){kind}++\z", "")


def strip(text: Column) -> Column:
    return without_tail(F.regexp_replace(text, rf"\A{WS}++", ""), WS)


def squeeze(text: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return strip(F.regexp_replace(text, f"{WS}+", " "))


def remove_invisible(text: Column) -> Column:
    return F.regexp_replace(text, INVISIBLE, "")


def full_width_punctuation(text: Column) -> Column:
    return F.translate(text, *FULL_WIDTH)


def clean_body(body: Column) -> Column:
    """Lines trimmed of blanks and squeezed; empty ones go; blank lines between the rest."""
    lines = F.transform(F.split(body, "\n", -1), lambda s: F.regexp_replace(without_tail(F.regexp_replace(s, r"\A[ \t]++", ""), r"[ \t]"), r"[ \t]+", " "))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n\n")


def front_matter(text: Column) -> Column:
    """The block between the leading dashes with them, or an empty string."""
    return F.regexp_extract(text, FRONT_MATTER, 1)


def after_front_matter(text: Column) -> Column:
    return F.regexp_replace(text, FRONT_MATTER, "")


#: Possessive: Java runs a plain repeated group by recursion, and many blank lines run its stack out.
_BLANK_LINES = r"\A(?:[ \t\r\f\x0B]*+\n)*+"


def title_block(rest: Column) -> Column:
    """The first line with anything on it, if it is a level-one heading; else empty."""
    return without_tail(F.regexp_extract(rest, rf"{_BLANK_LINES}(# [^\n]*)", 1), WS)


def after_title(rest: Column) -> Column:
    return F.regexp_replace(rest, rf"{_BLANK_LINES}# [^\n]*(?:\n|\z)", "")


def clean_markdown(text: Column) -> Column:
    """A struct of the cleaned chapter and its body's length before and after."""
    rest = after_front_matter(text)
    body = F.when(title_block(rest) != "", after_title(rest)).otherwise(rest)
    cleaned = clean_body(full_width_punctuation(remove_invisible(body)))

    def build(c: Column) -> Column:
        head = front_matter(text)
        counted = F.regexp_replace(head, CHAR_COUNT, F.concat(F.lit("char_count: "), F.length(c)))
        parts = F.filter(F.array(counted, title_block(rest), c), lambda s: s != "")
        joined = without_tail(F.array_join(parts, "\n\n"), r"\n")
        return F.struct(F.concat(joined, F.lit("\n")).alias("cleaned"), F.length(body).alias("before_chars"), F.length(c).alias("after_chars"))

    return let(cleaned, build)


def strip_front_matter(text: Column) -> Column:
    """What follows the closing dashes of a leading block, line ends made uniform."""
    return F.regexp_replace(uniform_lines(text), r"(?s)\A---\n.*?\n---\n", "")


def uniform_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def normalize_text(text: Column) -> Column:
    flat = F.regexp_replace(uniform_lines(text), r"[\t\x{3000}]", " ")
    return strip(F.regexp_replace(flat, r"\n{3,}", "\n\n"))


def front_matter_value(text: Column, key: str) -> Column:
    """The unquoted value of a line 'key: value', or null."""
    found = F.regexp_extract(text, rf"(?m)^{key}:[ \t]*['\"]?([^'\"\n]+)['\"]?[ \t]*$", 1)
    return F.nullif(strip(found), F.lit(""))


def chapter_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, CHAPTER_NUMBER, 1), F.lit("")).cast("long")


def h1_title(content: Column, lines: int = 12) -> Column:
    """The first heading among the first lines, without its marks; empty if none."""
    heads = F.filter(F.transform(F.slice(F.split(content, "\n", -1), 1, lines), strip), lambda s: s.startswith("#"))
    return F.coalesce(strip(F.regexp_replace(F.get(heads, 0), r"\A#+", "")), F.lit(""))


def is_chapter_title(line: Column) -> Column:
    short = let(strip(line), lambda s: (s != "") & (F.length(s) <= LONGEST_TITLE))
    return short & (line.rlike(TITLES[0]) | line.rlike(TITLES[1]) | line.rlike(TITLES[2]))


def safe_filename(value: Column, longest: int = 80) -> Column:
    name = F.regexp_replace(F.regexp_replace(strip(value), FORBIDDEN_IN_NAMES, "_"), f"{WS}+", "_")
    name = without_tail(F.regexp_replace(name, r"\A[ ._]++", ""), "[ ._]")
    return without_tail(F.substring(F.when(name == "", "untitled").otherwise(name), 1, longest), "[ ._]")


def yaml_quote(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def sha256(value: Column) -> Column:
    return F.sha2(F.encode(value, "UTF-8"), 256)


def stable_id(prefix: str, *parts: Column, length: int = 16) -> Column:
    """prefix_ and the first hex digits of the SHA-256 of the parts joined by bars; null parts read as None."""
    joined = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts))
    return F.concat(F.lit(f"{prefix}_"), F.substring(sha256(joined), 1, length))


def snippet(text: Column, longest: int = 120) -> Column:
    return F.substring(squeeze(text), 1, longest)


def estimate_tokens(text: Column) -> Column:
    """CJK texts by characters over 1.5, others by words times 1.3, plus one."""
    cjk = F.floor(F.length(text) / F.lit(1.5)) + 1
    words = F.floor(F.size(F.filter(F.split(text, f"{WS}+"), lambda w: w != "")) * F.lit(1.3)) + 1
    return F.when(text.rlike(r"[\x{4e00}-\x{9fff}]"), cjk).otherwise(words).cast("long")


def occurrences(text: Column, part: Column) -> Column:
    """How often part stands in text without overlap."""
    return F.when(part == "", 0).otherwise((F.length(text) - F.length(F.replace(text, part))) / F.length(part)).cast("long")
