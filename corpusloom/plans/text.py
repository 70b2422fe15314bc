"""Queries over single texts: cleaning, titles, names, tokens, hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import keywords as K
from corpusloom.functions import text as X
from corpusloom.plans.registry import query
from corpusloom.sources.corpus import raw_markdown, table

WS_SQL = r"[ \t\n\x0B\f\r\x{85}\x{a0}\x{3000}]"


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '\A{WS_SQL}+|{WS_SQL}+\z', '', 'g')"


def squeeze_sql(x: str) -> str:
    return strip_sql(rf"regexp_replace({x}, '{WS_SQL}+', ' ', 'g')")


RAW_SQL = r"""raw AS (SELECT doc_id, text, '---' || chr(10) || 'title: "第' || (doc_id + 1) || '章 ' || substr(text, 1, 20) || '"' || chr(10) || 'order: ' || (doc_id + 1) || chr(10) || 'char_count: 0' || chr(10) || '---' || chr(10) || chr(10) || '# 第' || (doc_id + 1) || '章 ' || lang || chr(10)
  || chr(9) || replace(text, '. ', '.' || chr(10) || chr(10) || chr(10) || ' ') AS raw FROM documents)"""

CLEAN_LINES_SQL = r"array_to_string(list_filter(list_transform(string_split({0}, chr(10)), lambda s: regexp_replace(regexp_replace(s, '\A[ \t]+|[ \t]+\z', '', 'g'), '[ \t]+', ' ', 'g')), lambda s: s <> ''), chr(10) || chr(10))"


@query(
    "SELECT doc_id, "
    + CLEAN_LINES_SQL.format(r"translate(regexp_replace(text || chr(8203) || chr(1), '[\x{200b}\x{feff}\x{a0}\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), ',?!:;', '，？！：；')")
    + " AS cleaned, len(text)::BIGINT AS before_chars FROM documents"
)
def x01_x03_plain_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 invisible characters, X2 full-width punctuation, X3 line cleaning, F4 for plain text."""
    docs = table(spark, sf_dir, "documents")
    dirty = F.concat("text", F.lit("​\x01"))
    return docs.select("doc_id", X.clean_body(X.full_width_punctuation(X.remove_invisible(dirty))).alias("cleaned"), F.length("text").cast("long").alias("before_chars"))


@query(
    f"WITH {RAW_SQL}, "
    + r"""p AS (SELECT doc_id, regexp_extract(raw, '(?s)\A(---\n.*?\n---)(\n*)', 1) AS fm, regexp_replace(raw, '(?s)\A(---\n.*?\n---)(\n*)', '') AS rest FROM raw),
t AS (SELECT *, regexp_replace(regexp_extract(rest, '\A(?:[ \t\r\f\x0B]*\n)*(# [^\n]*)', 1), '[ \t]+\z', '') AS title FROM p),
b AS (SELECT *, CASE WHEN title <> '' THEN regexp_replace(rest, '\A(?:[ \t\r\f\x0B]*\n)*# [^\n]*(?:\n|\z)', '') ELSE rest END AS body FROM t),
c AS (SELECT *, """
    + CLEAN_LINES_SQL.format(r"translate(regexp_replace(body, '[\x{200b}\x{feff}\x{a0}\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), ',?!:;', '，？！：；')")
    + r""" AS cl FROM b)
SELECT doc_id, regexp_replace(fm, '(?m)^char_count:[ \t]*[^\n]*$', 'char_count: ' || len(cl)) || chr(10) || chr(10) || title || chr(10) || chr(10) || cl || chr(10) AS cleaned,
len(body)::BIGINT AS before_chars, len(cl)::BIGINT AS after_chars FROM c"""
)
def f03_f04_clean_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 decomposition, F4 cleaning pipeline, X4 rewritten character count."""
    raw = raw_markdown(table(spark, sf_dir, "documents"))
    c = raw.select("doc_id", X.clean_markdown(F.col("raw")).alias("c"))
    return c.select("doc_id", "c.cleaned", F.col("c.before_chars").cast("long").alias("before_chars"), F.col("c.after_chars").cast("long").alias("after_chars"))


@query(
    f"WITH {RAW_SQL}, "
    + r"""s AS (SELECT doc_id, raw, regexp_replace(raw, '(?s)\A---\n.*?\n---\n', '') AS content FROM raw),
n AS (SELECT doc_id, raw, """
    + strip_sql(r"regexp_replace(regexp_replace(content, '[\t\x{3000}]', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')")
    + r""" AS content FROM s),
h AS (SELECT *, regexp_extract(raw, '(?m)^title:[ \t]*[''"]?([^''"\n]+)[''"]?[ \t]*$', 1) AS t0,
  regexp_extract(raw, '(?m)^order:[ \t]*[''"]?([^''"\n]+)[''"]?[ \t]*$', 1) AS o0,
  list_filter(list_transform(list_slice(string_split(content, chr(10)), 1, 12), lambda x: """
    + strip_sql("x")
    + r"""), lambda x: starts_with(x, '#')) AS heads FROM n),
g AS (SELECT *, coalesce("""
    + strip_sql(r"regexp_replace(heads[1], '\A#+', '')")
    + """, '') AS h1, nullif("""
    + strip_sql("t0")
    + r""", '') AS fm_title FROM h)
SELECT doc_id, content, sha256(content) AS content_hash, len(content)::BIGINT AS content_length, h1, fm_title, substr(coalesce(fm_title, nullif(h1, ''), 'doc_' || doc_id), 1, 160) AS title,
coalesce(try_cast(nullif(regexp_extract(h1, '第[ \t]*([0-9]+)[ \t]*章', 1), '') AS BIGINT), try_cast(nullif(regexp_extract(fm_title, '第[ \t]*([0-9]+)[ \t]*章', 1), '') AS BIGINT), try_cast(o0 AS BIGINT)) AS chapter_num FROM g"""
)
def x05_x10_import_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 number precedence, X5-X10 content, front matter values, heading and title, X12 hash."""
    raw = raw_markdown(table(spark, sf_dir, "documents"))
    fields = raw.select("doc_id", "raw", X.normalize_text(X.strip_front_matter(F.col("raw"))).alias("content"), X.front_matter_value(F.col("raw"), "title").alias("fm_title"), X.front_matter_value(F.col("raw"), "order").alias("order"))
    fields = fields.withColumn("h1", X.h1_title(F.col("content")))
    title = F.coalesce("fm_title", F.nullif(F.col("h1"), F.lit("")), F.concat(F.lit("doc_"), "doc_id"))
    number = F.coalesce(X.chapter_number(F.col("h1")), X.chapter_number(F.col("fm_title")), F.col("order").try_cast("long"))
    return fields.select("doc_id", "content", X.sha256(F.col("content")).alias("content_hash"), F.length("content").cast("long").alias("content_length"), "h1", "fm_title", F.substring(title, 1, 160).alias("title"), number.alias("chapter_num"))


TITLE_SQL = r"len({0}) > 0 AND len({0}) <= 90 AND regexp_matches({1}, '\A{W}*(?:第{W}*{N}{W}*章|(?:序章|楔子|引子|后记|尾声)|番外(?:{W}*{N})?)(?:{W}+[^ \t\n].{{0,80}}|{W}*)\z')".replace("{W}", WS_SQL).replace("{N}", "(?:[0-9０-９]+|[零〇一二两三四五六七八九十百千万]+)").replace("{{", "{").replace("}}", "}")
SPLIT_SQL = r"""lines AS (SELECT doc_id, unnest(list_transform(flatten(list_transform(string_split(text, chr(10)), lambda s, i: CASE WHEN i % 5 = 1 THEN ['第' || i || '章 起', s] WHEN i % 5 = 3 THEN ['番外 ' || s] ELSE [s] END)), lambda s, i: {'i': i, 's': s})) AS l FROM documents),
flagged AS (SELECT doc_id, l.i AS i, l.s AS s, (""" + TITLE_SQL.replace("{0}", strip_sql("l.s")).replace("{1}", "l.s") + r""") AS is_title FROM lines),
numbered AS (SELECT *, sum(is_title::INT) OVER (PARTITION BY doc_id ORDER BY i) AS chapter FROM flagged)"""


@query(
    f"WITH {SPLIT_SQL}, " + r"""g AS (SELECT doc_id, chapter::BIGINT AS chapter_order, max(CASE WHEN is_title THEN """ + strip_sql("s") + r""" END) AS title, string_agg(CASE WHEN NOT is_title THEN s END, chr(10) ORDER BY i) AS body FROM numbered WHERE chapter > 0 GROUP BY doc_id, chapter)
SELECT doc_id, chapter_order, title, len(""" + strip_sql("coalesce(body, '')") + r""")::BIGINT AS char_count, md5(""" + strip_sql("coalesce(body, '')") + ") AS md5 FROM g"
)
def f01_f02_split_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 title predicate, F2 document split at title lines: the flags' running sum numbers the chapters."""
    from pyspark.sql import Window

    heads = lambda s, i: F.when(i % 5 == 0, F.array(F.concat(F.lit("第"), (i + 1).cast("string"), F.lit("章 起")), s)).when(i % 5 == 2, F.array(F.concat(F.lit("番外 "), s))).otherwise(F.array(s))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.flatten(F.transform(F.split("text", "\n", -1), heads))).alias("i", "s"))
    lines = docs.withColumn("is_title", X.is_chapter_title(F.col("s")))
    order = Window.partitionBy("doc_id").orderBy("i")
    lines = lines.withColumn("chapter_order", F.sum(F.col("is_title").cast("long")).over(order)).filter("chapter_order > 0")
    g = lines.groupBy("doc_id", "chapter_order").agg(F.max(F.when(F.col("is_title"), X.strip(F.col("s")))).alias("title"), F.array_sort(F.collect_list(F.when(~F.col("is_title"), F.struct("i", "s")))).alias("body"))
    body = X.strip(F.array_join(F.col("body.s"), "\n"))
    return g.select("doc_id", "chapter_order", "title", F.length(body).cast("long").alias("char_count"), F.md5(body).alias("md5"))


NAME_SQL = rf"""n AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace({strip_sql("text || ' <a|b>?  '")}, '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), '{WS_SQL}+', '_', 'g'), '\A[ ._]+|[ ._]+\z', '', 'g') AS name, text, lang FROM documents)"""


@query(
    f"WITH {NAME_SQL} " + r"""SELECT doc_id, regexp_replace(substr(CASE WHEN name = '' THEN 'untitled' ELSE name END, 1, 80), '[ ._]+\z', '') AS filename,
'"' || replace(replace(lang || '\"x', '\', '\\'), '"', '\"') || '"' AS quoted, 'ver_' || sha256(text) AS version_id, md5(text) AS md5,
'evt_' || substr(sha256(concat_ws('|', doc_id::VARCHAR, lang, 'None')), 1, 16) AS stable_id FROM n"""
)
def x11_x14_names_and_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11 file names and quoting, X12 digests, X14 stable ids."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", X.safe_filename(F.concat("text", F.lit(" <a|b>?  "))).alias("filename"), X.yaml_quote(F.concat("lang", F.lit('\\"x'))).alias("quoted"),
        F.concat(F.lit("ver_"), X.sha256(F.col("text"))).alias("version_id"), F.md5("text").alias("md5"), X.stable_id("evt", F.col("doc_id"), F.col("lang"), F.lit(None)).alias("stable_id"),
    )


@query(
    "WITH t AS (SELECT doc_id, " + squeeze_sql("'第12章 ' || split_part(text, chr(10), 1) || ' 灰界 the　x'") + r""" AS norm FROM documents),
c AS (SELECT doc_id, norm, list_distinct(list_concat(list_filter(['the', '灰界', 'der'], lambda x: instr(norm, x) > 0), regexp_extract_all(norm, '[\x{4e00}-\x{9fff}A-Za-z0-9]+'))) AS toks FROM t),
f AS (SELECT doc_id, norm, list_filter(toks, lambda x: NOT list_contains(['的', '了', '和', '与', '在', '是', '一个', '一种', '之', '其', '这', '那', '第', '章', '卷', '篇'], x) AND NOT regexp_matches(x, '\A第?[0-9]+章?\z') AND (len(x) > 1)) AS toks FROM c)
SELECT doc_id, norm AS title_norm, array_to_string(list_transform(list_sort(list_transform(toks, lambda x: {'p': instr(norm, x), 't': x})), lambda s: s.t), '|') AS tokens, regexp_matches(norm, '\A[^\p{L}\p{N}]+\z') AS only_punctuation FROM f"""
)
def x15_x16_title_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X15 title normalisation and punctuation test, X16 tokens by position, O4 ordered distinct; a text's title is its first line."""
    docs = table(spark, sf_dir, "documents")
    title = F.concat(F.lit("第12章 "), F.substring_index("text", "\n", 1), F.lit(" 灰界 the　x"))
    norm = K.normalize_title(title)
    return docs.select("doc_id", norm.alias("title_norm"), F.array_join(K.tokenize_title(title, ["the", "灰界", "der"]), "|").alias("tokens"), K.is_punctuation_only(norm).alias("only_punctuation"))


ANSWER_SQL = "'根据召回证据，当前小样本中可确认的信息是：' || replace(text, '. ', '；') || '；证据不足 here。evidence_refs: [E1]'"
FACTS_SQL = "list_filter(list_transform(regexp_split_to_array(replace(split_part(" + ANSWER_SQL + r", 'evidence_refs:', 1), '根据召回证据，当前小样本中可确认的信息是：', ''), '[。；;\n]+'), lambda p: " + squeeze_sql("p") + "), lambda p: p <> '' AND NOT regexp_matches(p, '证据不足|不能确认|无法确认'))"


@query(
    r"""SELECT doc_id, substr(""" + squeeze_sql("text") + r""", 1, 120) AS snippet, (CASE WHEN regexp_matches(text, '[\x{4e00}-\x{9fff}]') THEN floor(len(text) / 1.5::DOUBLE) ELSE floor(len(list_filter(regexp_split_to_array(text, '""" + WS_SQL + r"""+'), lambda w: w <> '')) * 1.3::DOUBLE) END + 1)::BIGINT AS tokens,
array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9_]{2,}'), lambda w: lower(w)))), ' ') AS keywords FROM documents"""
)
def x18_x30_snippets_tokens_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X18 snippets, X28 token estimates, X30 keyword sets."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.snippet(F.col("text")).alias("snippet"), X.estimate_tokens(F.col("text")).alias("tokens"), F.array_join(K.keyword_set(F.col("text")), " ").alias("keywords"))


@query(
    "WITH f AS (SELECT doc_id, " + FACTS_SQL + """ AS fs FROM documents),
u AS (SELECT doc_id, unnest(list_transform(fs, lambda s, i: {'i': i, 's': s})) AS x FROM f),
d AS (SELECT doc_id, x.s AS fact, min(x.i) AS i FROM u GROUP BY doc_id, x.s)
SELECT doc_id, fact, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS fact_rank FROM d"""
)
def x29_fact_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X29 facts of an answer, O4 first occurrences kept in order."""
    docs = table(spark, sf_dir, "documents")
    answer = F.concat(F.lit(K.ANSWER_OPENING), F.replace("text", F.lit(". "), F.lit("；")), F.lit("；证据不足 here。evidence_refs: [E1]"))
    return docs.select("doc_id", F.posexplode(K.split_facts(answer)).alias("i", "fact")).select("doc_id", "fact", (F.col("i") + 1).cast("long").alias("fact_rank"))


@query(
    """SELECT doc_id, (len(text) - len(replace(text, 'the', ''))) // 3 AS n, round(least(1.0, 0.25 + ((len(text) - len(replace(text, 'the', ''))) // 3) / 3.0::DOUBLE), 6) AS keyword_score, instr(text, 'the')::BIGINT - 1 AS first_at,
round(1.0 / (1.0 + abs(len(text) - 1000)::DOUBLE), 6) AS distance_score FROM documents WHERE contains(text, 'the')"""
)
def x19_x20_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X19 occurrences and keyword score, X20 distance score, F12 containment."""
    docs = table(spark, sf_dir, "documents").filter(F.col("text").contains("the"))
    n = X.occurrences(F.col("text"), F.lit("the"))
    return docs.select("doc_id", n.alias("n"), F.round(F.least(F.lit(1.0), 0.25 + n / F.lit(3.0)), 6).alias("keyword_score"), (F.instr("text", "the") - 1).cast("long").alias("first_at"), F.round(1.0 / (1.0 + F.abs(F.length("text") - 1000)), 6).alias("distance_score"))
