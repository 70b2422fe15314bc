"""Rule checks as violation queries: each gives a row for each thing that is wrong, and findings are their union."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SNAKE = r"\A[a-z][a-z0-9]*+(?:_[a-z0-9]++)*+\z"


def finding(df: DataFrame, code: str, item: Column | str) -> DataFrame:
    return df.select(F.lit(code).alias("code"), (F.col(item) if isinstance(item, str) else item).cast("string").alias("item"))


def union(*parts: DataFrame) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias("__parent"))
    return child.filter(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("__parent"), "left_anti")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_required(df: DataFrame, column: str, required: list[str]) -> DataFrame:
    wanted = df.sparkSession.createDataFrame([(r,) for r in required], "required string")
    return wanted.join(df.select(F.col(column).alias("__have")), F.col("required") == F.col("__have"), "left_anti")


def not_snake(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~F.coalesce(F.col(column).rlike(SNAKE), F.lit(False)))


def bound_violations(rules: DataFrame) -> DataFrame:
    """Confidence rules with missing or crossed bounds, and deltas whose sign contradicts their name."""
    n = lambda c: F.col(c)
    bounds = F.when(n("floor").isNull() | n("ceiling").isNull(), "bounds_not_numeric").when(~((n("floor") >= 0) & (n("floor") <= n("ceiling")) & (n("ceiling") <= 1)), "bounds_invalid")
    sign = F.when(n("rule_id").contains("penalty") & (n("delta") >= 0), "penalty_not_negative").when(n("rule_id").contains("boost") & (n("delta") <= 0), "boost_not_positive")
    number = F.when(n("delta").isNull(), "delta_not_numeric")
    return rules.select("rule_id", F.explode(F.array_compact(F.array(bounds, sign, number))).alias("code")).select("code", F.col("rule_id").alias("item"))


def forbidden_matches(texts: DataFrame, text: str, patterns: list[tuple[str, str, list[str], list[str]]]) -> DataFrame:
    """texts with a row for each forbidden term that occurs: error in a blocked context, warning in an allowed one, else suspect.

    patterns: term, regular expression, blocked contexts, allowed contexts; a short list of the caller's.
    """
    t = F.col(text)

    def verdict(term: str, regex: str, blocked: list[str], allowed: list[str]) -> Column:
        within = lambda contexts: F.array_join(F.array_compact(F.array(*(F.when(t.rlike(c), c) for c in contexts), F.lit(None).cast("string"))), ", ")
        b, a = within(blocked), within(allowed)
        severity = F.when(b != "", "error").when(a != "", "warning").otherwise("suspect")
        context = F.when(b != "", b).when(a != "", a).otherwise(term or regex)
        return F.when(t.contains(term) | t.rlike(regex), F.struct(F.lit(term).alias("term"), severity.alias("severity"), context.alias("context")))

    found = F.array_compact(F.array(*(verdict(*p) for p in patterns)))
    return texts.withColumn("match", F.explode(found)).select(*[c for c in texts.columns if c != text], "match.*")


def canonical_checksum(seed: dict[str, Any]) -> str:
    """SHA-256 of a seed's canonical JSON with its own checksum left blank."""
    return hashlib.sha256(json.dumps(seed | {"seed_checksum": ""}, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode("utf-8")).hexdigest()


def file_checksum(text: str) -> str:
    """SHA-256 of a seed file's text as it stands."""
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def row_digest(columns: list[str]) -> Column:
    """The first 60 bits of the SHA-256 of a row's values, joined by bars; nulls read as None."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns))
    return F.conv(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 15), 16, 10).cast("long")


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """An order-free digest of any number of rows: count, xor and sum of row digests. Before and after a stage it tells whether a source was touched."""
    h = row_digest(list(columns or df.columns))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor"), F.coalesce(F.sum(h.cast("decimal(38,0)")).cast("string"), F.lit("0")).alias("total"))


def source_fingerprints(tables: dict[str, DataFrame], own: list[str]) -> DataFrame:
    """A fingerprint for each table but those of one's own layer. tables: what the caller has discovered, a name a table."""
    parts = [fingerprint(df).select(F.lit(name).alias("table_name"), "*") for name, df in sorted(tables.items()) if name not in own]
    if not parts:
        raise ValueError("no source tables beside the own layer")
    return union(*parts)
