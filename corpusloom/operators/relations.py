"""Co-occurrence evidence between characters: by unit, by block interval, and within a window of characters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.intervals import bucket_of, over_buckets
from corpusloom.functions.text import sha256

UNIT = ["chapter_id", "chapter_num", "version_id"]


def nearest(a: Column, b: Column) -> Column:
    """Least distance between two sorted offset arrays, linear after one sort: neighbours of different sides decide."""
    side = lambda xs, k: F.transform(xs, lambda x: F.struct(x.alias("o"), F.lit(k).alias("k")))
    step = lambda acc, x: F.struct(F.when((acc["k"] != x["k"]) & (acc["k"] >= 0), F.least(acc["best"], x["o"] - acc["o"])).otherwise(acc["best"]).alias("best"), x["o"].alias("o"), x["k"].alias("k"))
    start = F.struct(F.lit(None).cast("long").alias("best"), F.lit(0).cast("long").alias("o"), F.lit(-1).alias("k"))
    return F.aggregate(F.array_sort(F.concat(side(a, 0), side(b, 1))), start, step, lambda acc: acc["best"])


def relation_rows(pairs: DataFrame, scope: str) -> DataFrame:
    """pairs: unit columns, optional scene, para and sentence ids, character_id_a < character_id_b, and arrays a and b of (offset, id) in order."""
    ids = lambda c: F.transform(c, lambda x: x["id"])
    listed = lambda c: F.concat(F.lit("["), F.array_join(F.transform(ids(c), lambda i: F.concat(F.lit('"'), i, F.lit('"'))), ", "), F.lit("]"))
    for c in ("scene_block_id", "para_id", "sentence_id"):
        if c not in pairs.columns:
            pairs = pairs.withColumn(c, F.lit(None).cast("string"))
    quoted = lambda c: F.coalesce(F.concat(F.lit('"'), F.col(c), F.lit('"')), F.lit("null"))
    fields = [("appearance_ids_a", listed(F.col("a"))), ("appearance_ids_b", listed(F.col("b"))), *((c, quoted(c)) for c in ("chapter_id", "character_id_a", "character_id_b")), ("evidence_scope", F.lit(f'"{scope}"')), *((c, quoted(c)) for c in ("para_id", "scene_block_id", "sentence_id", "version_id"))]
    payload = F.concat(F.lit("{"), F.concat_ws(", ", *(F.concat(F.lit(f'"{n}": '), v) for n, v in fields)), F.lit("}"))
    key = F.concat_ws("|", F.lit(scope), "chapter_id", "version_id", *(F.coalesce(c, F.lit("")) for c in ("scene_block_id", "para_id", "sentence_id")), "character_id_a", "character_id_b")
    offsets = lambda c: F.transform(c, lambda x: x["o"])
    return pairs.select(
        F.concat(F.lit("rel_"), F.substring(sha256(key), 1, 16)).alias("relation_id"), "character_id_a", "character_id_b", *UNIT, F.lit(scope).alias("evidence_scope"), "scene_block_id", "para_id", "sentence_id", listed(F.col("a")).alias("appearance_ids_a"), listed(F.col("b")).alias("appearance_ids_b"),
        F.size("a").cast("long").alias("mention_count_a"), F.size("b").cast("long").alias("mention_count_b"), nearest(offsets(F.col("a")), offsets(F.col("b"))).alias("min_distance"), sha256(payload).alias("evidence_hash"),
    )


def by_unit(found: DataFrame, scope: str, keys: list[str]) -> DataFrame:
    """Pairs of characters inside one unit: mentions are gathered by unit and character first, so the self-join meets characters and not mentions."""
    grouped = found.groupBy(*UNIT, *keys, "character_id").agg(F.array_sort(F.collect_list(F.struct(F.col("match_start").alias("o"), F.col("appearance_id").alias("id")))).alias("m"))
    on = [*UNIT, *keys]
    left = grouped.select(*on, F.col("character_id").alias("character_id_a"), F.col("m").alias("a"))
    right = grouped.select(*on, F.col("character_id").alias("character_id_b"), F.col("m").alias("b"))
    return relation_rows(left.join(right, on).filter("character_id_a < character_id_b"), scope)


def same_sentence(found: DataFrame) -> DataFrame:
    return by_unit(found, "same_sentence", ["para_id", "sentence_id"])


def same_paragraph(found: DataFrame) -> DataFrame:
    return by_unit(found, "same_paragraph", ["para_id"])


def same_chapter(found: DataFrame) -> DataFrame:
    return by_unit(found, "same_chapter", [])


def same_scene(found: DataFrame, scenes: DataFrame) -> DataFrame:
    """scenes: chapter_id, version_id, scene_key, start_offset, end_offset (half open)."""
    s = scenes.select("chapter_id", "version_id", F.col("scene_key").alias("scene_block_id"), "start_offset", "end_offset", *over_buckets(F.col("start_offset"), F.col("end_offset")))
    inside = found.withColumn("bucket", bucket_of(F.col("match_start"))).join(s, ["chapter_id", "version_id", "bucket"]).filter("match_start >= start_offset and match_start < end_offset")
    return by_unit(inside, "same_scene_block", ["scene_block_id"])


def nearby(found: DataFrame, window: int) -> DataFrame:
    """Pairs at most window characters apart; both mentions count once for every pair they are in.

    Offsets are put in buckets of the window's width and each bucket meets itself
    and the next one only.
    """
    m = found.select(*UNIT, "character_id", F.col("match_start").alias("o"), F.col("appearance_id").alias("id"), F.floor(F.col("match_start") / (window + 1)).alias("bucket"))
    left = m.select(*UNIT, F.col("character_id").alias("lc"), F.col("o").alias("lo"), F.col("id").alias("li"), F.explode(F.array("bucket", F.col("bucket") + 1)).alias("bucket"))
    right = m.select(*UNIT, F.col("character_id").alias("rc"), F.col("o").alias("ro"), F.col("id").alias("ri"), "bucket")
    pairs = left.join(right, [*UNIT, "bucket"]).filter(((F.col("ro") > F.col("lo")) | ((F.col("ro") == F.col("lo")) & (F.col("ri") > F.col("li")))) & (F.col("ro") - F.col("lo") <= window) & (F.col("lc") != F.col("rc")))
    low = F.col("lc") < F.col("rc")
    l, r = F.struct(F.col("lo").alias("o"), F.col("li").alias("id")), F.struct(F.col("ro").alias("o"), F.col("ri").alias("id"))
    both = pairs.groupBy(*UNIT, F.least("lc", "rc").alias("character_id_a"), F.greatest("lc", "rc").alias("character_id_b"))
    gathered = both.agg(F.array_sort(F.collect_list(F.when(low, l).otherwise(r))).alias("a"), F.array_sort(F.collect_list(F.when(low, r).otherwise(l))).alias("b"))
    return relation_rows(gathered, "nearby_window")
