"""Connected components over an edge table by alternating star contraction.

Each round keeps one edge table in the shared folder. Minima are pre-aggregated
before their shuffle, joins on a hub's key are split by adaptive execution, and
nothing is gathered on the driver but a row count and a checksum. A round's table
goes as soon as the next one is written. Rounds grow with the logarithm of the
vertices; sixty are enough for any table, and more are an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.storage import materialize, release


def star_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: longs u, v in any order. Returns (v, root) for every vertex but the roots; root is the least of its component."""

    def settle(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = materialize(df, "edges", compact=True)
        return df, df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    stars, mark = settle(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(most_rounds):
        # every vertex learns the least of its neighbourhood; larger neighbours move there
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # then the smaller neighbours of each vertex meet at the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
        old, (stars, now) = stars, settle(small)
        release(old)
        if now == mark:
            return stars.select(F.col("u").alias("v"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
