"""Keyword, title and vector recall over segments, and their fusion.

A query set is the caller's: its texts are found by one pass over each segment and
joined on equality. Top-k windows filter on row_number, which Spark limits in each task before it shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.terms import distinct_terms, term_starts
from corpusloom.functions.text import let, sha256, squeeze
from corpusloom.sources.staging import materialize

WEIGHTS = (0.35, 0.30, 0.35)
DIMENSIONS = 16
#: The usual BM25 constants.
K1, B = 1.2, 0.75


#: Texts that a query table holds at most, so that its broadcast is bounded.
MOST_QUERIES = 100_000


def query_table(spark: SparkSession, texts: list[str]) -> DataFrame:
    if len(texts) > MOST_QUERIES:
        raise ValueError(f"a query table holds at most {MOST_QUERIES} texts; deal more out in parts")
    rows = [(f"q{i:03d}", " ".join(t.split())) for i, t in enumerate(texts, 1)]
    return F.broadcast(spark.createDataFrame(rows, "query_id string, query_text string"))


def top(df: DataFrame, k: int, by: list[str], *order: Column, rank: str = "place") -> DataFrame:
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).filter(F.col(rank) <= k)


def keyword_recall(segments: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Segments that contain the query text, by score, occurrences, length and id."""
    found = segments.withColumn("length", F.length("segment_text")).withColumn("found", F.explode(term_starts(F.col("segment_text"), distinct_terms(queries, "query_text"))))
    hits = found.join(queries, F.col("found.term") == F.col("query_text")).withColumn("n", F.size("found.starts").cast("long"))
    hits = hits.withColumn("keyword_score", F.round(F.least(F.lit(1.0), 0.25 + F.col("n") / F.lit(3.0)), 6))
    hits = hits.select("query_id", "child_segment_id", "chapter_num", "scene_key", "n", "keyword_score", "length")
    return top(hits, k, ["query_id"], F.desc("keyword_score"), F.desc("n"), F.asc("length"), F.asc("child_segment_id"))


def title_tokens(title: Column) -> Column:
    return F.regexp_extract_all(F.lower(title), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def title_recall(titles: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """titles: chapter_num, title. Phrase hits ranked by BM25 where a query has any, else containment hits.

    A phrase counts as one term. The corpus' sizes are one row on the driver.
    """
    spaced = lambda tokens: F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    t = titles.withColumn("tokens", title_tokens(F.col("title"))).withColumns({"flat": spaced(F.col("tokens")), "size": F.size("tokens")})
    corpus = t.agg(F.count(F.lit(1)).alias("docs"), F.avg("size").alias("mean_size")).first()
    docs, mean_size = F.lit(corpus["docs"]), F.lit(corpus["mean_size"] or 1.0)
    # neighbours share a space, so the phrase is counted with the spaces doubled
    doubled = lambda c: F.replace(c, F.lit(" "), F.lit("  "))
    q = queries.withColumn("phrase", doubled(spaced(title_tokens(F.col("query_text"))))).filter(F.trim("phrase") != "")
    found = t.withColumn("found", F.explode(term_starts(doubled(F.col("flat")), distinct_terms(q, "phrase"))))
    found = found.join(q, F.col("found.term") == F.col("phrase")).withColumn("f", F.size("found.starts"))
    frequency = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("df"))  # a row a query
    ranked = found.join(frequency, "query_id")
    idf = F.greatest(F.log((docs - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    bm25 = idf * F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("size") / mean_size))
    phrase_hits = ranked.select("query_id", "chapter_num", F.round(1 / (1 + F.abs(bm25)), 6).alias("title_score"), F.lit("fts").alias("tier"))
    other = queries.join(frequency, "query_id", "left_anti")
    like = titles.withColumn("found", F.explode(term_starts(F.col("title"), distinct_terms(queries, "query_text")))).join(other, F.col("found.term") == F.col("query_text"))
    score = F.when(F.col("title") == F.col("query_text"), 1.0).when(F.array_contains(title_tokens(F.col("title")), F.lower("query_text")), 0.9).otherwise(0.8)
    like_hits = like.select("query_id", "chapter_num", score.alias("title_score"), F.lit("like").alias("tier"))
    return top(phrase_hits.unionByName(like_hits), k, ["query_id"], F.desc("title_score"), F.asc("chapter_num"))


def title_segments(hits: DataFrame, segments: DataFrame, k: int) -> DataFrame:
    """The first k segments of each chapter whose title was hit, with the title's score."""
    s = segments.select("chapter_num", "scene_key", "scene_index", "segment_index", "child_segment_id")
    joined = s.join(F.broadcast(hits.select("query_id", "chapter_num", "title_score")), "chapter_num")  # at most k rows a query
    return top(joined, k, ["query_id", "chapter_num"], F.asc("scene_index"), F.asc("segment_index"), rank="segment_place")


def hash_embedding(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """A unit vector from the text's digests, for tests without a model."""
    digests = [sha256(F.concat(F.lit(f"{n}:"), text)) for n in range(-(-dimensions // 8))]
    parts = F.array(*(F.substring(d, 8 * i + 1, 8) for d in digests for i in range(8)))
    raw = F.transform(F.slice(parts, 1, dimensions), lambda p: F.round(F.conv(p, 16, 10).cast("double") / 4294967295.0 * 2.0 - 1.0, 6))
    return let(raw, lambda v: let(F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)), lambda n: F.transform(v, lambda x: F.round(x / F.when(n == 0, 1.0).otherwise(n), 6))))


def model_embedding(text: Column, model: str) -> Column:
    """Unit vectors of an installed sentence encoder, loaded once in each Python worker. Without the package this is an error at once."""
    try:
        import sentence_transformers  # noqa: F401
    except ImportError as e:
        raise ImportError("model embeddings need the sentence-transformers package; hash_embedding needs none") from e
    import pandas as pd

    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from sentence_transformers import SentenceTransformer

        encoder = SentenceTransformer(model)
        for part in parts:
            yield pd.Series([v.tolist() for v in encoder.encode(part.fillna("").tolist(), normalize_embeddings=True)])

    encode.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(encode, "array<float>")(text)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def vector_recall(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """vectors: child_segment_id, embedding and columns to keep; queries: query_id, query_vector. Exact nearest by squared distance."""
    d = vectors.join(F.broadcast(queries), F.lit(True)).withColumn("distance", F.round(squared_distance(F.col("embedding"), F.col("query_vector")), 6))
    d = d.withColumn("vector_score", F.round(1 / (1 + F.abs("distance")), 6)).drop("embedding", "query_vector")
    return top(d, k, ["query_id"], F.asc("distance"), F.asc("child_segment_id"))


class Cells:
    """Vectors by their nearest pivot, each with its distance to it, and what is known of each cell.

    Pivots are a bounded sample, picked by a hash of the ids: at most ``most``
    vectors reach the driver, and a row a cell of sizes and radii. Cells of more than
    ``rows`` vectors are met in slices. Of equal vectors only the ``copies`` of the
    least ids are kept: no search for fewer needs another.
    """

    def __init__(self, vectors: DataFrame, copies: int, rows: int, most: int):
        import numpy as np

        self.kind, self.rows = vectors.schema["vec_id"].dataType, rows
        place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
        kept = materialize(vectors.select("vec_id", "embedding", place.alias("place")).filter(F.col("place") <= copies).drop("place"), "vectors")
        n = kept.count()
        chosen = kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, min(most, n // rows + 1))).collect()
        if len({len(r["embedding"]) for r in chosen}) > 1:
            raise ValueError("embeddings differ in length")
        self.pivots = np.array([r["embedding"] for r in chosen])
        pivots = self.pivots

        def assign(batches):
            import pyarrow as pa

            for batch in batches:
                x = unpacked(batch.column("embedding"), pivots.shape[1])
                cell = pivot_distances(x, pivots).argmin(axis=1)
                reach = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
                yield pa.record_batch([pa.array(cell, pa.int32()), pa.array(reach, pa.float64()), batch.column("vec_id"), batch.column("embedding")], ["cell", "reach", "vec_id", "embedding"])

        schema = f"cell int, reach double, vec_id {self.kind.simpleString()}, embedding array<double>"
        self.table = materialize(kept.mapInArrow(assign, schema), "cells") if n else None
        known = self.table.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).collect() if n else []
        self.size, self.radius = np.zeros(len(self.pivots), np.int64), np.zeros(len(self.pivots))
        for r in known:
            self.size[r["cell"]], self.radius[r["cell"]] = r["n"], r["radius"]


def unpacked(column, length: int):
    """An Arrow column of lists as a matrix."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != length).any():
        raise ValueError("embeddings differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), length)


def pivot_distances(x, pivots):
    import numpy as np

    return np.sqrt(np.maximum(0, (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * (x @ pivots.T)))


#: What rounding may add to a distance; nothing nearer to a bound than this is pruned.
SLACK = 1e-5


def visits(cells: Cells, queries: DataFrame, k: int, known: DataFrame | None = None) -> DataFrame:
    """The cells that each query must look into: cell, vec_id, embedding, away (to the pivot) and tau.

    Without known: the nearest cells that hold k + 1 vectors together. known: vec_id
    and tau, the k-th least distance so far; then the other cells that the
    triangle inequality does not rule out.
    """
    size, radius, pivots, bounded = cells.size, cells.radius, cells.pivots, known is not None
    rows = queries.select("vec_id", "embedding", F.lit(float("inf")).alias("tau")) if known is None else queries.select("vec_id", "embedding").join(known, "vec_id", "left").select("vec_id", "embedding", F.coalesce("tau", F.lit(float("inf"))).alias("tau"))

    def find(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            away = pivot_distances(unpacked(batch.column("embedding"), pivots.shape[1]), pivots)
            order = np.argsort(away, axis=1, kind="stable")
            first = np.zeros(away.shape, bool)
            held = np.cumsum(size[order], axis=1) - size[order]
            np.put_along_axis(first, order, held <= k, axis=1)
            first &= size > 0
            tau = batch.column("tau").to_numpy(zero_copy_only=False)
            chosen = first if not bounded else ~first & (size > 0) & (away - radius <= tau[:, None] + SLACK)
            row, cell = np.nonzero(chosen)
            for at in range(0, len(row), 10_000):
                r, c = row[at : at + 10_000], cell[at : at + 10_000]
                taken = batch.take(pa.array(r))
                yield pa.record_batch([pa.array(c, pa.int32()), taken.column("vec_id"), taken.column("embedding"), pa.array(away[r, c]), taken.column("tau")], ["cell", "vec_id", "embedding", "away", "tau"])

    return rows.mapInArrow(find, f"cell int, vec_id {cells.kind.simpleString()}, embedding array<double>, away double, tau double")


def search_cells(cells: Cells, asked: DataFrame, k: int, block: int) -> DataFrame:
    """The k nearest others of each query in each cell that it looks into: query_id, vec_id, distance. A task holds a slice of a cell and about block queries."""
    spark = asked.sparkSession
    turns = asked.groupBy("cell").agg(F.count(F.lit(1)).alias("asked")).collect()  # a row a cell
    shape = spark.createDataFrame([(r["cell"], -(-int(cells.size[r["cell"]]) // cells.rows), -(-r["asked"] // block)) for r in turns], "cell int, slices int, turns int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    part = lambda c: F.pmod(F.xxhash64("vec_id"), F.col(c)).cast("int")
    v = cells.table.join(F.broadcast(shape), "cell").select("cell", "reach", "vec_id", "embedding", part("slices").alias("slice"), each("turns").alias("turn"))
    q = asked.join(F.broadcast(shape), "cell").select("cell", "away", "tau", "vec_id", "embedding", part("turns").alias("turn"), each("slices").alias("slice"))
    length = cells.pivots.shape[1]

    def search(left, right):
        import numpy as np
        import pyarrow as pa

        out = ([], [], [])
        if left.num_rows and right.num_rows:
            ids, reach, x = left.column("vec_id").to_numpy(), left.column("reach").to_numpy(), unpacked(left.column("embedding").combine_chunks(), length)
            order = np.argsort(reach, kind="stable")
            ids, reach, x = ids[order], reach[order], np.ascontiguousarray(x[order].T)
            queries = zip(right.column("vec_id").to_numpy(), right.column("away").to_numpy(), right.column("tau").to_numpy(), unpacked(right.column("embedding").combine_chunks(), length), strict=True)
            for query_id, away, tau, query in queries:
                # a vector further from or nearer to the pivot than this is too far from the query
                low, high = np.searchsorted(reach, (away - tau - SLACK, away + tau + SLACK))
                d = np.zeros(high - low)
                for column, value in zip(x, query, strict=True):  # summed in order, as SQL sums
                    d += (column[low:high] - value) ** 2
                near_ids = ids[low:high]
                d = np.where(near_ids == query_id, np.inf, np.floor(d * 1e6 + 0.5) / 1e6)
                near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
                near = near[np.lexsort((near_ids[near], d[near]))][:k]
                near = near[np.isfinite(d[near])]
                out[0].append(np.full(len(near), query_id)), out[1].append(near_ids[near]), out[2].append(d[near])
        columns = [np.concatenate(c) if c else np.array([], t) for c, t in zip(out, (np.int64, np.int64, np.float64), strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "distance"), columns, strict=True)))

    keys = ["cell", "slice", "turn"]
    best = v.groupBy(*keys).cogroup(q.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, distance double")
    return top(best, k, ["query_id"], F.asc("distance"), F.asc("vec_id"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, rows: int = 1024, block: int = 4096, most: int = 2048) -> DataFrame:
    """Both: vec_id, embedding of doubles, all of one length and none null. The k exact nearest others of each query by squared distance, then by id.

    Each query looks into the nearest cells first. Its k-th least distance there
    bounds it, and of the other cells it meets only those, and in those only the
    vectors, that the triangle inequality leaves. Equal vectors beyond the first
    k + 1 ids are never met.
    """
    cells = Cells(vectors, k + 1, rows, most)
    if cells.table is None:
        return queries.sparkSession.createDataFrame([], "query_id long, vec_id long, distance double, place int")
    first = materialize(search_cells(cells, visits(cells, queries, k), k, block), "first-cells")
    # distances are squared and rounded, bounds are neither
    tau = first.filter(F.col("place") == k).select(F.col("query_id").alias("vec_id"), F.sqrt(F.col("distance") + 1e-6).alias("tau"))
    more = materialize(visits(cells, queries, k, tau), "visits")
    both = first.drop("place").unionByName(search_cells(cells, more, k, block).drop("place"))
    return top(both, k, ["query_id"], F.asc("distance"), F.asc("vec_id"))


def fuse(title: DataFrame, keyword: DataFrame, vector: DataFrame, k: int, weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """One ranking a query of the three routes' hits, with the best score and the routes of each segment."""
    routes = (("sqlite_title", title, "title_score"), ("sqlite_child_keyword", keyword, "keyword_score"), ("chroma_vector", vector, "vector_score"))
    zero = F.lit(0.0)
    rows = [df.select("query_id", "child_segment_id", "chapter_num", "scene_key", *((F.col(c) if c == score else zero).alias(c) for _, _, c in routes), F.lit(name).alias("route")) for name, df, score in routes]
    union = rows[0].unionByName(rows[1]).unionByName(rows[2])
    merged = union.groupBy("query_id", "child_segment_id", "chapter_num", "scene_key").agg(*(F.max(c).alias(c) for _, _, c in routes), F.array_join(F.array_sort(F.collect_set("route")), ",").alias("recall_sources"))
    t, n, v = weights
    merged = merged.withColumn("hybrid_score", F.round(t * F.col("title_score") + n * F.col("keyword_score") + v * F.col("vector_score"), 6))
    return top(merged, k, ["query_id"], F.desc("hybrid_score"), F.asc("chapter_num"), F.asc("scene_key"), F.asc("child_segment_id"))


def overlaps_directly(query_text: Column, text: Column) -> Column:
    """The query, or a word of it with two characters or more, stands in the text."""
    tokens = F.filter(F.split(squeeze(F.translate(query_text, "，。", "  ")), " "), lambda w: F.length(w) >= 2)
    return text.contains(query_text) | F.exists(tokens, lambda w: text.contains(w))


def quality_labels(queries: DataFrame, fused: DataFrame, segments: DataFrame, keyword: DataFrame, vector: DataFrame) -> DataFrame:
    """A label for each query from its fused hits."""
    hits = fused.join(segments.select("child_segment_id", "segment_text"), "child_segment_id")
    first = F.col("place") == 1
    has = lambda name: F.array_contains(F.split("recall_sources", ","), name)
    per = hits.groupBy("query_id").agg(
        F.max(F.when(first, F.col("child_segment_id"))).alias("top1"), F.max(F.when(first, F.col("recall_sources"))).alias("top1_sources"), F.max(F.when(first, F.col("segment_text"))).alias("top1_text"),
        F.max(F.when(F.col("place") <= 3, has("sqlite_child_keyword"))).alias("keyword_in_top3"), F.count_if(F.col("place") <= 3).alias("top3_hits"), F.count_if(F.col("place") <= 5).alias("top5_hits"),
    )
    ids = lambda df, name: df.groupBy("query_id").agg(F.collect_set("child_segment_id").alias(name))  # noqa: E731  at most k a query
    all_ = queries.join(per, "query_id", "left").join(ids(keyword, "k"), "query_id", "left").join(ids(vector, "v"), "query_id", "left")
    empty = F.array().cast("array<string>")
    k, v = F.coalesce("k", empty), F.coalesce("v", empty)
    routes = F.split("top1_sources", ",")
    label = (
        F.when(F.col("top1").isNull(), "zero_hit")
        .when(F.array_contains(routes, "sqlite_child_keyword") & F.array_contains(routes, "chroma_vector"), "good")
        .when(overlaps_directly(F.col("query_text"), F.col("top1_text")), "good")
        .when(F.col("keyword_in_top3"), "good")
        .when(F.size(v) > 0, "acceptable")
        .otherwise("weak")
    )
    zero = F.lit(0).cast("long")
    return all_.select("query_id", "query_text", "top1", F.coalesce("top3_hits", zero).alias("top3_hits"), F.coalesce("top5_hits", zero).alias("top5_hits"), F.size(k).cast("long").alias("keyword_hits"), F.size(v).cast("long").alias("vector_hits"), F.size(F.array_intersect(k, v)).cast("long").alias("overlap"), label.alias("quality_label"))
