"""Incremental versioned upserts from a stream of chapter deliveries, as a log of changed rows.

A batch adds only the rows that it changes, and of each version the row of the last
batch counts. A batch that runs again replaces its own part of the log alone. A new
checkpoint goes on with the state it finds.

Every ``fold_every`` batches the log is folded into a base, and at the start of a
run. Base and log are partitioned by buckets of the key, and a batch reads only the
buckets of its keys, from the last base and the log after it: what it reads does not
grow with the number of batches. A base counts from when its mark is written, after
the base itself; one that was cut short is written anew. Parts that are older than the
base before the last are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.versioning import upsert
from corpusloom.sources.files import exists, names, remove

SCHEMA = "chapter_id string, chapter_num long, version_id string, content_hash string, is_current int"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_LOG = f"{SCHEMA}, run int, batch long, bucket int"
BUCKETS, FOLD_EVERY = 64, 16
#: A run and a batch of it.
Label = tuple[int, int]


def latest_delivery(batch: DataFrame, key: str = "chapter_id") -> DataFrame:
    """Of several deliveries of a key in one batch the last by order."""
    columns = [c for c in batch.columns if c != key]
    return batch.groupBy(key).agg(F.max_by(F.struct(*columns), "source_order").alias("r")).select(key, "r.*").drop("source_order")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_LOG).parquet(path) if exists(spark, path) else spark.createDataFrame([], _LOG)


def _bases(path: str) -> tuple[str, str]:
    """Where the bases of a log are, and their marks."""
    return f"{path.rstrip('/')}-base", f"{path.rstrip('/')}-marks"


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _folded(log: DataFrame, key: str) -> DataFrame:
    rest = [c for c in log.columns if c not in (key, "version_id", "run", "batch", "bucket")]
    last = log.groupBy(key, "version_id").agg(F.max_by(F.struct(*rest), F.struct("run", "batch")).alias("r"))
    return last.select(key, "version_id", "r.*")


def _marked(spark: SparkSession, path: str, before: Label | None = None) -> list[Label]:
    """Labels of the finished bases, in order; a row for each few batches."""
    marks = _bases(path)[1]
    if not exists(spark, marks):
        return []
    found = sorted({(r["run"], r["batch"]) for r in spark.read.schema("run int, batch long").parquet(marks).collect()})
    return [x for x in found if before is None or x < before]


def earlier_rows(spark: SparkSession, path: str, before: Label | None = None, buckets: list[int] | None = None) -> DataFrame:
    """What the last base and the log after it hold from before a label, of some buckets or all; only the partitions needed are read."""
    at = lambda x: F.struct(F.lit(x[0]).cast("int").alias("run"), F.lit(x[1]).cast("long").alias("batch"))
    here, based = F.struct("run", "batch"), _marked(spark, path, before)
    log = _stored(spark, path)
    if before is not None:
        log = log.filter(here < at(before))
    if based:
        log = log.filter(here > at(based[-1])).unionByName(_stored(spark, _bases(path)[0]).filter((F.col("run") == based[-1][0]) & (F.col("batch") == based[-1][1])))
    return log if buckets is None else log.filter(F.col("bucket").isin(buckets))


def state(spark: SparkSession, path: str, key: str = "chapter_id") -> DataFrame:
    """All versions as base and log leave them."""
    return _folded(earlier_rows(spark, path), key)


def compact(spark: SparkSession, path: str, before: Label, key: str) -> None:
    """Fold everything from before a label into a base, mark it, and remove what is older than the base before it."""
    base, marks = _bases(path)
    label = (before[0], before[1] - 1)
    folded = _folded(earlier_rows(spark, path, before), key).withColumn("bucket", bucket_of(key))
    folded.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/run={label[0]}/batch={label[1]}")
    spark.createDataFrame([label], "run int, batch long").coalesce(1).write.mode("append").parquet(marks)
    older = _marked(spark, path, label)
    if older:
        for root, last in ((path, older[-1]), (base, (older[-1][0], older[-1][1] - 1))):
            for part in _parts(spark, root):
                if part <= last:
                    remove(spark, f"{root}/run={part[0]}/batch={part[1]}")


def _parts(spark: SparkSession, root: str) -> list[Label]:
    number = lambda name: int(name.rpartition("=")[2])
    return [(number(run), number(batch)) for run in names(spark, root) if run.startswith("run=") for batch in names(spark, f"{root}/{run}") if batch.startswith("batch=")]


def _run_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The run that a checkpoint stands for: kept beside it, the next free one for a new checkpoint."""
    mark = f"{checkpoint.rstrip('/')}/log-run"
    if exists(spark, mark):
        return int(spark.read.text(mark).first()[0])
    run = max([0, *(r for r, _ in [*_parts(spark, path), *_marked(spark, path)])]) + 1
    spark.createDataFrame([(str(run),)], "value string").coalesce(1).write.text(mark)
    return run


def apply_batches(stream: DataFrame, path: str, checkpoint: str, key: str = "chapter_id", fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Fold each micro-batch into the log under path, reading only the versions of the keys that it holds.

    stream: key, chapter_num, version_id, content_hash and source_order.
    """
    spark = stream.sparkSession
    run = _run_number(spark, path, checkpoint)

    def fold(batch: DataFrame, number: int) -> None:
        now = (run, number)
        based = _marked(spark, path, now)
        since = number - 1 - (based[-1][1] if based and based[-1][0] == run else -1)
        if since >= fold_every or number == 0 and run > 1 and (run, -1) not in based:
            compact(spark, path, now, key)
        incoming = latest_delivery(batch, key)
        met = [r[0] for r in incoming.select(bucket_of(key)).distinct().collect()]  # at most a row a bucket
        before = _folded(earlier_rows(spark, path, now, met).join(incoming.select(key), key, "left_semi"), key).select(_COLUMNS)
        changed = upsert(before, incoming, key).filter(F.col("action").isin("inserted", "new_version")).drop("action")
        changed.withColumn("bucket", bucket_of(key)).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/run={run}/batch={number}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
