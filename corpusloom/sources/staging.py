"""Stage tables in the folder that all executors share.

A long chain of stages is cut where a stage is written and read back: plans stay
small, and a lost executor costs a re-read instead of the whole chain.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Paths written and not yet removed, with their session and the thread that wrote them.
_written: dict[str, tuple[SparkSession, int]] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only a local session may lack it, and then gets one of its own: executors elsewhere could not see it."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="corpusloom-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, removed when the driver process ends if not before."""
    path = f"{shared_root(spark)}/corpusloom/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_remove_all)
    _written[path] = (spark, threading.get_ident())
    return path


def _remove(path: str) -> None:
    spark, _ = _written.pop(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _remove_all() -> None:
    for path in list(_written):
        try:
            _remove(path)
        except Exception:  # the session has already ended; the folder's owner cleans it
            return


def release(df: DataFrame) -> None:
    """Delete a stage table that no later step reads; df must come from materialize, and nothing derived from it may be run again."""
    path = getattr(df, "_stage_path", None)
    if path in _written:
        _remove(path)


@contextmanager
def scratch(*keep: str) -> Iterator[None]:
    """Stage tables that this thread writes inside are deleted at the end, failed or not, but for those whose label begins with a word of keep. For callers that have used up a query's rows."""
    before = set(_written)
    try:
        yield
    finally:
        for path in [p for p, (_, thread) in _written.items() if p not in before and thread == threading.get_ident()]:
            if not path.rpartition("/")[2].startswith(tuple(f"{label}-" for label in keep)):
                _remove(path)


def materialize(df: DataFrame, label: str, compact: bool = False, tiny: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back under the same schema.

    compact: for narrow tables; no more files than the cluster has cores. tiny:
    for tables of a row a source or a query; one file.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if compact or tiny:
        df = df.coalesce(1 if tiny else max(1, spark.sparkContext.defaultParallelism))
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stage_path = path
    return back


def bucketed(df: DataFrame, column: str, label: str) -> DataFrame:
    """Like materialize, in as many buckets of a column as a shuffle has partitions: joins on it don't move the table.

    Bucketed files are read through the session's catalog, where the table is an external one.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    name = f"{label.replace('-', '_')}_{path.rpartition('-')[2]}"
    df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", path).saveAsTable(name)
    back = spark.table(name)
    back._stage_path = path
    return back


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster without that path, submit the package with --py-files.
    """
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
