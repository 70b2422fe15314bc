"""Points in intervals by equality: both are put in buckets of the number line, an interval in each that it meets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters a bucket: about a block's length, so that most blocks meet one or two.
WIDTH = 4096


def bucket_of(point: Column, width: int = WIDTH) -> Column:
    return F.floor(point / width)


def over_buckets(start: Column, end: Column, width: int = WIDTH) -> list[Column]:
    """A generated column ``bucket``: a row for each bucket from start to end."""
    return [F.explode(F.sequence(bucket_of(start, width), bucket_of(end, width))).alias("bucket")]
