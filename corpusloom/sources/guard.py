"""Read-only access by SQL: a statement is parsed, and refused before anything runs if any part of it writes or changes settings."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import JavaObject, is_instance_of
from pyspark.sql import DataFrame, SparkSession

#: Plans of statements that are no queries: commands, and parsed statements such as inserts that become commands.
_REFUSED = ("org.apache.spark.sql.catalyst.plans.logical.Command", "org.apache.spark.sql.catalyst.plans.logical.ParsedStatement")


def _nodes(plan: JavaObject) -> Iterator[JavaObject]:
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def is_query(spark: SparkSession, sql: str) -> bool:
    """Whether a statement only reads; one that can't be parsed is an error of the parser's."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    gateway = spark.sparkContext._gateway
    return not any(is_instance_of(gateway, node, kind) for node in _nodes(plan) for kind in _REFUSED)


def read_only(spark: SparkSession, sql: str) -> DataFrame:
    """The rows of a query; anything else is refused."""
    if not is_query(spark, sql):
        raise PermissionError(f"only queries may run here: {sql[:80]}")
    return spark.sql(sql)
