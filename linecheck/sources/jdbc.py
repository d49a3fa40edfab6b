"""Tables of a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
) -> DataFrame:
    """A table of a database.

    With a numeric, date or timestamp ``column`` and its bounds the table is read in that many
    parallel pieces; bounds only place the cuts, rows outside of them are read too. Without, one
    task reads all of it, so give a column for any large table.
    """
    properties = dict(properties or {})
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if lower is None or upper is None or partitions is None:
        raise ValueError("a partition column needs lower, upper and partitions")
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=properties
    )


def read_jdbc_options(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The same from a map of options (url, dbtable, user, ...)."""
    missing = {"url"} - set(options)
    if missing or not {"dbtable", "query"} & set(options):
        raise ValueError("options need url, and dbtable or query")
    return spark.read.format("jdbc").options(**options).load()
