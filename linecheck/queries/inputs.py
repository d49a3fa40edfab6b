"""The given tables read as an inspection line.

Suppliers stand for machines, each with a model of its own; shipped order lines are
the readings. Suppliers in debt have no golden template, and the equipment map leaves
out one region, so that models without template and failures without place occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linecheck import schemas as S
from linecheck.operators.prepare import typed_lines
from linecheck.operators.template import template_table

MARK = "1996-01-01 00:00:00"
TEMPLATE_LINES = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _machine() -> Column:
    return F.concat(F.lit("EQ"), F.col("s_suppkey").cast("string"))


def _model() -> Column:
    return F.concat(
        F.lit("C "), F.col("s_suppkey").cast("string"), F.lit("#"), F.col("s_nationkey").cast("string")
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier")
    suppliers = suppliers.select("s_suppkey", _machine().alias("equipmentid"), _model().alias("mcid"))
    lines = table(spark, folder, "lineitem")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_linenumber").alias("linenmb"),
        "equipmentid",
        "mcid",
        F.col("l_shipdate").alias("datetime"),
        F.col("l_quantity").alias("leadx"),
        (F.col("l_extendedprice") / 1000).alias("leady"),
        F.round(F.col("l_discount") * 100).alias("padx"),
        F.round(F.col("l_tax") * 100).alias("pady"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return typed_lines(readings(spark, folder))


def template_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Template rows under the column names of a template file, with their model."""
    number = F.explode(F.sequence(F.lit(1), F.lit(TEMPLATE_LINES)))
    suppliers = table(spark, folder, "supplier").where(F.col("s_acctbal") >= 0)
    rows = suppliers.select("s_suppkey", "s_nationkey", number.alias("lineNmb"))

    def from_second(value: Column | float) -> Column:
        return F.when(F.col("lineNmb") == 1, 0.0).otherwise(value)

    return rows.select(
        F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("model_key"),
        "lineNmb",
        from_second(F.col("s_nationkey").cast("double") / 8 + 24).alias("leadDiff"),
        from_second(4.0).alias("padDiff"),
        from_second(20.0).alias("leadThreshold"),
        from_second(5.0).alias("padThreshold"),
    )


def templates(spark: SparkSession, folder: str) -> DataFrame:
    return template_table(template_rows(spark, folder))


def model_list(spark: SparkSession, folder: str) -> DataFrame:
    """Plain model names; machines in debt are listed with their ``#`` part, which never matches."""
    plain = F.concat(F.lit("C "), F.col("s_suppkey").cast("string"))
    name = F.when(F.col("s_acctbal") >= 0, plain).otherwise(_model())
    return table(spark, folder, "supplier").select(name.alias("mcID"))


def equipment(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region").where(F.col("r_name") != "EUROPE")
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return suppliers.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias(S.MACHINE), _machine().alias(S.BOX), F.col("n_name").alias(S.PLANT),
        F.col("r_name").alias(S.AREA),
    )


def changed_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The customers of one segment with another balance."""
    rows = table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return rows.withColumn("c_acctbal", F.col("c_acctbal") + 1)


def new_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in debt once more under new keys."""
    rows = table(spark, folder, "customer").where(F.col("c_acctbal") < 0)
    return rows.withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
