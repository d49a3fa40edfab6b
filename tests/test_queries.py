"""Every registered query against its SQL in DuckDB."""

import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from linecheck.operators.check import check
from linecheck.operators.prepare import typed_lines
from linecheck.queries import inputs

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return str(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, FOLDER)
    rows = found.collect()
    if name not in ORACLE:
        assert rows
        return
    wanted = duck.execute(ORACLE[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, rows) == rows_of(columns, wanted.fetchall())


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("folder, wanted", [("sf0.001", (16, 59, 263)), ("sf0.01", (127, 479, 2256))])
def test_counts_of_the_survey(spark, folder, wanted):
    """Verdicts of another reading of the tables, with five models, counted beforehand."""
    rows = inputs.table(spark, f"/root/testdata/{folder}", "lineitem").join(
        inputs.table(spark, f"/root/testdata/{folder}", "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    lines = typed_lines(
        rows.selectExpr(
            "l_linenumber as linenmb",
            "concat('EQ', s_suppkey) as equipmentid",
            "concat('C0 ', s_nationkey % 5, '#', s_suppkey % 3) as mcid",
            "l_shipdate as datetime",
            "l_quantity as leadx",
            "l_extendedprice / 1000 as leady",
            "round(l_discount * 100) as padx",
            "round(l_tax * 100) as pady",
        )
    )
    models = spark.range(4).selectExpr("id", "explode(sequence(1, 4)) as line", "line > 1 as later")
    templates = models.selectExpr(
        "concat('C0', id) as model_key",
        "line",
        "if(later, 24.0D + id, 0.0D) as lead_diff",
        "if(later, 4.0D, 0.0D) as pad_diff",
        "if(later, 20.0D, 0.0D) as lead_limit",
        "if(later, 5.0D, 0.0D) as pad_limit",
    )
    counts = check(lines, templates).groupBy("code").count().collect()
    assert tuple(n for _, n in sorted(counts)) == wanted
