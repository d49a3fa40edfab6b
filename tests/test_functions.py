"""Column expressions on single rows."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from linecheck import functions as fn


@pytest.fixture
def one(spark):
    row = spark.range(1)
    return lambda column: row.select(column.alias("v")).first().v


def test_number_or_zero(one):
    assert [one(fn.number_or_zero(F.lit(t))) for t in ("1.5", "abc", "", " 2 ", "1e3")] == [1.5, 0.0, 0.0, 2.0, 1000.0]
    assert one(fn.number_or_zero(F.lit(None).cast("string"))) == 0.0
    assert math.isnan(one(fn.number_or_zero(F.lit("NaN"))))
    assert one(fn.number_or_zero(F.lit(7))) == 7.0


def test_distance_and_tolerance(one):
    assert one(fn.distance(F.lit(3.0), F.lit(4.0), F.lit(0.0), F.lit(0.0))) == 5.0
    assert one(fn.deviation(F.lit(3.0), F.lit(5.0))) == 2.0
    assert one(fn.out_of_tolerance(F.lit(0.5), F.lit(0.5))) is False
    assert one(fn.out_of_tolerance(F.lit(0.51), F.lit(0.5))) is True
    assert one(fn.out_of_tolerance(F.lit(math.nan), F.lit(0.5))) is False
    assert one(fn.out_of_tolerance(F.lit(9.0), F.lit(math.nan))) is False


def test_model_key(one):
    names = {"M 1#1": "M1", "M1": "M1", " M  1 # 6": "M1", "#": "", "": "", "a#b#c": "a"}
    assert {n: one(fn.model_key(F.lit(n))) for n in names} == names
    assert one(fn.model_key(F.lit(None).cast("string"))) is None


def test_texts(one):
    assert one(fn.fixed_decimals(F.lit(0.125))) == "0.13"
    assert one(fn.fixed_decimals(F.lit(1.005))) == "1.01"
    assert one(fn.fixed_decimals(F.lit(2.0), 0)) == "2"
    assert one(fn.line_text(F.lit(3), F.lit(0.125), F.lit(10.0))) == "lineNmb3_leadOffset_0.13_padOffset_10.00"
    assert one(fn.missing_lines_text(F.lit(1), F.lit(3))) == "少线: 【实际/标准: 1/3】"
    assert [one(fn.result_text(F.lit(c))) for c in (0, 1, 2)] == ["OK", "NG", "NG"]
    assert [one(fn.code_text(F.lit(c))) for c in (0, 1, 2)] == ["正常", "不合格", "缺线"]
    assert one(fn.suffix(F.lit("/a.b/c.tar.csv"))) == "csv"
    assert one(fn.joined([F.lit("E1"), F.lit(2)])) == "E1_2"


def test_dates(one):
    assert one(fn.midnight(F.lit(datetime.date(2021, 4, 23)))) == "2021-04-23 00:00:00"
    assert one(fn.midnight()).endswith(" 00:00:00")
    assert one(fn.later(F.lit("2021-04-23"), F.lit("2021-05-01"))) == "2021-05-01"
