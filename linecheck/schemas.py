"""Schemas of the named inputs and outputs, and the fixed texts of the reports."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of readings, templates, model list and verdicts.
COORDINATES = ("leadx", "leady", "padx", "pady")
HISTORY = ("equipmentid", "mcid")

LINES = T.StructType(
    [
        T.StructField("linenmb", T.IntegerType()),
        T.StructField("equipmentid", T.StringType()),
        T.StructField("mcid", T.StringType()),
        T.StructField("datetime", T.StringType()),
        *[T.StructField(name, T.StringType()) for name in COORDINATES],
    ]
)

TEMPLATE = T.StructType(
    [
        T.StructField("lineNmb", T.IntegerType()),
        T.StructField("leadDiff", T.DoubleType()),
        T.StructField("padDiff", T.DoubleType()),
        T.StructField("leadThreshold", T.DoubleType()),
        T.StructField("padThreshold", T.DoubleType()),
    ]
)

MODEL_LIST = T.StructType([T.StructField("mcID", T.StringType())])

# Column names of the equipment map.
MACHINE, BOX, PLANT, AREA = "机台号", "盒子编码", "厂", "区"

EQUIPMENT = T.StructType([T.StructField(name, T.StringType()) for name in (MACHINE, BOX, PLANT, AREA)])

VERDICTS = T.StructType(
    [
        T.StructField("equipmentid", T.StringType()),
        T.StructField("mcid", T.StringType()),
        T.StructField("datetime", T.StringType()),
        T.StructField("code", T.IntegerType()),
        T.StructField("description", T.StringType()),
    ]
)

# Verdict codes.
QUALIFIED, OUT_OF_TOLERANCE, LINES_MISSING = 0, 1, 2

# Column names and texts of the alert report.
ALERT_COLUMNS = ("盒子编码", "机型", "对比结果", "时间", "一级详细信息", "二级详细信息")
RESULT_TEXT = {QUALIFIED: "OK", OUT_OF_TOLERANCE: "NG", LINES_MISSING: "NG"}
CODE_TEXT = {QUALIFIED: "正常", OUT_OF_TOLERANCE: "不合格", LINES_MISSING: "缺线"}

# Patterns of the descriptions, and the end of a template's file name.
QUALIFIED_TEXT = "qualified"
MISSING_TEXT = "少线: 【实际/标准: %d/%d】"
LINE_TEXT = "lineNmb%d_leadOffset_{offset}_padOffset_{offset}"
LINE_DELIMITER = "|"
TEMPLATE_SUFFIX = "_stdModel.csv"

# Type names accepted when a keyed table is created.
TYPE_NAMES = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "long": T.LongType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "bool": T.BooleanType(),
}
