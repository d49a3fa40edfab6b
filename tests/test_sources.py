"""Files and catalog tables, in fresh folders."""

import re

import pytest
from pyspark.sql import functions as F

import golden
from linecheck import schemas as S
from linecheck.operators import keyed
from linecheck.operators.template import template_positions
from linecheck.queries import catalog, inputs
from linecheck.sources import files, jdbc, tables

TEMPLATE_CSV = "lineNmb,leadDiff,padDiff,leadThreshold,padThreshold\n1,0,0,0.5,0.5\n2,5,3,0.5,0.5\n3,5,3,0.5,0.5\n"


def as_tuples(frame):
    return sorted(map(tuple, frame.collect()))


def test_template_from_each_kind_of_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEMPLATE_CSV)
    raw = files.read_csv(spark, str(tmp_path / "a.csv"), S.TEMPLATE)
    raw.write.parquet(str(tmp_path / "a.parquet"))
    raw.write.json(str(tmp_path / "a.json"))
    for kind in ("csv", "parquet", "json"):
        found = files.read_template(spark, str(tmp_path / f"a.{kind}"), "M1")
        assert as_tuples(found) == [("M1", *row) for row in golden.TEMPLATE]
    with pytest.raises(ValueError):
        files.read_template(spark, str(tmp_path / "a.txt"), "M1")


def test_templates_of_a_folder(spark, tmp_path):
    (tmp_path / "M1_stdModel.csv").write_text(TEMPLATE_CSV)
    (tmp_path / "M+2 é%_stdModel.csv").write_text(TEMPLATE_CSV)
    (tmp_path / "other.csv").write_text("a\n1\n")
    files.read_csv(spark, str(tmp_path / "M1_stdModel.csv"), S.TEMPLATE).write.option("header", True).csv(
        files.template_path(f"{tmp_path}/", "M3")
    )
    found = template_positions(files.read_templates(spark, str(tmp_path)))
    assert {r.model_key for r in found.collect()} == {"M1", "M+2 é%", "M3"}
    assert found.count() == 9


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(TEMPLATE_CSV + "x,1,1,1,1\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), S.TEMPLATE).collect()
    (tmp_path / "order.csv").write_text("leadDiff,lineNmb,padDiff,leadThreshold,padThreshold\n1,0,0,0.5,0.5\n")
    with pytest.raises(Exception, match="[Hh]eader"):
        files.read_csv(spark, str(tmp_path / "order.csv"), S.TEMPLATE).collect()


def test_csv_without_schema_is_inferred_and_ids_stay_text_with_one(spark, tmp_path):
    (tmp_path / "list.csv").write_text("mcID\n0012\n0013\n")
    inferred = files.read_csv(spark, str(tmp_path / "list.csv"))
    assert dict(inferred.dtypes) == {"mcID": "int"}
    assert as_tuples(files.read_model_list(spark, str(tmp_path / "list.csv"))) == [("0012",), ("0013",)]


def test_mark(spark, tmp_path):
    path = str(tmp_path / "mark")
    assert files.read_mark(spark, path, "1970-01-01 00:00:00") == "1970-01-01 00:00:00"
    for value in ("2021-04-23 08:00:12", "2021-04-24 00:00:00"):
        files.write_mark(spark.createDataFrame([(value,)], "datetime string"), path)
        assert files.read_mark(spark, path, "") == value
    files.write_mark(spark.createDataFrame([(None,)], "datetime string"), path)
    assert files.read_mark(spark, path, "") == "2021-04-24 00:00:00"


def test_report_file_in_both_encodings(spark, tmp_path):
    lines = spark.createDataFrame([('(E1,"M 1",NG,少线: 【实际/标准: 1/3】)',), ("(E2,,'x',不合格)",)], "line string")
    wanted = {r.line for r in lines.collect()}
    for encoding in ("UTF-8", "GBK"):
        path = tmp_path / encoding
        files.write_report(lines, str(path), encoding)
        text = "".join(p.read_bytes().decode(encoding) for p in path.glob("part-*"))
        assert set(text.splitlines()) == wanted


def test_scan_filters(spark):
    rows = spark.createDataFrame(golden.READINGS, S.LINES)
    assert tables.scan(rows).count() == 42 and tables.scan(rows, "linenmb = 0").count() == 1
    assert tables.scan_lines(rows).count() == 41
    assert tables.scan_lines(rows, "mcid = 'M1'").count() == 6
    assert tables.scan_lines(rows, F.col("datetime") > golden.DAY + "08:00:10").count() == 6


def test_scan_reaches_the_files(spark, tmp_path):
    spark.createDataFrame(golden.READINGS, S.LINES).write.parquet(str(tmp_path / "r"))
    rows = tables.scan_lines(files.read_parquet(spark, str(tmp_path / "r")), "datetime > '2021'").select("linenmb")
    plan = rows._sc._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "GreaterThan(linenmb,0)" in plan and "GreaterThan(datetime,2021)" in plan
    assert "ReadSchema: struct<linenmb:int,datetime:string>" in plan


COLUMNS = [("id", "long", False), ("name", "string", True), ("v", "double", True), ("x", "decimal", True)]


def test_table_life(spark):
    spark.sql("DROP TABLE IF EXISTS linecheck_t")
    tables.create_table(spark, "linecheck_t", COLUMNS, ["id"], partitions=4)
    assert spark.read.table("linecheck_t").dtypes == [("id", "bigint"), ("name", "string"), ("v", "double"), ("x", "string")]
    with pytest.raises(ValueError, match="exists already"):
        tables.create_table(spark, "linecheck_t", COLUMNS, ["id"])
    rows = spark.createDataFrame([("a", 1.0, 1, None), ("b", 2.0, 2, "t")], "name string, v double, id long, x string")
    tables.append_rows(rows, "linecheck_t")
    tables.append_rows(rows, "linecheck_t")
    assert tables.read_table(spark, "linecheck_t", "v > 1.5").count() == 2
    tables.register_view(tables.read_table(spark, "linecheck_t", "id = 1"), "linecheck_v")
    assert {r.name for r in spark.sql("select name from linecheck_v").collect()} == {"a"}
    tables.drop_table(spark, "linecheck_t")
    with pytest.raises(ValueError, match="no such table"):
        tables.drop_table(spark, "linecheck_t")
    with pytest.raises(ValueError, match="keys"):
        tables.create_table(spark, "linecheck_t", COLUMNS, ["nokey"])


def test_type_names():
    schema = tables.keyed_schema([(k, k, True) for k in ("int", "double", "string", "long", "timestamp", "binary", "bool", "?")])
    kinds = ["int", "double", "string", "bigint", "timestamp", "binary", "boolean", "string"]
    assert [f.dataType.simpleString() for f in schema] == kinds


def test_bucketed_table_is_not_shuffled(spark):
    spark.sql("DROP TABLE IF EXISTS linecheck_b")
    tables.create_table(spark, "linecheck_b", COLUMNS, ["id"], partitions=4)
    rows = spark.createDataFrame([(i, "n", 1.0, "x") for i in range(20)], "id long, name string, v double, x string")
    tables.append_rows(rows, "linecheck_b")
    new = keyed.upsert(tables.read_table(spark, "linecheck_b"), rows.where("id < 5").hint("merge"), ["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new._sc._jvm.PythonSQLUtils.explainString(new._jdf.queryExecution(), "simple")
        assert plan.count("Exchange hashpartitioning") == 1 and new.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tables.drop_table(spark, "linecheck_b")


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "id int, name string, v double")


def test_insert(spark, base):
    new = spark.createDataFrame([(4.0, 4, "d")], "v double, id int, name string")
    assert as_tuples(keyed.insert(base, new, ["id"]))[-1] == (4, "d", 4.0)
    with pytest.raises(keyed.KeyConflict):
        keyed.insert(base, new.withColumn("id", F.lit(2)), ["id"])
    with pytest.raises(keyed.KeyConflict):
        keyed.insert(base, new.union(new), ["id"])


def test_upsert(spark, base):
    new = spark.createDataFrame([(2, "B", None), (4, "d", 4.0)], "id int, name string, v double")
    assert as_tuples(keyed.upsert(base.where("id < 3"), new, ["id"])) == [(1, "a", 1.0), (2, "B", None), (4, "d", 4.0)]
    with pytest.raises(keyed.KeyConflict):
        keyed.upsert(base, new.union(new), ["id"])


def test_update(spark, base):
    new = spark.createDataFrame([(2, None), (1, 9.0)], "id int, v double")
    assert as_tuples(keyed.update(base.where("id < 3"), new, ["id"])) == [(1, "a", 9.0), (2, "b", None)]
    with pytest.raises(keyed.KeyConflict):
        keyed.update(base, new.withColumn("id", F.col("id") + 10), ["id"])


class Recorder:
    """Stands in for the reader of a session; no database is started for a test."""

    def __init__(self):
        self.calls = []

    read = property(lambda self: self)

    def jdbc(self, url, table, **more):
        self.calls.append((url, table, more))

    def format(self, name):
        self.calls.append(name)
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return "loaded"


def test_jdbc_arguments():
    spark = Recorder()
    jdbc.read_jdbc(spark, "jdbc:x", "t", {"user": "u"})
    jdbc.read_jdbc(spark, "jdbc:x", "t", column="id", lower=0, upper=9, partitions=3)
    assert spark.calls == [
        ("jdbc:x", "t", {"properties": {"user": "u"}}),
        ("jdbc:x", "t", {"column": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3, "properties": {}}),
    ]
    with pytest.raises(ValueError):
        jdbc.read_jdbc(spark, "jdbc:x", "t", column="id")
    assert jdbc.read_jdbc_options(spark, {"url": "jdbc:x", "dbtable": "t"}) == "loaded"
    assert spark.calls[2:] == ["jdbc", {"url": "jdbc:x", "dbtable": "t"}]
    with pytest.raises(ValueError):
        jdbc.read_jdbc_options(spark, {"url": "jdbc:x"})


def test_literal_rows(spark):
    rows = files.literal_rows(spark, [("E1", 0), ("E2", 1)], ["equipmentid", "code"])
    assert as_tuples(rows) == [("E1", 0), ("E2", 1)] and rows.columns == ["equipmentid", "code"]


def test_templates_with_gaps_fail(spark, tmp_path):
    line = '{"lineNmb":%d,"leadDiff":1.0,"padDiff":1.0%s}\n'
    limits = ',"leadThreshold":0.5,"padThreshold":0.5'
    (tmp_path / "whole.json").write_text(line % (1, limits))
    assert files.read_template(spark, str(tmp_path / "whole.json"), "M1").count() == 1
    (tmp_path / "broken.json").write_text(line % (1, limits) + '{"lineNmb":2,"lead\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        files.read_template(spark, str(tmp_path / "broken.json"), "M1").collect()
    (tmp_path / "gap.json").write_text(line % (1, limits) + line % (2, ""))
    with pytest.raises(Exception, match="has no leadThreshold"):
        files.read_template(spark, str(tmp_path / "gap.json"), "M1").collect()
    (tmp_path / "gap.csv").write_text(TEMPLATE_CSV + "9,1,1,,1\n")
    with pytest.raises(Exception, match="has no leadThreshold"):
        files.read_template(spark, str(tmp_path / "gap.csv"), "M1").collect()
    gap = spark.createDataFrame([(1, 1.0, None, 0.5, 0.5)], S.TEMPLATE)
    gap.write.parquet(str(tmp_path / "gap.parquet"))
    with pytest.raises(Exception, match="has no padDiff"):
        files.read_template(spark, str(tmp_path / "gap.parquet"), "M1").collect()


@pytest.mark.parametrize("write", (keyed.insert, keyed.upsert, keyed.update))
def test_rows_that_do_not_fit_a_keyed_table(spark, base, write):
    missing = spark.createDataFrame([(None, "x", 1.0)], base.schema)
    with pytest.raises(keyed.KeyConflict, match="no value for a key"):
        write(base, missing, ["id"])
    known = base.where("id = 1") if write is keyed.update else base.where("id = 1").withColumn("id", F.lit(77))
    with pytest.raises(keyed.KeyConflict, match="no value for a key"):
        write(base.union(missing), known, ["id"])
    with pytest.raises(keyed.KeyConflict, match="no column w"):
        write(base, known.withColumn("w", F.lit(1)), ["id"])
    with pytest.raises(keyed.KeyConflict, match="lack the key id"):
        write(base, known.drop("id"), ["id"])


def test_columns_that_look_like_those_of_the_join(spark):
    table = spark.createDataFrame([(1, 10, True), (2, 20, False)], "id int, new_v int, is_new boolean")
    found = keyed.update(table, table.where("id = 1").selectExpr("id", "99 as new_v"), ["id"])
    assert as_tuples(found) == [(1, 99, True), (2, 20, False)]


def test_a_written_table_is_switched_to_its_new_version(spark):
    spark.sql("DROP TABLE IF EXISTS linecheck_w")
    tables.create_table(spark, "linecheck_w", COLUMNS, ["id"], partitions=4)
    rows = spark.range(10).selectExpr("id", "'a' as name", "1.5d as v", "'y' as x")
    for part in (rows.where("id < 6"), rows.where("id > 3").withColumn("v", F.lit(9.0))):
        new = keyed.upsert(tables.read_table(spark, "linecheck_w"), part, ["id"])
        tables.rewrite(new, "linecheck_w", ["id"], partitions=4)
    stored = tables.read_table(spark, "linecheck_w")
    assert stored.count() == 10 and stored.where("v = 9").count() == 6
    assert not spark.catalog.tableExists("linecheck_w_next")
    tables.drop_table(spark, "linecheck_w")


def test_template_files_are_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(files, "FILES_PER_TASK", 1, raising=False)
    folder = "/root/testdata/sf0.001"
    found = catalog.template_files(spark, folder)
    assert as_tuples(found) == as_tuples(inputs.templates(spark, folder).select(*found.columns))
    tasks = {re.search(r"part-(\d+)", name).group(1) for name in found.inputFiles()}
    assert 1 < len(tasks) <= len(found.inputFiles()) == found.select("model_key").distinct().count()


def test_no_templates_are_written_and_read(spark, tmp_path):
    rows = inputs.template_rows(spark, "/root/testdata/sf0.001").where("false")
    files.write_templates(rows, str(tmp_path / "none"))
    assert files.read_templates(spark, str(tmp_path / "none")).count() == 0
