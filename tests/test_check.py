"""Segmentation and verdicts: golden case, rules, random tables, uneven tables."""

import random

import pytest
from pyspark.sql import functions as F

import golden
import restated
from linecheck import schemas as S
from linecheck.operators import check as checks
from linecheck.operators import timeline
from linecheck.operators.prepare import prepare, typed_lines
from linecheck.operators.template import missing_templates, template_positions, template_table
from linecheck.operators.timeline import segment
from linecheck.sources.tables import append_rows, create_table, drop_table, scan_lines


def as_templates(spark, by_model):
    rows = [(model, *row) for model, lines in by_model.items() for row in lines]
    names = "model_key string, lineNmb int, leadDiff double, padDiff double, leadThreshold double, padThreshold double"
    return template_table(spark.createDataFrame(rows, names))


def found(spark, raw, by_model, **options):
    lines = typed_lines(scan_lines(spark.createDataFrame(raw, S.LINES)))
    return ordered(checks.check(lines, as_templates(spark, by_model), **options).collect())


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))


LIMITS = (2_000_000, 8, 3, 1)


@pytest.mark.parametrize("limit", LIMITS)
def test_golden(spark, limit):
    assert found(spark, golden.READINGS, {"M1": golden.TEMPLATE}, limit=limit) == ordered(golden.VERDICTS)


def test_golden_agrees_with_restatement():
    assert ordered(restated.verdicts(golden.READINGS, {"M1": golden.TEMPLATE})) == ordered(golden.VERDICTS)


def test_missing_template_is_listed(spark):
    lines = typed_lines(spark.createDataFrame(golden.READINGS, S.LINES))
    rows = missing_templates(lines.select("model_key"), as_templates(spark, {"M1": golden.TEMPLATE})).collect()
    assert [r.model_key for r in rows] == ["M2"]


def test_no_template_at_all_gives_the_empty_verdict_table(spark):
    lines = typed_lines(spark.createDataFrame(golden.READINGS, S.LINES))
    none = checks.check(lines, as_templates(spark, {"M1": golden.TEMPLATE}).where("false"))
    assert none.columns == S.VERDICTS.names and none.collect() == []
    assert [f.dataType for f in none.schema] == [f.dataType for f in S.VERDICTS]


def test_no_readings(spark):
    assert found(spark, golden.READINGS[:0], {"M1": golden.TEMPLATE}) == []


def test_first_line_is_reported_as_line_1(spark):
    template = [(1, 2.0, 0.0, 0.5, 0.5), *golden.TEMPLATE[1:]]
    rows = found(spark, golden.READINGS, {"M1": template})
    full = [r for r in rows if r[3] != 2]
    assert len(full) == 10 and all(r[3] == 1 and r[4].startswith("lineNmb1_leadOffset_2.00_") for r in full)
    assert ("E2", "M1", None, 1, "lineNmb1_leadOffset_2.00_padOffset_0.00|lineNmb4_leadOffset_0.83_padOffset_0.00") in rows


def test_decimals(spark):
    rows = found(spark, golden.READINGS, {"M1": golden.TEMPLATE}, decimals=4)
    assert ("E1", "M 1#1", golden.DAY + "08:00:02", 1, "lineNmb3_leadOffset_0.8310_padOffset_0.0000") in rows


def test_template_of_another_order_and_size(spark):
    std = as_templates(spark, {"M1": golden.TEMPLATE[::-1], "M9": golden.TEMPLATE[1:]})
    rows = {(r.model_key, r.pos): (r.line, r.n_std) for r in template_positions(std).collect()}
    assert rows == {("M1", 1): (1, 3), ("M1", 2): (2, 3), ("M1", 3): (3, 3), ("M9", 1): (2, 2), ("M9", 2): (3, 2)}


def random_readings(seed, n=300):
    """Few machines, days, times and values, so that ties, copies and gaps are common."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day, second = rng.choice([1, 1, 1, 2, 5, 9]), rng.randrange(12)
        mc = rng.choice(["M 1#1", "M 1#1", "M1", "M 2#x", "M3"])
        rows.append(
            (
                rng.choice([0, 1, 1, 2, 2, 3, 3, 4]),
                rng.choice(["E1", "E1", "E1", "E2", "E_3"]),
                mc,
                f"2021-04-{day:02d} 08:00:{second:02d}",
                *[rng.choice(["0", "1.5", "3", "abc", None]) for _ in range(4)],
            )
        )
    return rows


BY_MODEL = {
    "M1": [(1, 0.0, 0.0, 0.1, 0.1), (2, 1.5, 1.0, 1.0, 2.0), (3, 2.0, 1.5, 2.0, 1.5)],
    "M2": [(1, 0.0, 0.0, 0.0, 0.0), (2, 1.5, 1.5, 1.5, 1.5)],
}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", (2_000_000, 10, 2))
def test_random_tables(spark, seed, limit):
    raw = random_readings(seed)
    assert found(spark, raw, BY_MODEL, limit=limit) == ordered(restated.verdicts(raw, BY_MODEL))


def uneven_readings():
    """A third of all rows each: copies of one row, one day of one machine, a run without marker."""
    rng = random.Random(5)
    raw = random_readings(11, 120)
    raw += [(2, "E1", "M 1#1", "2021-04-01 08:00:03", "1.5", "0", "3", "0")] * 150
    for i in range(150):
        time = f"2021-04-03 {i // 60:02d}:{i % 60:02d}:00"
        raw.append((rng.choice([1, 2, 3]), "E2", "M1", time, *[str(rng.randrange(3)) for _ in range(4)]))
    for i in range(150):
        time = f"2021-05-{1 + i // 10:02d} 00:00:{i % 10:02d}"
        raw.append((2, "E_3", "M 1#1", time, str(i), "0", "0", "0"))
    # A sample that looks large but has few distinct lines, spread over days.
    raw += [(1, "E7", "M1", "2021-04-01 08:00:00", "0", "0", "0", "0")]
    for i in range(60):
        raw.append((2 + i % 2, "E7", "M1", f"2021-04-{1 + i % 9:02d} 09:00:00", "1.5", "0", "1", "0"))
    raw += [(2, "E7", "M1", "2021-04-20 01:00:00", "1.5", "0", "1", "0")]
    raw += [(1, "E7", "M1", "2021-04-20 05:00:00", "0", "0", "0", "0")]
    return raw


@pytest.mark.parametrize("limit", (2_000_000, 100, 20, 4))
def test_uneven_tables(spark, limit):
    raw = uneven_readings()
    rows = found(spark, raw, BY_MODEL, limit=limit)
    assert rows == ordered(restated.verdicts(raw, BY_MODEL))
    assert any(r[:3] == ("E7", "M1", "2021-04-01 08:00:00") and r[3] < 2 for r in rows)


@pytest.mark.parametrize("limit", (2_000_000, 100, 20, 4))
def test_segments_of_uneven_tables(spark, limit):
    raw = [(i, *row) for i, row in enumerate(uneven_readings())]
    frame = spark.createDataFrame(raw, "id int, linenmb int, eq string, mc string, t string, a string, b string, c string, d string")
    rows = segment(frame, ["eq", "mc"], "t", F.col("linenmb") == 1, limit=limit).select("id", "sample_ts").collect()
    wanted = restated.starts(raw, lambda r: (r[2], r[3]), lambda r: r[4], lambda r: r[1] == 1)
    assert {r.id: r.sample_ts for r in rows} == dict(enumerate(wanted)) and len(rows) == len(raw)


@pytest.mark.parametrize("limit", (2_000_000, 20, 4))
def test_sizes_of_uneven_tables(spark, limit):
    raw = [r for r in uneven_readings() if r[0] > 0]
    lines = typed_lines(spark.createDataFrame(raw, S.LINES))
    rows = checks.sample_sizes(lines, limit=limit).collect()
    begin = restated.starts(raw, lambda r: (r[1], r[2]), lambda r: r[3], lambda r: r[0] == 1)
    wanted = {}
    for row, start in zip(raw, begin):
        wanted.setdefault((row[1], row[2], start), set()).add((row[0], *map(restated.number, row[4:])))
    assert {tuple(r)[:3]: r.n_lines for r in rows} == {k: len(v) for k, v in wanted.items()} and len(rows) == len(wanted)


@pytest.mark.parametrize("limit", (2_000_000, 2))
def test_missing_ids_and_times_form_groups_of_their_own(spark, limit):
    raw = [
        (1, None, "M1", "2021-04-01 08:00:00", "0", "0", "0", "0"),
        (2, None, "M1", "2021-04-01 08:00:01", "1", "0", "0", "0"),
        (1, "E1", "M1", None, "0", "0", "0", "0"),
        (2, "E1", "M1", "2021-04-01 08:00:01", "1", "0", "0", "0"),
        (2, None, "M1", "2021-04-03 08:00:01", "1", "0", "0", "0"),
    ]
    rows = prepare(spark.createDataFrame(raw, S.LINES), limit=limit).collect()
    assert ordered((r.equipmentid, r.datetime, r.sample_ts) for r in rows) == ordered(
        [
            (None, "2021-04-01 08:00:00", "2021-04-01 08:00:00"),
            (None, "2021-04-01 08:00:01", "2021-04-01 08:00:00"),
            (None, "2021-04-03 08:00:01", "2021-04-01 08:00:00"),
            ("E1", None, None),
            ("E1", "2021-04-01 08:00:01", None),
        ]
    )


def test_order_and_partitions_do_not_matter(spark):
    raw = random_readings(21)
    wanted = found(spark, raw, BY_MODEL)
    lines = typed_lines(scan_lines(spark.createDataFrame(raw[::-1], S.LINES).repartition(7, "leadx")))
    assert ordered(checks.check(lines, as_templates(spark, BY_MODEL)).collect()) == wanted


def test_large_templates_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(checks, "is_small", lambda table: False)
    raw = random_readings(3)
    assert found(spark, raw, BY_MODEL) == ordered(restated.verdicts(raw, BY_MODEL))


@pytest.mark.parametrize("limit", (20, 4))
def test_large_tables_of_slots_are_not_broadcast(spark, monkeypatch, limit):
    for module in (timeline, checks):
        monkeypatch.setattr(module, "small_side", lambda table, most=0: table)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = uneven_readings()
        assert found(spark, raw, BY_MODEL, limit=limit) == ordered(restated.verdicts(raw, BY_MODEL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_without_limit_nothing_is_measured(spark, monkeypatch):
    monkeypatch.setattr(timeline, "is_small", None)
    raw = random_readings(8)
    assert found(spark, raw, BY_MODEL, limit=None) == ordered(restated.verdicts(raw, BY_MODEL))


def test_times_of_a_number_need_a_slot(spark):
    frame = spark.createDataFrame([("a", i, i % 3 == 0) for i in range(20)], "k string, t int, m boolean")
    for limit in (4, 1_000_000):
        with pytest.raises(ValueError):
            segment(frame, ["k"], "t", F.col("m"), limit=limit).collect()
    slot = F.floor(F.col("t") / 5).cast("int") * 5
    rows = segment(frame, ["k"], "t", F.col("m"), slot=slot, limit=4).collect()
    assert {r.t: r.sample_ts for r in rows} == {i: i // 3 * 3 for i in range(20)}


def data_shuffles(frame):
    """Shuffles of the plan that are not below a broadcast."""
    plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
    depth, count = None, 0
    for line in plan.splitlines():
        level = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and level > depth:
            continue
        depth = level if "BroadcastExchange" in line else None
        count += "Exchange hashpartitioning" in line
    return count


def test_one_shuffle_of_the_readings(spark, tmp_path):
    spark.createDataFrame(golden.READINGS, S.LINES).write.parquet(str(tmp_path / "r"))
    lines = typed_lines(scan_lines(spark.read.parquet(str(tmp_path / "r"))))
    templates = as_templates(spark, BY_MODEL)
    assert data_shuffles(checks.check(lines, templates)) == 1
    assert data_shuffles(checks.check(lines, templates, limit=40)) <= 1
    assert data_shuffles(checks.check(lines, templates, slot="minute", limit=35)) <= 2


def test_no_shuffle_of_a_bucketed_table(spark):
    name = "linecheck_readings"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = [(f.name, f.dataType.simpleString(), True) for f in S.LINES]
    create_table(spark, name, columns, S.HISTORY, partitions=4)
    append_rows(spark.createDataFrame(golden.READINGS, S.LINES), name)
    lines = typed_lines(scan_lines(spark.read.table(name)))
    rows = checks.check(lines, as_templates(spark, {"M1": golden.TEMPLATE}))
    assert data_shuffles(rows) == 0
    assert ordered(rows.collect()) == ordered(golden.VERDICTS)
    drop_table(spark, name)


@pytest.mark.parametrize("models", (4, 400))
def test_plan_does_not_grow_with_the_models(spark, tmp_path, models):
    by_model = {f"M{i}": golden.TEMPLATE for i in range(models)}
    as_templates(spark, by_model).write.parquet(str(tmp_path / "t"))
    lines = typed_lines(spark.createDataFrame(golden.READINGS, S.LINES))
    rows = checks.check(lines, spark.read.parquet(str(tmp_path / "t")))
    plan = rows._sc._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "simple")
    assert plan.count("\n") < 60


@pytest.mark.parametrize("limit", (20, 400))
def test_a_crowded_day_is_cut_level_by_level(spark, monkeypatch, limit):
    """All readings within one hour; windows over parts of a slot have at most 60 of them."""
    windows = []
    carry = timeline._facts

    def seen(rows, keys, slot, time, marker):
        found = carry(rows, keys, slot, time, marker)
        windows.append(found.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return found

    monkeypatch.setattr(timeline, "_facts", seen)
    rows = [(1 + i % 7, f"E{i % 3 // 2}", "M1", f"2021-04-23 08:{i // 3 % 60:02d}:{i % 50:02d}") for i in range(1500)]
    frame = spark.createDataFrame(rows, "n int, eq string, mc string, t string")
    marker = F.col("n") == 1
    cut = segment(frame, ["eq", "mc"], "t", marker, limit=limit)
    plain = segment(frame, ["eq", "mc"], "t", marker, limit=None)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    assert len(windows) > 2 and max(windows) <= 60
