"""Versioned tables, keyed tables of files, merge on read."""

import random

import pytest
from pyspark.sql import functions as F

from linecheck.operators.keyed import KeyConflict
from linecheck.sources import versions
from linecheck.sources.keyed_files import KeyedFiles
from linecheck.sources.versions import CommitConflict, VersionedTable

SCHEMA = "id long, name string, value double"


def rows(spark, ids, value=0.0):
    return spark.createDataFrame([(i, f"n{i}", value) for i in ids], SCHEMA)


def content(frame):
    return sorted((r.id, r.value) for r in frame.collect())


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "results"))
    made.create(rows(spark, []).schema, ["id"])
    return made


@pytest.fixture
def keyed(spark, tmp_path):
    made = KeyedFiles.create(spark, str(tmp_path / "keyed"), rows(spark, []).schema, ["id"], buckets=3, file_rows=20)
    made.insert(rows(spark, range(600)))
    return made


def test_a_repeated_run_is_taken_over_once(spark, table):
    assert table.append(rows(spark, [1, 2]), run="a") == 2
    assert table.append(rows(spark, [1, 2]), run="a") == 2
    assert table.append(rows(spark, [3]), run="b") == 3
    assert table.append(rows(spark, [3])) == 4
    assert [i for i, _ in content(table.read())] == [1, 2, 3, 3]
    assert [i for i, _ in content(table.read(2))] == [1, 2]
    assert table.read(1).count() == 0


def test_files_of_a_broken_run_are_not_read(spark, table):
    table.write(rows(spark, [7]))
    assert table.read().count() == 0
    table.append(rows(spark, [7]), run="again")
    assert content(table.read()) == [(7, 0.0)]


def test_of_two_that_saw_the_same_version_one_commits(spark, table):
    other = VersionedTable(spark, table.root)
    known = table.properties()
    indexes = [t.note(t.described(t.write(rows(spark, [n])), known), known) for n, t in enumerate((table, other))]
    seen = table.version()
    assert table.publish(seen, [indexes[0]], "x")
    assert not other.publish(seen, [indexes[1]], "y")
    assert other.commit(lambda now: [indexes[1]], "y") == seen + 2
    assert [i for i, _ in content(table.read())] == [0, 1]
    # Both repeated.
    assert table.commit(lambda now: [indexes[0]], "x") == table.commit(lambda now: [indexes[1]], "y") == seen + 2


def test_a_writer_that_always_loses_gives_up(spark, table, monkeypatch):
    monkeypatch.setattr(versions, "ATTEMPTS", 2)
    monkeypatch.setattr(table, "publish", lambda *a, **k: False)
    with pytest.raises(CommitConflict):
        table.append(rows(spark, [1]))


def test_bases_stand_for_what_was_before(spark, table, monkeypatch):
    monkeypatch.setattr(versions, "FOLD_AFTER", 3)
    for n in range(9):
        table.append(rows(spark, [n]), run=str(n))
        assert len(table.manifests()) <= 5
    assert any(m.base for m in table.manifests())
    assert [i for i, _ in content(table.read())] == list(range(9))
    for n in (0, 4, 8):
        table.append(rows(spark, [n]), run=str(n))
    assert table.read().count() == 9
    assert [i for i, _ in content(table.read(3))] == [0, 1]


def test_tables_are_made_once(spark, table, tmp_path):
    with pytest.raises(ValueError, match="exists"):
        table.create(rows(spark, []).schema)
    with pytest.raises(ValueError, match="no columns"):
        VersionedTable(spark, str(tmp_path / "other")).create(rows(spark, []).schema, ["nothing"])
    with pytest.raises(ValueError, match="no such table"):
        VersionedTable(spark, str(tmp_path / "none")).read()


def test_rows_after_a_mark_come_from_newer_files_only(spark, table):
    for start in (0, 100, 200):
        table.append(rows(spark, range(start, start + 100)), arrange=lambda part: part.repartitionByRange(4, "id"))
    table.append(spark.createDataFrame([(None, "lost", 1.0)], SCHEMA))
    found = versions.rows_after(table, "id", 219)
    assert sorted(r.id for r in found.collect()) == list(range(220, 300))
    opened = {f.rsplit("/data/", 1)[1] for f in found.inputFiles()}
    bounds = {r.path: (r.least.id, r.greatest.id) for r in table.files().collect()}
    assert opened == {path for path, (_, most) in bounds.items() if most is not None and most > 219}
    assert 0 < len(opened) < len(bounds) / 2
    assert versions.newest(table, "id").first().id == 299
    assert versions.rows_after(table, "id", 299).count() == 0
    less = versions.rows_after(table, "id", 99, F.col("least.`id`") < 150)
    assert {f.rsplit("/data/", 1)[1] for f in less.inputFiles()} == {p for p, (a, b) in bounds.items() if b is not None and b > 99 and a < 150}


def test_newest_of_no_rows_is_missing(table):
    assert versions.newest(table, "id").first().id is None


def test_a_change_leaves_other_files_untouched(spark, keyed):
    before = set(keyed.paths())
    assert len(before) > 20
    keyed.upsert(rows(spark, range(300, 306), 5.0))
    after = set(keyed.paths())
    # Six neighbours lie in one or two files of each of three buckets.
    assert 1 <= len(before - after) <= 6
    assert len(before & after) >= len(before) - 6
    assert content(keyed.read()) == [(i, 5.0 if 300 <= i < 306 else 0.0) for i in range(600)]


def test_new_keys_open_no_file(spark, keyed, monkeypatch):
    before = set(keyed.paths())
    keyed.insert(rows(spark, range(1000, 1010)))
    assert before < set(keyed.paths())
    files = keyed.table.files()
    places = keyed._places(rows(spark, [2000, -5]), files, keyed._known())
    assert places.count() == 0
    assert not places.inputFiles() or places.count() == 0


def test_conflicts_of_keys(spark, keyed):
    version = keyed.table.version()
    for write, frame in (
        (keyed.insert, rows(spark, [5, 5000])),
        (keyed.update, rows(spark, [5, 5000]).drop("name")),
        (keyed.upsert, rows(spark, [5, 5])),
        (keyed.upsert, rows(spark, [None])),
        (keyed.upsert, rows(spark, [5]).withColumn("other", F.lit(1))),
        (keyed.merge, rows(spark, [5]).drop("name")),
    ):
        with pytest.raises(KeyConflict):
            write(frame)
    assert keyed.table.version() == version
    keyed.update(rows(spark, [5, 6], 9.0).drop("name"))
    assert [v for i, v in content(keyed.read()) if i in (5, 6)] == [9.0, 9.0]
    assert keyed.read().where("name is null").count() == 0


def test_deltas_are_merged_when_read_and_compacted(spark, keyed):
    base = set(keyed.paths())
    keyed.merge(rows(spark, range(10, 20), 1.0))
    keyed.merge(rows(spark, [*range(15, 25), 700], 2.0))
    keyed.insert(rows(spark, [800], 3.0))
    assert base < set(keyed.paths())
    wanted = [(i, 2.0 if 15 <= i < 25 else 1.0 if 10 <= i < 15 else 0.0) for i in range(600)] + [(700, 2.0), (800, 3.0)]
    assert content(keyed.read()) == wanted
    version = keyed.table.version()
    keyed.compact(least=0)
    after = set(keyed.paths())
    assert content(keyed.read()) == wanted == content(keyed.read(version))
    assert base & after and base - after
    assert keyed.table.files().where("action = 'hide'").count() == 0
    assert keyed.compact(least=0) == version + 1


def test_a_repeated_keyed_run_changes_nothing(spark, keyed):
    for _ in range(2):
        keyed.insert(rows(spark, [900]), run="i")
        keyed.merge(rows(spark, [1], 4.0), run="m")
        keyed.upsert(rows(spark, [2], 5.0), run="u")
    assert keyed.table.version() == 5
    assert dict(content(keyed.read()))[900] == 0.0


@pytest.mark.parametrize("seed", range(2))
def test_random_writes_equal_a_dictionary(spark, tmp_path, seed):
    rnd = random.Random(seed)
    table = KeyedFiles.create(spark, str(tmp_path / "t"), rows(spark, []).schema, ["id", "name"], buckets=2, file_rows=4)
    wanted = {}
    for n in range(7):
        kind = rnd.choice(["insert", "merge", "merge", "upsert", "update", "compact"])
        keys = rnd.sample(range(40), rnd.randint(0, 8))
        if kind == "insert":
            keys = [k for k in keys if k not in wanted]
        if kind == "update":
            keys = [k for k in keys if k in wanted]
        if kind == "compact":
            table.compact(rnd.choice([0, 3]))
        else:
            getattr(table, kind)(rows(spark, keys, float(n)))
            wanted.update(dict.fromkeys(keys, float(n)))
        assert content(table.read()) == sorted(wanted.items()), (n, kind)
