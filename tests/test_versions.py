"""Tables of versions: every step of a writer can fail, and readers see the old or the new rows."""

import json

import pytest
from pyspark.sql import functions as F

from catalyne.sources import sinks
from catalyne.sources.files import Files
from catalyne.sources.versions import Conflict, VersionedTable

OLD = [(str(i), "a") for i in range(40)]


def frame(spark, rows, columns="code string, v string"):
    return spark.createDataFrame(rows, columns)


def held(table):
    return sorted(map(tuple, table.read().collect()))


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t.versions")
    t.replace(frame(spark, OLD), ["code"], buckets=8)
    return t


def files_of(t):
    state = t.state()
    return {b: sorted(t.files.names(f"data/{folder}/__bucket={b}")) for b, (folder, _) in state.parts.items()}


def test_untouched_buckets_keep_their_files(spark, table):
    before, state = files_of(table), table.state()
    table.upsert(frame(spark, [("3", "new"), ("3", "too")]), ["code"])
    after = files_of(table)
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1 and state.parts.keys() == table.state().parts.keys() and table.state().version == 1
    assert held(table) == sorted([r for r in OLD if r[0] != "3"] + [("3", "new"), ("3", "too")])
    assert sorted(map(tuple, table.read(0).collect())) == sorted(OLD)
    assert sorted(map(tuple, table.lookup(frame(spark, [("3",), ("7",), ("none",)], "code string")).collect())) == [("3", "new"), ("3", "too"), ("7", "a")]


@pytest.mark.parametrize("method", ["write", "publish", "names", "size", "read"])
@pytest.mark.parametrize("call", [1, 2])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_writer_that_fails_anywhere(spark, table, monkeypatch, method, call, when):
    """The call-th use of each file operation fails, before or after it has worked: the table is the old or the new one."""
    new = sorted([r for r in OLD if r[0] not in ("1", "2")] + [("1", "b"), ("2", "b")])
    real, seen = getattr(Files, method), [0]

    def breaks(self, *a, **k):
        seen[0] += 1
        if seen[0] == call and when == "before":
            raise OSError(method)
        out = real(self, *a, **k)
        if seen[0] == call:
            raise OSError(method)
        return out

    monkeypatch.setattr(Files, method, breaks)
    failed = False
    try:
        table.upsert(frame(spark, [("1", "b"), ("2", "b")]), ["code"])
    except OSError:
        failed = True
    monkeypatch.undo()
    got = held(table)
    assert got in (sorted(OLD), new) and (failed or got == new)
    table.upsert(frame(spark, [("1", "b"), ("2", "b")]), ["code"])
    assert held(table) == new


def test_a_batch_that_fails_while_it_is_written(spark, table):
    broken = frame(spark, [("1", "b")]).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        table.upsert(broken, ["code"])
    assert held(table) == sorted(OLD) and table.state().version == 0


def test_two_writers(spark, table, monkeypatch):
    """Another writer commits while this one writes: the batch is applied anew to what the other left."""
    real, first = VersionedTable._write, [True]

    def slow(self, rows, folder):
        if first.pop() if first else False:
            VersionedTable(spark, self.path).upsert(frame(spark, [("5", "other"), ("1", "other")]), ["code"])
        return real(self, rows, folder)

    monkeypatch.setattr(VersionedTable, "_write", slow)
    table.upsert(frame(spark, [("1", "mine")]), ["code"])
    rows = dict(held(table))
    assert (rows["5"], rows["1"], len(rows), table.state().version) == ("other", "mine", 40, 2)
    taken = table.state()
    monkeypatch.setattr(VersionedTable, "state", lambda self, version=None: taken)
    table._commit(taken, type(taken)(**{**taken.__dict__}))
    taken.version = 2
    with pytest.raises(Conflict):
        table._commit(taken, type(taken)(**{**taken.__dict__}))


def test_marks_columns_nulls_and_repeats(spark, table):
    batch = frame(spark, [("1", "b")])
    table.upsert(batch, ["code"], mark=("delta", "f2"))
    table.upsert(frame(spark, [("1", "older")]), ["code"], mark=("delta", "f1"))
    table.upsert(frame(spark, [("1", "again")]), ["code"], mark=("delta", "f2"))
    assert dict(held(table))["1"] == "b" and table.state().version == 1
    # Rows with a null key match none; a column that is new is null in old rows; a column that lacks is null in new ones.
    table.upsert(frame(spark, [(None, 1), (None, 1), ("2", 2)], "code string, w int"), ["code"])
    table.upsert(frame(spark, [(None, 3)], "code string, w int"), ["code"])
    rows = sorted(map(tuple, table.read().where("w is not null").collect()), key=repr)
    assert rows == sorted([(None, None, 1), (None, None, 1), (None, None, 3), ("2", None, 2)], key=repr)
    assert table.read().count() == 43
    table.upsert(frame(spark, [("9", "x", 1), ("9", "y", 2)], "code string, v string, w int"), ["code"], dedupe="w")
    assert [tuple(r) for r in table.read().where("code = '9'").collect()] == [("9", "y", 2)]
    table.upsert(frame(spark, [], "code string, v string, w int"), ["code"], mark=("delta", "f3"))
    assert table.state().marks == {"delta": "f3"} and table.read().count() == 43
    # Another key: all buckets are dealt anew.
    table.upsert(frame(spark, [("50", "y", 9)], "code string, v string, w int"), ["v"])
    assert [r["code"] for r in table.read().where("v = 'y'").collect()] == ["50"] and table.state().keys == ["v"]


def test_more_buckets_as_it_grows(spark, table, monkeypatch):
    monkeypatch.setattr("catalyne.sources.versions.MOST_BYTES", 64)
    table.upsert(frame(spark, [("1", "b")]), ["code"])
    assert table.state().buckets > 8 and len(held(table)) == 40 and dict(held(table))["1"] == "b"


def test_vacuum(spark, table):
    for v in "bcd":
        table.upsert(frame(spark, [("1", v)]), ["code"])
    assert table.vacuum(keep=2) == []
    gone = table.vacuum(keep=2, older_than=-5)
    assert len(gone) == 1 and dict(held(table))["1"] == "d" and table.read(2).count() == 40
    with pytest.raises(ValueError):
        table.read(0)


def test_tables_of_the_catalogue(spark):
    spark.sql("DROP DATABASE IF EXISTS t_versions CASCADE")
    rows = frame(spark, OLD)
    spark.sql("CREATE DATABASE t_versions")
    rows.write.saveAsTable("t_versions.products")
    sinks.upsert(frame(spark, [("1", "b")]), "t_versions.products")
    for read in (sinks.read_table, lambda s, t: s.table(t)):
        assert dict(map(tuple, read(spark, "t_versions.products").collect()))["1"] == "b"
    sinks.replace_table(rows.limit(3), "t_versions.products")
    assert spark.table("t_versions.products").count() == 3
    sinks.ensure_table(rows, "t_versions.none")
    assert spark.table("t_versions.none").columns == ["code", "v"] and sinks.read_table(spark, "t_versions.none").count() == 0
    sinks.drop_table(spark, "t_versions.products")
    assert not spark.catalog.tableExists("t_versions.products") and not sinks.versioned(spark, "t_versions.products").exists()


def test_quarantine_counts_in_the_pass_that_writes(spark, tmp_path):
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    rows = frame(spark, [(str(i), "a" if i % 3 else None) for i in range(30)]).mapInArrow(counted, "code string, v string")
    counts = sinks.quarantine(rows.withColumn("valid", F.col("v").isNotNull()), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert counts == {"records_in": 30, "records_out": 20, "records_rejected": 10} and scans.value == 30
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 10


def test_result_goes_to_the_log_where_it_cannot_be_written(spark, tmp_path, caplog):
    sinks.write_result(["a"], f"file://{tmp_path}/x/r.json")
    assert json.loads((tmp_path / "x/r.json").read_text()) == ["a"]
    (tmp_path / "file").write_text("")
    sinks.write_result(["b"], str(tmp_path / "file/r.json"))
    assert '["b"]' in caplog.text
