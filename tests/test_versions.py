"""Tables that survive a lost catalog, a type change, and a writer that fails half-way."""

from datetime import date
from pathlib import Path

import pytest

from tests.conftest import rows
from tillroll import versions
from tillroll.sinks import bind_table, tables, write_catalog
from tillroll.sources import scan_catalog, scan_versioned

DAY, NEXT = date(2024, 4, 27), date(2024, 4, 28)


@pytest.fixture
def put(spark, database):
    db, base = database

    def write(values, schema, **how):
        write_catalog(spark.createDataFrame(values, schema), db, "t", f"{base}/t", **how)

    write.path, write.db = f"{base}/t", db
    write.lose = lambda: spark.sql(f"DROP TABLE {db}.t")
    write.folders = lambda: sorted(p.name for p in Path(base).iterdir() if p.name.startswith("t"))
    return write


def test_versions_are_numbered_and_the_last_counts(spark, tmp_path):
    path = f"{tmp_path}/x"
    assert versions.current(spark, path) is None
    for n, folder in ((1, path), (2, f"{tmp_path}/x_12345678")):
        made = versions.publish(spark, path, folder, {"b": "int", "a`c": "string"}, ["day"])
        assert made == versions.current(spark, path) == versions.Version(n, folder, {"b": "int", "a`c": "string"}, ["day"])
    assert sorted(p.name for p in (tmp_path / "x" / "_versions").iterdir() if p.name[0] != ".") == ["00000001", "00000002"]
    with pytest.raises(ValueError, match="beside"):
        versions.publish(spark, path, "/elsewhere/x", {}, [])


def test_a_draft_is_no_version_and_a_taken_number_is_refused(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/x"
    versions.publish(spark, path, path, {"a": "int"}, [])
    (tmp_path / "x" / "_versions" / ".draft").write_text("{")
    assert versions.current(spark, path).number == 1
    monkeypatch.setattr(versions, "_numbers", lambda *_: [])
    with pytest.raises(RuntimeError, match="another writer"):
        versions.publish(spark, path, path, {"a": "bigint"}, [])
    monkeypatch.undo()
    assert versions.current(spark, path).columns == {"a": "int"}


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_all_rows_under_their_types_by_path_and_by_name(spark, put, fmt):
    put([(1, 10)], "id int, x int", fmt=fmt)
    put.lose()
    put([(2, 2.5)], "id int, x double", fmt=fmt)
    put.lose()
    put([(3, "word", "new")], "id int, x string, y string", fmt=fmt)
    text = fmt in ("csv", "json")  # whose files read as text as they are
    assert (len(put.folders()) == 1) == text
    by_path = scan_versioned(spark, put.path, fmt)
    want = [(1, "10" if text else "10.0", None), (2, "2.5", None), (3, "word", "new")]
    assert rows(by_path, "id") == want
    put.lose()
    bind_table(spark, put.db, "t", put.path, fmt)
    assert rows(scan_catalog(spark, put.db, "t"), "id") == want
    assert scan_catalog(spark, put.db, "t").schema == by_path.schema


def test_partitions_come_back_with_the_table(spark, put):
    put([(1, 10)], "id int, x int", partition={"day": DAY})
    put([(2, "b")], "id int, x string", partition={"day": NEXT})
    put.lose()
    put([(3, "c")], "id int, x string", partition={"day": NEXT}, mode="overwrite")
    want = [(1, "10", DAY), (3, "c", NEXT)]
    assert rows(scan_catalog(spark, put.db, "t"), "id") == want
    assert rows(scan_versioned(spark, put.path), "id") == want


@pytest.mark.parametrize("step", ["publish", "_create"])
def test_a_writer_that_fails_before_or_after_the_switch(spark, put, monkeypatch, step):
    """Before the switch the old version is whole; after it the new one is, and the next writer mends the catalog."""
    put([(1, 10)], "id int, x int")

    def fail(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(versions if step == "publish" else tables, step, fail)
    with pytest.raises(OSError, match="lost"):
        put([(2, "b")], "id int, x string")
    monkeypatch.undo()
    switched = step == "_create"
    assert rows(scan_versioned(spark, put.path)) == [(1, "10" if switched else 10)]
    if not switched:
        assert rows(scan_catalog(spark, put.db, "t")) == [(1, 10)]
    put([(2, "b")], "id int, x string")
    assert rows(scan_catalog(spark, put.db, "t"), "id") == [(1, "10"), (2, "b")]
    assert rows(scan_versioned(spark, put.path), "id") == [(1, "10"), (2, "b")]


def test_a_catalog_that_fell_behind_follows(spark, put):
    put([(1, 10)], "id int, x int")
    put([(2, "b")], "id int, x string")
    put.lose()
    spark.sql(f"CREATE TABLE {put.db}.t (id int, x int) USING parquet LOCATION '{put.path}'")  # as before the change
    put([(3, "c")], "id int, x string")
    assert rows(scan_catalog(spark, put.db, "t"), "id") == [(1, "10"), (2, "b"), (3, "c")]


def test_replacing_all_rows_keeps_a_version(spark, put):
    put([(1, 10)], "id int, x int")
    put([(2, 20, "y")], "id int, x int, z string", mode="overwrite")
    put.lose()
    put([(3, 30, "w")], "id int, x int, z string")
    assert rows(scan_versioned(spark, put.path), "id") == [(2, 20, "y"), (3, 30, "w")]


def test_tables_elsewhere_and_plain_folders_are_left_alone(spark, put, tmp_path):
    spark.createDataFrame([(1, 10)], "id int, x int").write.parquet(f"{tmp_path}/far/t")
    spark.sql(f"CREATE TABLE {put.db}.t (id int, x int) USING parquet LOCATION '{tmp_path}/far/t'")
    put([(2, 20)], "id int, x int")
    assert versions.current(spark, put.path) is None
    assert rows(scan_catalog(spark, put.db, "t"), "id") == [(1, 10), (2, 20)]
    assert rows(scan_versioned(spark, f"{tmp_path}/far/t"), "id") == [(1, 10), (2, 20)]
