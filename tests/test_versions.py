"""Versioned publish: one version for readers, crashes in any step, restore, two writers, file-level rewrites."""

import datetime as dt
import os

import pytest

from usage_rollup.operators import maintain, versions
from usage_rollup.operators.quality import DataQualityError
from usage_rollup.operators.versions import ConcurrentWriteError, VersionedTable
from usage_rollup.sources import storage

SCHEMA = "load_id string, download_date date, n long, download_month date"


def day(i):
    return dt.date(2023, 3, 1) + dt.timedelta(days=i)


@pytest.fixture()
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "rollup"), "download_month", bloom_col="load_id")


def rows(spark, days, n):
    return spark.createDataFrame([(f"k{i}", day(i), n, day(i).replace(day=1)) for i in days], SCHEMA)


def content(df):
    return sorted((r.load_id, r.n) for r in df.collect())


def data_files(table):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{table.root}/data") for f in names if f.endswith(".parquet")}


def test_versions_and_restore(spark, table):
    assert table.current() == 0
    with pytest.raises(ValueError):
        table.read()
    assert versions.refresh(table, rows(spark, range(3), 1)) == 3
    assert versions.upsert(table, rows(spark, [2, 40], 2)) == 2
    assert content(table.read()) == [("k0", 1), ("k1", 1), ("k2", 2), ("k40", 2)]
    assert content(table.read(1)) == [("k0", 1), ("k1", 1), ("k2", 1)]
    assert table.restore(1) == 3
    assert content(table.read()) == content(table.read(1))
    assert [r.operation for r in table.history().orderBy("version").collect()] == ["refresh", "upsert", "restore 1"]
    with pytest.raises(ValueError):
        table.read(9)


def test_reader_keeps_its_version_during_a_publish(spark, table):
    versions.refresh(table, rows(spark, range(3), 1))
    before = table.read()
    change = table.begin("refresh")
    new = change.write(rows(spark, range(3), 7))
    assert content(table.read()) == content(before) == [("k0", 1), ("k1", 1), ("k2", 1)]
    change.commit(new, rows(spark, [0], 7).schema)
    assert content(before) == [("k0", 1), ("k1", 1), ("k2", 1)]
    assert content(table.read()) == [("k0", 7), ("k1", 7), ("k2", 7)]


@pytest.mark.parametrize("step", ["write", "put_if_absent", "replace_text"])
def test_crash_in_any_step_twice(spark, table, monkeypatch, step):
    versions.refresh(table, rows(spark, range(3), 1))

    def crash(*_args, **_kw):
        raise KeyboardInterrupt

    for _ in range(2):
        with monkeypatch.context() as m:
            if step == "write":
                m.setattr(versions.Change, "commit", crash)
            else:
                m.setattr(storage, step, crash)
            with pytest.raises(KeyboardInterrupt):
                versions.refresh(table, rows(spark, [0], 5))
        # either the old or the new version, whole; the publish itself is the only step that matters
        want = [("k0", 5)] if step == "replace_text" else [("k0", 1), ("k1", 1), ("k2", 1)]
        if step == "replace_text":
            break
        assert content(table.read()) == want
    if step == "replace_text":
        # published, though the pointer is behind: readers look for later versions and find whole data or none
        assert table.current() == 2 and content(table.read()) == want
    assert versions.refresh(table, rows(spark, [1], 6)) == 1
    assert content(table.read()) == [("k1", 6)]


def test_two_writers(spark, table):
    versions.refresh(table, rows(spark, range(2), 1))
    slow = table.begin("refresh")
    parts = slow.write(rows(spark, [0], 9))
    versions.upsert(table, rows(spark, [5], 2))
    with pytest.raises(ConcurrentWriteError):
        slow.commit(parts, rows(spark, [0], 9).schema)
    assert content(table.read()) == [("k0", 1), ("k1", 1), ("k5", 2)]
    assert not any(slow.token in f for f in data_files(table))


def test_upsert_rewrites_only_files_with_matched_keys(spark, table):
    first = rows(spark, range(20), 1).repartitionByRange(5, "download_date")
    change = table.begin("load")
    change.commit(change.write(first, cluster=False), first.schema)
    before = data_files(table)
    assert len(before) == 5
    versions.upsert(table, rows(spark, [3], 4), within="download_date")
    named = {f for e in table.manifest().parts["2023-03-01"] for f in (e[1] or [])}
    assert len(named & {os.path.basename(f) for f in before}) == 4  # kept by name
    assert before <= data_files(table)  # nothing overwritten
    assert content(table.read()) == sorted((f"k{i}", 4 if i == 3 else 1) for i in range(20))
    # again, now that folders are already split into files; a key that stands nowhere touches no old file
    versions.upsert(table, rows(spark, [3, 25], 5))
    assert content(table.read()) == sorted([(f"k{i}", 5 if i == 3 else 1) for i in range(20)] + [("k25", 5)])


def test_upsert_equals_the_frame_form(spark, table, monkeypatch):
    old, batch = rows(spark, range(0, 60, 2), 1), rows(spark, range(0, 60, 3), 2).union(rows(spark, [6], 3))
    for literals in (versions.KEY_LITERALS, 3):  # with and without the keys as literals
        monkeypatch.setattr(versions, "KEY_LITERALS", literals)
        versions.refresh(table, old)
        versions.upsert(table, batch)
        assert content(table.read()) == content(maintain.upsert_frame(old, batch))


def test_bloom_filters_are_written(spark, table):
    versions.refresh(table, rows(spark, range(50), 1))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sorted(data_files(table))[0])
    hadoop = jvm.org.apache.parquet.hadoop
    reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(path, spark.sparkContext._jsc.hadoopConfiguration()))
    try:
        columns = reader.getFooter().getBlocks()[0].getColumns()
        found = {c.getPath().toDotString(): c.getBloomFilterOffset() > 0 for c in columns}
    finally:
        reader.close()
    assert found["load_id"] and not found["n"]


LOG = "timestamp timestamp, project string, n int"


def log_rows(spark, days, project="a", n=0):
    return spark.createDataFrame([(dt.datetime(2023, 3, 1) + dt.timedelta(days=i, hours=1), project, n) for i in days], LOG)


def test_replace_range(spark, tmp_path):
    table = versions.log_table(spark, str(tmp_path / "log"))
    assert versions.replace_range(table, log_rows(spark, range(5)), start="2023-03-01", end="2023-03-08") == 5
    assert versions.replace_range(table, log_rows(spark, [1], n=1), start="2023-03-02", end="2023-03-04") == 1
    got = sorted((r.timestamp.day, r.n) for r in table.read().collect())
    assert got == [(1, 0), (2, 1), (4, 0), (5, 0)]  # day 3 lost its rows
    # nothing staged: no new version; a load that the gate rejects: no new version, no data left
    assert versions.replace_range(table, log_rows(spark, []), start="2023-03-01", end="2023-04-01") == 0
    files = data_files(table)
    with pytest.raises(DataQualityError):
        versions.replace_range(table, log_rows(spark, range(9), project=None), start="2023-03-01", end="2023-04-01")
    assert table.current() == 2 and data_files(table) == files
    # scoped: only the staged projects lose rows
    versions.replace_range(table, log_rows(spark, [1], "b"), start="2023-03-01", end="2023-04-01", scope="project")
    assert table.read().count() == 5
    assert versions.delete_range(table, "timestamp", "2000-01-01", "2000-02-01") == 3  # nothing stored there


def test_null_dates_and_emptied_table(spark, tmp_path):
    table = versions.log_table(spark, str(tmp_path / "log"))
    odd = log_rows(spark, range(40)).union(spark.createDataFrame([(None, "a", 9)], LOG))
    versions.replace_range(table, odd, start="2023-03-01", end="2023-05-01")
    versions.delete_range(table, "timestamp", "2023-03-01", "2023-05-01")
    assert [(r.timestamp, r.n) for r in table.read().collect()] == [(None, 9)]  # in no range
    change = table.begin("empty")
    change.commit({}, table.manifest().schema)
    assert table.read().count() == 0 and "log_date" in table.read().columns
    versions.append(table, log_rows(spark, [0]).withColumn("log_date", maintain.log_partition("timestamp")))
    assert table.read().count() == 1


def test_other_columns_are_refused(spark, table):
    versions.refresh(table, rows(spark, range(2), 1))
    with pytest.raises(ValueError, match="columns differ"):
        versions.upsert(table, rows(spark, [1], 1).withColumnRenamed("n", "m"))
    versions.refresh(table, rows(spark, range(2), 1).withColumnRenamed("n", "m"))  # a refresh may change them
    assert "m" in table.read().columns and "n" in table.read(1).columns


def test_vacuum(spark, table):
    for n in range(4):
        versions.refresh(table, rows(spark, range(3), n))
    assert table.vacuum(keep=2) == []  # all folders are young
    assert table.versions() == [3, 4]
    assert len(table.vacuum(keep=2, grace_seconds=-5)) == 2
    assert content(table.read(3)) == [("k0", 2), ("k1", 2), ("k2", 2)]
    assert content(table.read()) == [("k0", 3), ("k1", 3), ("k2", 3)]
