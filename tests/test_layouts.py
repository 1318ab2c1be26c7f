"""Exact chunks, row groups, bucketed upserts, the log folder source, additive streaming, interrupted refreshes."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from usage_rollup.operators import bucketed, maintain, versions
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.params import JobParams
from usage_rollup.plans import run_ingest, run_transform
from usage_rollup.plans.inspect import partition_filters, plan_text
from usage_rollup.plans.transform import prune_log_dates
from usage_rollup.schema import ROLLUP_COLUMNS
from usage_rollup.session import local_path
from usage_rollup.sources import storage
from usage_rollup.sources.driverdata import download_log
from usage_rollup.sources.log_folder import read_log_folder
from usage_rollup.sources.scan import scan_log
from usage_rollup.streaming import additive, incremental

SF = "/root/testdata/sf0.001"


def parquet_files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(local_path(path)) for f in names if f.endswith(".parquet")]


def rows_per_file(path):
    return sorted((pq.ParquetFile(f).metadata.num_rows for f in parquet_files(path)), reverse=True)


@pytest.mark.parametrize("tasks", [1, 3, 7])
def test_exact_chunks(spark, scratch, tasks):
    path = scratch("chunks")
    assert maintain.append_exact(spark.range(1000).repartition(tasks), path, 100) == 1000
    assert rows_per_file(path) == [100] * 10
    assert maintain.append_exact(spark.range(1000, 1250).repartition(tasks), path, 100) == 250
    assert rows_per_file(path) == [100] * 12 + [50]
    assert spark.read.parquet(path).distinct().count() == 1250


def test_exact_chunks_within_partitions_and_empty(spark, scratch):
    path = scratch("chunks")
    df = spark.range(230).select("id", F.when(F.col("id") >= 10, F.col("id") % 2).alias("p")).repartition(5)
    assert maintain.append_exact(df, path, 50, ["p"]) == 230
    assert rows_per_file(path) == [50, 50, 50, 50, 10, 10, 10]
    assert maintain.append_exact(df.where("id < 0"), path, 50, ["p"]) == 0
    with pytest.raises(ValueError):
        maintain.append_exact(df, path, 0)


def test_row_groups_are_bounded_by_rows(spark, scratch):
    path = scratch("groups")
    df = spark.range(5000).select(F.lit(dt.date(2023, 5, 2)).alias("download_date"), "id").coalesce(1)
    maintain.export_partitioned(df, "download_date", path, row_group_rows=700)
    sizes = [m.row_group(i).num_rows for f in parquet_files(path) for m in [pq.ParquetFile(f).metadata] for i in range(m.num_row_groups)]
    assert sum(sizes) == 5000 and max(sizes) <= 700 and len(sizes) >= 8


def rollup_rows(spark, days, n):
    rows = [(f"k{i}", dt.date(2023, 3, 1) + dt.timedelta(days=i), n) for i in days]
    return spark.createDataFrame(rows, "load_id string, download_date date, n long")


def test_interrupted_upsert_then_failed_refresh_loses_nothing(spark, scratch, monkeypatch):
    path = scratch("refresh")
    maintain.write_rollup(spark, rollup_rows(spark, range(3), 1), path)

    def dies(spark_, new_path, target, part, touched, *_):
        for value in touched:
            storage.delete_partition(spark_, target, part, value)
        raise RuntimeError("died while swapping")

    with monkeypatch.context() as m:
        m.setattr(maintain, "_swap_in", dies)
        with pytest.raises(RuntimeError):
            maintain.upsert_by_key(spark, path, rollup_rows(spark, [1], 2))
    assert not storage.has_data(spark, path)
    bad = rollup_rows(spark, [1], 2).withColumn("n", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        maintain.write_rollup(spark, bad, path)
    got = sorted((r.load_id, r.n) for r in spark.read.parquet(path).collect())
    assert got == [("k0", 1), ("k1", 2), ("k2", 1)]
    with pytest.raises(ValueError, match="columns differ"):
        maintain.write_rollup(spark, rollup_rows(spark, [1], 2).withColumnRenamed("n", "m"), path)


def test_bucketed_upsert(spark):
    name = "bucketed_upsert_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    old, batch = rollup_rows(spark, range(70), 1), rollup_rows(spark, range(0, 20, 3), 2).union(rollup_rows(spark, [3, 200], 3))
    bucketed.create_bucketed(spark, old, name, 4)
    assert bucketed.upsert_bucketed(spark, name, batch) == 9
    got = sorted((r.load_id, r.n) for r in spark.table(name).collect())
    want = maintain.upsert_frame(old, batch, partition_col=None)
    assert got == sorted((r.load_id, r.n) for r in want.collect())
    assert bucketed.upsert_bucketed(spark, name, batch.where("n > 9")) == 0
    before = spark.conf.get(bucketed.AUTO_BUCKETS)
    try:
        spark.conf.set(bucketed.AUTO_BUCKETS, "false")
        plan = plan_text(bucketed.upserted(spark.table(name), maintain.with_rollup_partition(batch), 4), "simple")
    finally:
        spark.conf.set(bucketed.AUTO_BUCKETS, before)
    # walk up from the target's scan to the join: sorts and filters only
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*("))
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in above[:join]), plan
    assert not any("Exchange" in line for line in above[join:]), plan  # nor between the join and the write


def test_log_folder_never_opens_what_cannot_match(spark, scratch):
    path = scratch("landing")
    log = download_log(spark, SF, with_orders=False).withColumn("log_date", F.to_date("timestamp"))
    for project in ("alpha", "beta"):
        log.where(F.col("project") == project).repartition("log_date").write.partitionBy("log_date").parquet(f"{path}/project={project}")
    params = JobParams(project="alpha", start="2024-01-10", end="2024-01-12 06:00:00")
    whole = read_log_folder(spark, path, timestamp_ntz="true")
    assert whole.count() == log.count()
    for f in parquet_files(path):  # break every file that the query has no business with
        if "project=beta" in f or not any(f"log_date=2024-01-{d}" in f for d in (10, 11, 12)):
            with open(f, "wb") as out:
                out.write(b"not parquet")
    got = scan_log(spark, read_log_folder(spark, path, timestamp_ntz="true", partition_bytes=2000), params)
    want = scan_log(spark, log, params)
    assertDataFrameEqual(got, want)
    assert got.rdd.getNumPartitions() > 1
    none = scan_log(spark, read_log_folder(spark, path, timestamp_ntz="true"), params.with_(start="2030-01-01", end="2030-02-01"))
    assert none.count() == 0


def test_log_folder_of_json(spark, scratch):
    from helpers import log_row
    from usage_rollup.sources.scan import mock_log

    path = scratch("landing-json")
    rows = [log_row("2019-08-06 10:00:00", project="pkg", version="1.0"), log_row("2019-08-06 11:00:00", project="other")]
    mock_log(spark, rows).write.json(f"{path}/log_month=2019-08-01")
    got = scan_log(spark, read_log_folder(spark, path, file_format="json"), JobParams(project="pkg", start="2019-08-01", end="2019-09-01"))
    assert [(r.project, r.file.version) for r in got.collect()] == [("pkg", "1.0")]


def month_log(spark, path, log=None):
    log = download_log(spark, SF) if log is None else log
    log.withColumn("log_month", maintain.log_partition("timestamp", "month")).repartition("log_month") \
        .write.mode("append").partitionBy("log_month").parquet(path)
    return path


def test_month_folders_are_pruned_in_scan_transform_and_stream(spark, scratch, monkeypatch):
    path = month_log(spark, scratch("months"))
    raw = spark.read.parquet(path)
    scan = scan_log(spark, path, JobParams(project="alpha", start="2024-01-10", end="2024-01-20"))
    assert "log_month" in " ".join(partition_filters(scan)) and scan.count() > 0
    pruned = daily_rollup(prune_log_dates(raw, "1997-03-15", "1997-05-01"), "1997-03-15", "1997-05-01")
    text = " ".join(partition_filters(pruned))
    assert "1997-03-01" in text and "1997-04-30" in text
    assertDataFrameEqual(pruned, daily_rollup(raw, "1997-03-15", "1997-05-01"))
    plans = []
    monkeypatch.setattr(incremental, "upsert_by_key",
                        lambda s, t, rollup, **kw: plans.append((rollup._jdf.queryExecution().executedPlan().toString(), rollup.count())))
    batch = raw.where("timestamp >= '1997-03-15' and timestamp < '1997-03-18'")
    incremental.upsert_affected_dates(spark, batch, path, "unused")
    plan, n = plans[0]
    part = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "log_month" in part and n == daily_rollup(raw, "1997-03-15", "1997-03-18").count()


def test_additive_stream_replay_crash_and_late_files(spark, scratch, monkeypatch):
    src, ckpt = scratch("add-src"), scratch("add-ckpt")
    table = versions.rollup_table(spark, scratch("add-table"))
    log = download_log(spark, SF, with_orders=False)
    late = F.dayofmonth("timestamp") % 5 == 0
    month_log(spark, src, log.where(~late))
    real = versions.Change.commit

    def dies_after(self, *a, **kw):
        real(self, *a, **kw)
        raise RuntimeError("died after the publish")

    with monkeypatch.context() as m:  # published, but the stream's checkpoint does not know
        m.setattr(versions.Change, "commit", dies_after)
        q = additive.start_additive_rollup(spark, src, table, ckpt)
        with pytest.raises(Exception, match="died after"):
            q.awaitTermination(300)
    assert additive.last_batch(table, "log") == 0
    additive.start_additive_rollup(spark, src, table, ckpt).awaitTermination(300)  # replays batch 0
    assertDataFrameEqual(additive.read_rollup(table), daily_rollup(log.where(~late)))
    month_log(spark, src, log.where(late))  # rows of dates that are in the table already
    with monkeypatch.context() as m:  # dies before the publish
        m.setattr(versions.storage, "put_if_absent", lambda *a: (_ for _ in ()).throw(RuntimeError("died before")))
        q = additive.start_additive_rollup(spark, src, table, ckpt)
        with pytest.raises(Exception, match="died before"):
            q.awaitTermination(300)
    additive.start_additive_rollup(spark, src, table, ckpt).awaitTermination(300)
    assertDataFrameEqual(additive.read_rollup(table), daily_rollup(log))
    partial = table.read().count()
    assert additive.compact(table) == ["2024-01-01"] and additive.compact(table) == []
    assert table.read().count() <= partial and all(len(e) == 1 for e in table.manifest().parts.values())
    assertDataFrameEqual(additive.read_rollup(table), daily_rollup(log))


def test_jobs_over_versioned_tables_and_default_target(spark, scratch):
    log = download_log(spark, SF, with_orders=False)
    raw, rollup = versions.log_table(spark, scratch("v-raw")), versions.rollup_table(spark, scratch("v-rollup"))
    params = JobParams(project="alpha", start="2024-01-01", end="2024-02-01", database="usage_jobs_test", table="raw_log")
    for _ in range(2):
        n = run_ingest(spark, log, raw, params)
    assert raw.current() == 2 and raw.read().count() == n
    export = scratch("v-export")
    run_transform(spark, rollup, root=raw, export_path=export)
    assertDataFrameEqual(rollup.read().select(*ROLLUP_COLUMNS), daily_rollup(log.where("project = 'alpha'")))
    assert spark.read.parquet(export).count() == rollup.read().count()
    spark.sql("DROP DATABASE IF EXISTS usage_jobs_test CASCADE")
    assert run_ingest(spark, log, None, params) == n  # creates the database and the table of the parameters
    assert spark.table("usage_jobs_test.raw_log").count() == n
