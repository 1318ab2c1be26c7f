from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.params import JobParams
from usage_rollup.plans import run_ingest, run_reports, run_transform
from usage_rollup.plans.inspect import partition_filters
from usage_rollup.plans.transform import prune_log_dates
from usage_rollup.schema import ROLLUP_COLUMNS
from usage_rollup.sources import storage
from usage_rollup.sources.driverdata import download_log
from usage_rollup.sources.scan import load_rollup, resolve_source

SF = "/root/testdata/sf0.001"


def test_ingest_transform_report_end_to_end(spark, scratch):
    src, raw, rollup, export = scratch("src"), scratch("raw"), scratch("rollup"), scratch("export")
    log = download_log(spark, SF, with_orders=False)
    log.write.parquet(src)  # a plain (unpartitioned) source, read by path
    n = run_ingest(spark, src, raw, JobParams(project="alpha", start="2024-01-01", end="2024-02-01"))
    assert n == log.where(F.col("project") == "alpha").count()
    assert run_ingest(spark, src, raw, JobParams(project="nobody", start="2024-01-01", end="2024-02-01")) == 0
    assert len(storage.list_partitions(spark, raw, "log_date")) == 30

    src_df = resolve_source(spark, "external_source", root=raw)
    pruned = prune_log_dates(src_df, "2024-01-05", "2024-01-25")
    assert "log_date" in " ".join(partition_filters(pruned))

    run_transform(spark, rollup, "2024-01-05", "2024-01-25", root=raw, export_path=export)
    expected = daily_rollup(log.where(F.col("project") == "alpha"), "2024-01-05", "2024-01-25")
    assertDataFrameEqual(load_rollup(spark, rollup).select(*ROLLUP_COLUMNS), expected)
    assert spark.read.parquet(export).count() == expected.count()

    b = run_reports(spark, rollup, days=7, as_of="2024-01-31")
    assert b["total_downloads"].first()[0] == expected.agg(F.sum("daily_download_sum")).first()[0]
    assert b["top_versions"].count() <= 10


def test_transform_incremental_mode(spark, scratch):
    raw, rollup = scratch("raw"), scratch("rollup")
    log = download_log(spark, SF, with_orders=False)
    for p in ("alpha", "beta"):
        run_ingest(spark, log, raw, JobParams(project=p, start="2024-01-01", end="2024-02-01"), scope="project")
    run_transform(spark, rollup, "2024-01-01", "2024-01-10", root=raw, mode="incremental")
    run_transform(spark, rollup, "2024-01-08", "2024-02-01", root=raw, mode="incremental")
    assertDataFrameEqual(spark.read.parquet(rollup).select(*ROLLUP_COLUMNS), daily_rollup(log))


def test_resolve_source_catalog_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS usage_src_test")
    spark.sql("DROP TABLE IF EXISTS usage_src_test.pypi_file_downloads")
    download_log(spark, SF, with_orders=False).limit(5).write.saveAsTable("usage_src_test.pypi_file_downloads")
    assert resolve_source(spark, "warehouse", "usage_src_test").count() == 5


def test_collect_reports_concurrently(spark):
    from usage_rollup.plans import collect_reports

    rollup = daily_rollup(download_log(spark, SF))
    frames = run_reports(spark, rollup, days=30, as_of="2024-01-31")
    got = collect_reports(frames, workers=4)
    assert set(got) == set(frames)
    assert got["total_downloads"][0][0] == rollup.agg(F.sum("daily_download_sum")).first()[0]
    assert [tuple(r) for r in got["top_versions"]] == [tuple(r) for r in frames["top_versions"].collect()]


def test_reports_for_one_project(spark):
    rollup = daily_rollup(download_log(spark, SF))
    frames = run_reports(spark, rollup, days=0, as_of="2024-01-31", project="gamma")
    want = rollup.where(F.col("project") == "gamma").agg(F.sum("daily_download_sum")).first()[0]
    assert frames["total_downloads"].first()[0] == want
