"""Plan assertions: the physical plans we rely on for scale."""

from usage_rollup.operators import reports as R
from usage_rollup.operators.maintain import export_partitioned
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.params import JobParams
from usage_rollup.plans.inspect import count_nodes, partition_filters, plan_text, pushed_filters, read_schemas
from usage_rollup.sources.driverdata import download_log
from usage_rollup.sources.scan import read_partitioned, scan_log

SF = "/root/testdata/sf0.001"


def _log_path(spark, scratch):
    p = scratch("plan-log")
    download_log(spark, SF).write.parquet(p)
    return p


def test_scan_pushes_project_and_range(spark, scratch):
    p = _log_path(spark, scratch)
    df = scan_log(spark, p, JobParams(project="alpha", start="2024-01-10", end="2024-01-20"))
    pf = " ".join(pushed_filters(df))
    assert "EqualTo(project,alpha)" in pf
    assert "GreaterThanOrEqual(timestamp" in pf and "LessThan(timestamp" in pf


def test_rollup_one_shuffle_pruned_leaves_and_raw_range(spark, scratch):
    p = _log_path(spark, scratch)
    r = daily_rollup(spark.read.parquet(p), "2024-01-05", "2024-01-25")
    assert count_nodes(r, "Exchange") == 1
    rs = read_schemas(r)[0]
    assert "file:struct<version:string>" in rs and "url" not in rs and "tls_cipher" not in rs
    pf = " ".join(pushed_filters(r))
    assert "GreaterThanOrEqual(timestamp,2024-01-05" in pf and "LessThan(timestamp,2024-01-25" in pf
    assert "partial_count" in plan_text(r)


def test_top_n_is_fused(spark, scratch):
    p = _log_path(spark, scratch)
    r = daily_rollup(spark.read.parquet(p))
    for q in (R.top_versions(r, 7, "2024-01-31"), R.top_runtimes(r), R.top_countries(r)):
        assert "TakeOrderedAndProject" in plan_text(q, "simple")


def test_weekly_subquery_not_a_join(spark, scratch):
    p = _log_path(spark, scratch)
    r = daily_rollup(spark.read.parquet(p))
    text = plan_text(R.weekly_series(r, "2024-01-31"), "simple")
    assert "Subquery" in text and "Join" not in text and "CartesianProduct" not in text


def test_export_read_prunes_partitions(spark, scratch):
    p = scratch("plan-export")
    export_partitioned(daily_rollup(download_log(spark, SF)), "download_date", p)
    df = read_partitioned(spark, p, "1998-03-15", "1999-02-10")
    pf = " ".join(partition_filters(df))
    assert "year" in pf and "month" in pf


def test_streaming_recompute_prunes_partitions_dynamically(spark, scratch):
    from pyspark.sql import functions as F

    src = scratch("plan-src")
    (download_log(spark, SF, with_orders=False).withColumn("log_date", F.to_date("timestamp"))
     .write.partitionBy("log_date").parquet(src))
    batch = spark.read.parquet(src).where(F.col("log_date") == F.lit("2024-01-05").cast("date"))
    dates = batch.select(F.to_date("timestamp").alias("_d")).distinct()
    full = spark.read.option("basePath", src).parquet(src)
    affected = full.join(dates, F.col("log_date") == F.col("_d"), "left_semi")
    assert "dynamicpruningexpression" in plan_text(daily_rollup(affected), "simple")


def test_scan_prunes_date_partitions(spark, scratch):
    from pyspark.sql import functions as F

    src = scratch("plan-raw")
    (download_log(spark, SF, with_orders=False).withColumn("log_date", F.to_date("timestamp"))
     .write.partitionBy("log_date").parquet(src))
    df = scan_log(spark, src, JobParams(project="alpha", start="2024-01-10", end="2024-01-20 06:00:00"))
    import re

    pf = re.sub(r"#\d+", "", " ".join(partition_filters(df)))
    assert "log_date >= 2024-01-10" in pf and "log_date <= 2024-01-20" in pf
    raw = spark.read.parquet(src)
    ts = F.col("timestamp")
    want = raw.where((F.col("project") == "alpha") & (ts >= F.lit("2024-01-10").cast("timestamp_ntz"))
                     & (ts < F.lit("2024-01-20 06:00:00").cast("timestamp_ntz"))).count()
    assert df.count() == want


def test_upsert_reads_only_touched_partitions_and_breakdowns_limit_early(spark, scratch):
    import re

    from pyspark.sql import functions as F

    from usage_rollup.operators import maintain as M

    rp = scratch("plan-rollup")
    M.write_rollup(spark, daily_rollup(download_log(spark, SF)), rp)
    old = spark.read.parquet(rp).where(F.col("download_month").isin([F.lit("2024-01-01").cast("date")]))
    batch = M.with_rollup_partition(daily_rollup(download_log(spark, SF), "2024-01-20", "2024-01-25"))
    text = re.sub(r"#\d+", "", " ".join(partition_filters(M.upsert_frame(old, batch))))
    assert "download_month" in text
    top = R.top_breakdowns(spark.read.parquet(rp), 30, "2024-01-31")
    plan = plan_text(top, "simple")
    assert "WindowGroupLimit" in plan and "Partial" in plan
