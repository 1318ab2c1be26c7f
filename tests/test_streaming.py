from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.schema import ROLLUP_COLUMNS
from usage_rollup.sources.driverdata import download_log
from usage_rollup.streaming import start_incremental_rollup

SF = "/root/testdata/sf0.001"


def _land(log, path, cond):
    (log.where(cond).withColumn("log_date", F.to_date("timestamp"))
     .write.mode("append").partitionBy("log_date").parquet(path))


def test_incremental_stream_matches_batch_rollup(spark, scratch):
    src, target, ckpt = scratch("stream-src"), scratch("stream-rollup"), scratch("stream-ckpt")
    log = download_log(spark, SF, with_orders=False)
    ts = F.col("timestamp")
    _land(log, src, ts < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    q = start_incremental_rollup(spark, src, target, ckpt)
    q.awaitTermination(300)
    # late rows for an already-processed date plus new dates
    _land(log, src, ts >= F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    q = start_incremental_rollup(spark, src, target, ckpt)
    q.awaitTermination(300)
    # a replay of nothing new changes nothing
    q = start_incremental_rollup(spark, src, target, ckpt)
    q.awaitTermination(300)
    got = spark.read.parquet(target).select(*ROLLUP_COLUMNS)
    assertDataFrameEqual(got, daily_rollup(log).select(*ROLLUP_COLUMNS))


def test_micro_batch_scan_of_the_source_is_pruned_to_its_dates(spark, scratch, monkeypatch):
    from usage_rollup.streaming import incremental

    src, target, ckpt = scratch("prune-src"), scratch("prune-rollup"), scratch("prune-ckpt")
    log = download_log(spark, SF, with_orders=False)
    plans = []

    def upsert(spark_, target_, rollup, **kw):
        plans.append(rollup._jdf.queryExecution().executedPlan().toString())
        return 0

    monkeypatch.setattr(incremental, "upsert_by_key", upsert)
    _land(log, src, F.to_date("timestamp") < F.lit("2024-01-20"))
    start_incremental_rollup(spark, src, target, ckpt).awaitTermination(300)
    _land(log, src, F.to_date("timestamp") == F.lit("2024-01-20"))
    start_incremental_rollup(spark, src, target, ckpt).awaitTermination(300)
    filters = [line for line in plans[-1].replace("PartitionFilters", "\nPartitionFilters").splitlines()
               if line.startswith("PartitionFilters")]
    assert filters and all("2024-01-20" in f or "19742" in f for f in filters), filters
    assert not any("2024-01-10" in f for f in filters)
