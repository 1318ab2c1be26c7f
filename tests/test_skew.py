"""Skew: a partition value holding most rows is written by several tasks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from usage_rollup.operators.maintain import OPEN_FILES, clustered, replace_range, unsorted_writes
from usage_rollup.sources import storage


def test_rebalanced_write_splits_a_hot_partition(spark, scratch):
    path = scratch("skew")
    df = (spark.range(0, 400_000, numPartitions=8)
          .withColumn("d", F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")))
          .withColumn("payload", F.sha2(F.col("id").cast("string"), 256)))
    prev = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(1 << 20))
    try:
        clustered(df, "d").write.partitionBy("d").parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", prev)
    hot_files = storage.count_files(spark, f"{path}/d=hot")
    cold_files = storage.count_files(spark, f"{path}/d=3")
    assert hot_files > 1, hot_files  # the hot value was split across tasks
    assert cold_files == 1, cold_files  # small values stay in one file
    assert spark.read.parquet(path).count() == 400_000


@pytest.mark.parametrize("query", ["incremental_stream_additive", "incremental_stream_rollup_all", "incremental_stream_rollup",
                                   "scan_log_folder", "delete_all_then_reload"])
def test_no_task_of_a_write_takes_or_sorts_a_whole_month(spark, monkeypatch, query):
    import __spark_entry__

    writes, plain = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        writes.append((int(self._spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0,
                       "RepartitionByExpression" in self._df._jdf.queryExecution().analyzed().toString()))
        return plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    __spark_entry__.queries()[query](spark, "/root/testdata/sf0.001")
    assert writes and set(writes) == {(True, False)}
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) <= 0


def test_more_partition_values_than_open_files(spark, scratch):
    path = scratch("many")
    df = spark.range(0, 3000, numPartitions=1).withColumn("d", F.col("id") % 130)
    with unsorted_writes(df):
        df.write.partitionBy("d").parquet(path)
    got = spark.read.parquet(path).groupBy("d").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    want = df.groupBy("d").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_load_into_an_emptied_folder_deals_out_no_staged_rows_again(spark, scratch, monkeypatch):
    target, plans, plain = scratch("emptied"), [], DataFrameWriter.parquet
    storage.write_text(spark, f"{target}/_SUCCESS", "")  # a delete of every row leaves the folder

    def parquet(self, path, *args, **kwargs):
        plans.append((path, "RebalancePartitions" in self._df._jdf.queryExecution().analyzed().toString()))
        return plain(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    rows = spark.range(5000).select((F.timestamp_seconds(F.col("id") * 3600)).alias("timestamp"), F.lit("p").alias("project"))
    assert replace_range(spark, rows, target, "timestamp", "1970-01-01", "1971-01-01", partition_col="m", grain="month") == 5000
    assert [hit for path, hit in plans if path == target] == [False]
    assert [hit for path, hit in plans if path != target] == [True]
    got = spark.read.parquet(target)
    assert got.select("timestamp", "project").exceptAll(rows).count() == 0 and got.count() == 5000


@pytest.mark.parametrize("parts", ["8", "1000"])
def test_shuffle_of_a_rebalanced_write_keeps_no_rows(spark, parts):
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        plan = clustered(spark.range(10).withColumn("d", F.col("id") % 3), "d")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    # beyond this number of parts Spark's shuffle orders a task's rows in memory
    assert ", 200), REBALANCE_PARTITIONS_BY_COL" in plan, plan


def test_thin_values_are_not_merged_into_one_task(spark, scratch):
    path, taken = scratch("thin"), {}
    df = spark.range(0, 300_000, numPartitions=4).select(
        (F.col("id") % 400).alias("d"), *[F.sha2((F.col("id") * 2 + i).cast("string"), 256).alias(f"p{i}") for i in (0, 1)])
    with unsorted_writes(df):
        clustered(df, "d").write.partitionBy("d").parquet(path)
    for r in spark.read.parquet(path).select("d", F.input_file_name().alias("f")).distinct().collect():
        taken.setdefault(r.f.rsplit("/", 1)[1].split("-")[1], set()).add(r.d)
    # more values than open files would make the task sort its rows
    assert max(map(len, taken.values())) <= OPEN_FILES, {k: len(v) for k, v in taken.items()}
    assert sum(map(len, taken.values())) == 400
    assert spark.read.parquet(path).count() == 300_000
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionNum", None) is None
