"""Keyed upsert into a bucketed catalog table: the join needs no exchange of the target.

The target is partitioned by month and, within it, bucketed by the hash of the key. A
batch is dealt out by the same hash into as many buckets, so rows that share a key are
already in one task: Spark plans the anti-join, the union with the batch and the write
without shuffling the stored rows. Only the batch moves. For rollups whose months are so
large that shuffling a touched month at every upsert is what an upsert costs.

The touched months' new content goes to a second table of the same layout, since Spark
does not overwrite a table that it is reading; from there it replaces the months by a dynamic
partition overwrite, bucket by bucket. Unlike a versioned table this keeps no older version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usage_rollup.operators.maintain import ROLLUP_PARTITION, with_rollup_partition
from usage_rollup.session import scratch_dir
from usage_rollup.sources import storage

KEY = "load_id"
#: Spark drops a bucketed scan that it thinks nothing needs; the write does.
AUTO_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_bucketed(spark: SparkSession, rollup: DataFrame, table: str, buckets: int, key: str = KEY,
                    partition_col: str = ROLLUP_PARTITION) -> None:
    """Write ``rollup`` as a new table of ``buckets`` buckets a month, one file each."""
    rows = with_rollup_partition(rollup, partition_col).repartition(buckets, key)
    rows.write.partitionBy(partition_col).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def bucket_count(spark: SparkSession, table: str) -> int:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r.col_name == "Num Buckets":
            return int(r.data_type)
    raise ValueError(f"{table} is not bucketed")


def upserted(old: DataFrame, batch: DataFrame, buckets: int, key: str = KEY) -> DataFrame:
    """``old`` (bucketed by ``key``) without the batch's keys, plus the batch; laid out by bucket."""
    batch = batch.select(*old.columns).repartition(buckets, key)
    keys = batch.select(F.col(key).alias("_k")).distinct()
    # a merge join whatever the batch's size: it leaves the stored rows in their buckets
    left = old.join(keys.hint("merge"), F.col(key) == F.col("_k"), "left_anti")
    # dropped from the plan where both sides are laid out so already
    return left.unionByName(batch).repartition(buckets, key)


def upsert_bucketed(spark: SparkSession, table: str, batch: DataFrame, key: str = KEY,
                    partition_col: str = ROLLUP_PARTITION) -> int:
    """Replace rows by key in a bucketed table; returns the batch's rows. The key determines the month."""
    buckets = bucket_count(spark, table)
    path, pending = scratch_dir(spark, "bucketed-batch"), f"{table}_pending_{uuid.uuid4().hex[:8]}"
    before = {name: spark.conf.get(name) for name in (AUTO_BUCKETS, OVERWRITE_MODE)}
    try:
        batch = with_rollup_partition(batch, partition_col)
        batch.write.parquet(path)
        staged = spark.read.schema(batch.schema).parquet(path)
        touched = [r[0] for r in staged.select(partition_col).distinct().collect()]  # months
        if not touched:
            return 0
        spark.conf.set(AUTO_BUCKETS, "false")
        spark.conf.set(OVERWRITE_MODE, "dynamic")  # insertInto takes it from the session alone
        month = F.col(partition_col)
        cond = month.isin([m for m in touched if m is not None])
        old = spark.table(table).where(cond | month.isNull() if None in touched else cond)
        rows = upserted(old, staged, buckets, key)
        rows.write.partitionBy(partition_col).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(pending)
        # one task a bucket again, so one file a month and bucket
        spark.table(pending).select(*old.columns).write.mode("overwrite").insertInto(table)
        return staged.count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        spark.sql(f"DROP TABLE IF EXISTS {pending}")
        storage.delete_path(spark, path)
