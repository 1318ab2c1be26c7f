"""Daily rollup: nested log rows -> one row per (date, 7 dimensions).

Plan shape: Parquet scan (nested leaves pruned, date range pushed as a
raw-timestamp range) -> Project -> HashAggregate(partial count) -> one
Exchange hashed on the 8 keys -> HashAggregate(final) -> Project(md5 key).

Skew: a hot (date, project, ...) group is collapsed by the map-side partial
aggregate to at most one row per input split before the shuffle, so even a
group holding a third of all rows costs one row per map task on the wire.
The MD5 key is computed after the aggregate: it is a function of the group
keys, so the result is equal and the shuffle carries 8 columns, not 9.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usage_rollup.functions.columns import day_bucket, load_id, python_major_minor
from usage_rollup.schema import ROLLUP_COLUMNS, ROLLUP_DIMENSIONS


def flatten_log(log: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Nested projection with renames; a NULL parent struct yields NULL leaves."""
    return log.select(
        day_bucket(ts).alias("download_date"),
        F.col("details.system.name").alias("system_name"),
        F.col("details.system.release").alias("system_release"),
        F.col("file.version").alias("version"),
        F.col("project"),
        F.col("country_code"),
        F.col("details.cpu").alias("cpu"),
        python_major_minor(F.col("details.python")).alias("python_version"),
    )


def daily_rollup(log: DataFrame, start=None, end=None, ts: str = "timestamp") -> DataFrame:
    """Count downloads per day and dimension; NULL is a group value.

    ``start``/``end`` bound the derived date half-open. The filter is written
    on ``to_date(ts)``; Catalyst turns it into a raw timestamp range that the
    Parquet reader receives as pushed filters.
    """
    flat = flatten_log(log, ts)
    if start is not None:
        flat = flat.where(F.col("download_date") >= F.to_date(F.lit(start)))
    if end is not None:
        flat = flat.where(F.col("download_date") < F.to_date(F.lit(end)))
    agg = flat.groupBy(*ROLLUP_DIMENSIONS).agg(F.count(F.lit(1)).alias("daily_download_sum"))
    return agg.withColumn("load_id", load_id()).select(*ROLLUP_COLUMNS)
