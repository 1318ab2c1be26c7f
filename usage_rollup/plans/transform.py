"""Transform job: resolve source -> daily rollup -> materialize -> export.

``mode="full"`` rewrites the rollup (development target); ``"incremental"``
replaces rows by ``load_id`` (production target). The export runs after a
full build, as the development post-step does.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from usage_rollup.operators import versions
from usage_rollup.operators.maintain import export_partitioned, write_rollup
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.params import DEFAULT_EXPORT_ROWS, DEFAULT_TABLE
from usage_rollup.schema import ROLLUP_COLUMNS
from usage_rollup.sources.scan import load_rollup, resolve_source, within_partitions


def prune_log_dates(src, start=None, end=None, partition_col: str | None = None, grain: str | None = None):
    """Add bounds on the raw table's partition column (days or months) when it has one.

    A partition is the day of the timestamp, or the first day of its month, so the
    bounds hold for all rows of the rollup's own half-open date range; stated on the
    partition column they let the file index skip directories instead of relying on
    row-group statistics alone.
    """
    first = None if start is None else F.to_date(F.lit(start))
    last = None if end is None else F.date_sub(F.to_date(F.lit(end)), 1)
    return within_partitions(src, first, last, partition_col, grain)


def run_transform(
    spark: SparkSession,
    target,
    start=None,
    end=None,
    data_source: str = "external_source",
    database: str | None = None,
    root=None,
    mode: str = "full",
    export_path: str | None = None,
    export_rows: int = DEFAULT_EXPORT_ROWS,
    grain: str = "month",
    log_partition: str | None = None,
    log_grain: str | None = None,
    ts: str = "timestamp",
    table: str = DEFAULT_TABLE,
) -> int:
    """Roll up the raw log and write it; returns rows written.

    ``target`` (and ``root``) may be a path, a catalog table's name or a
    ``VersionedTable``. ``log_partition`` and ``log_grain`` name the raw table's
    partition column where it is not ``log_date`` or ``log_month``.
    """
    versioned = isinstance(root, versions.VersionedTable)
    src = root.read() if versioned else resolve_source(spark, data_source, database, root, table)
    rollup = daily_rollup(prune_log_dates(src, start, end, log_partition, log_grain), start, end, ts)
    if isinstance(target, versions.VersionedTable):
        n = versions.write_rollup(target, rollup, mode, grain)
    else:
        n = write_rollup(spark, rollup, target, mode, grain)
    if export_path and mode == "full":
        export_partitioned(load_rollup(spark, target).select(*ROLLUP_COLUMNS), "download_date", export_path,
                           row_group_rows=export_rows)
    return n
