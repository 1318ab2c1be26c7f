"""Sources: filtered/projected log scans, partitioned reads, source choice.

All readers are lazy DataFrames; the row restriction and the column list
are plain ``where``/``select`` so Catalyst pushes them into the scan
(``PushedFilters`` / ``ReadSchema``) instead of filtering after a full read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usage_rollup.functions.columns import half_open
from usage_rollup.functions.dates import partition_bounds, session_zone
from usage_rollup.params import JobParams
from usage_rollup.schema import LOG_COLUMNS, log_schema


# Formats whose files carry no schema.
SCHEMALESS = ("json", "csv", "xml")
FILE_FORMATS = ("parquet", "orc", "avro", "text", *SCHEMALESS)


def log_predicate(params: JobParams, ts_type=None) -> Column:
    """Project equality AND half-open ``[start, end)`` on the timestamp column."""
    ts_type = ts_type or "timestamp"
    return (F.col("project") == F.lit(params.project)) & half_open(
        params.ts_col, params.start, params.end, ts_type
    )


#: Partition columns of a raw log by convention, with the span of their values.
LOG_PARTITIONS = {"log_date": "day", "log_month": "month"}


def log_partition_of(df: DataFrame, column: str | None = None, grain: str | None = None) -> tuple[str, str] | None:
    """(partition column, grain) of a raw log: the one named, or the conventional one it has."""
    names = [column] if column else list(LOG_PARTITIONS)
    for name in names:
        if name in df.columns:
            return name, grain or LOG_PARTITIONS.get(name, "day")
    return None


def within_partitions(df: DataFrame, first: Column | None, last: Column | None, column: str | None = None,
                      grain: str | None = None) -> DataFrame:
    """State the days ``first`` to ``last`` (inclusive, each optional) on the partition column, if ``df`` has one.

    A month's partition is its first day, so the lower bound is cut to that.
    """
    found = log_partition_of(df, column, grain)
    if found is None:
        return df
    name, grain = found
    if first is not None:
        df = df.where(F.col(name) >= (F.trunc(first, "month") if grain == "month" else first))
    return df if last is None else df.where(F.col(name) <= last)


def _ts_type(df: DataFrame, ts_col: str):
    return df.schema[ts_col].dataType


def scan_log(
    spark: SparkSession,
    path_or_df,
    params: JobParams,
    columns=LOG_COLUMNS,
    fmt: str = "parquet",
    options: dict | None = None,
    date_partition: str | None = None,
    schema=None,
    grain: str | None = None,
) -> DataFrame:
    """Filtered + projected scan of a raw download log.

    ``path_or_df`` is an existing DataFrame, a catalog table's name
    (``fmt="table"``), or whatever the reader ``fmt`` loads (a path, a
    connector's table name) with ``options``. ``schema`` is passed on when
    given; only formats without a schema of their own get the log's. Bounds are cast to the column's own timestamp
    type so the range reaches the Parquet reader as pushed filters. When the
    source has a partition column of days or months (``date_partition`` and ``grain``,
    by default ``log_date`` or ``log_month``), the range is also stated on it for partition
    pruning. ``params.billing_project`` is passed to connectors as ``parentProject``.
    """
    if isinstance(path_or_df, DataFrame):
        src = path_or_df
    elif fmt == "table":
        src = spark.table(path_or_df)
    else:
        options = dict(options or {})
        if params.billing_project and fmt not in FILE_FORMATS:
            options.setdefault("parentProject", params.billing_project)
        reader = spark.read.format(fmt).options(**options)
        if schema is not None or fmt in SCHEMALESS:
            reader = reader.schema(schema or log_schema())
        src = reader.load(path_or_df)
    cols = list(columns)
    if params.ts_col not in cols and params.ts_col in src.columns:
        # a custom timestamp column is carried along so the range can apply
        cols = [params.ts_col] + cols
    # directories outside the range are never listed or opened
    first, last = (F.to_date(F.lit(d)) for d in partition_bounds(params.start, params.end, session_zone(spark)))
    src = within_partitions(src, first, last, date_partition, grain)
    return src.where(log_predicate(params, _ts_type(src, params.ts_col))).select(*cols)


def read_partitioned(
    spark: SparkSession, root: str, start=None, end=None, date_col: str = "download_date"
) -> DataFrame:
    """Read a ``year=/month=`` partitioned Parquet tree.

    With ``start``/``end`` (dates, half-open) the derived year/month bounds are
    added so only the matching directories are listed (partition pruning),
    then the exact date range is applied to ``date_col``.
    """
    df = spark.read.option("basePath", root).parquet(root)
    if start is None and end is None:
        return df
    ym = F.col("year") * 100 + F.col("month")
    cond = F.lit(True)
    if start is not None:
        s = F.to_date(F.lit(start))
        cond = cond & (ym >= F.year(s) * 100 + F.month(s)) & (F.col(date_col) >= s)
    if end is not None:
        e = F.to_date(F.lit(end))
        cond = cond & (ym <= F.year(e) * 100 + F.month(e)) & (F.col(date_col) < e)
    return df.where(cond)


def resolve_source(
    spark: SparkSession,
    data_source: str,
    database: str | None = None,
    root: str | None = None,
    table: str = "pypi_file_downloads",
) -> DataFrame:
    """Pick the log source: external Parquet files or a catalog table."""
    if data_source == "external_source":
        if not root:
            raise ValueError("external_source needs a root path")
        return spark.read.option("basePath", root).parquet(root)
    name = f"{database}.{table}" if database else table
    return spark.table(name)


def load_rollup(spark: SparkSession, path_or_table) -> DataFrame:
    """The published rollup: a Parquet path, a catalog table name, or a versioned table's newest version."""
    if hasattr(path_or_table, "read"):
        return path_or_table.read()
    if "/" in path_or_table or ":" in path_or_table:
        return spark.read.parquet(path_or_table)
    return spark.table(path_or_table)


def sql_over_rollup(spark: SparkSession, rollup: DataFrame, sql: str, view: str = "pypi_daily_stats") -> DataFrame:
    """Run ad-hoc Spark SQL over the rollup registered as a temp view."""
    rollup.createOrReplaceTempView(view)
    return spark.sql(sql)


def mock_log(spark: SparkSession, rows, ts_type=None) -> DataFrame:
    """Inline nested log rows (test fixtures); NULL structs stay typed."""
    from pyspark.sql import types as T

    return spark.createDataFrame(rows, log_schema(ts_type or T.TimestampType()))
