"""

The driver has no download log, so every query reads the driver's ``events``
(and ``orders``) tables mapped onto the nested log layout
(``usage_rollup.sources.driverdata``), builds the daily rollup from them and
runs the library's operators on it. The oracle SQL repeats the same mapping
semantics independently (ordered ``LIMIT 1`` subqueries, ``NOT EXISTS``,
``UNION ALL``), so a match checks the Spark formulation, not a copy of it.

Maintenance queries (range replace, keyed upsert, append, export) write to a
fresh directory under ``spark.checkpoint.dir`` and return the re-read table.
"""

from __future__ import annotations

import datetime
import importlib
import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

# importable however this file is loaded (by path or as a module)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usage_rollup.functions.columns import bound_like
from usage_rollup.functions.labels import compact_count, compact_kpi, short_date, long_date, signed_percent
from usage_rollup.operators import bucketed, bundle, lattice, maintain, quality, reports, versions
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.params import MAX_NULL_PCT, JobParams
from usage_rollup.schema import ROLLUP_COLUMNS
from usage_rollup.session import scratch_dir
from usage_rollup.sources.driverdata import download_log, flat_log
from usage_rollup.sources.log_folder import read_log_folder
from usage_rollup.sources.scan import load_rollup, mock_log, read_partitioned, scan_log, sql_over_rollup

# Fixed parameters of the driver queries.
AS_OF = "2024-01-31"
STALE_AS_OF = "2024-06-01"
PAST = "1997-09-30"
SLICE = ("1996-03-04", "1995-06-05")
JOB_RANGE = ("1996-03-10", "2024-01-25")
SCAN = JobParams(project="alpha", start="2024-01-10", end="2024-01-20 12:00:00")
USER_SQL = (
    "SELECT project, COUNT(*) AS n_groups, CAST(SUM(daily_download_sum) AS BIGINT) AS downloads "
    "FROM pypi_daily_stats GROUP BY project"
)


def _text_dates(df: DataFrame) -> DataFrame:
    """DATE columns as ``yyyy-MM-dd`` text (the form the SQL oracle renders too).

    The operators return DATE; only the compared output is rendered, so both
    engines' client-side date types cannot disagree.
    """
    return df.select(*[
        F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name) if f.dataType.typeName() == "date" else F.col(f.name)
        for f in df.schema.fields
    ])


def _log(spark, sf, with_orders=True):
    return download_log(spark, sf, with_orders)


def _rollup(spark, sf):
    return daily_rollup(_log(spark, sf))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily rollup of the sf0.001 download log."""
    return _rollup(spark, "/root/testdata/sf0.001")


# --- maintenance queries (write, then return the re-read table) ------------------


def _ts_lt(df, bound):
    return F.col("timestamp") < bound_like(bound, df.schema["timestamp"].dataType)


# The log spans years of thin days: one folder a month.
_BY_MONTH = {"partition_col": "log_month", "grain": "month"}


def _seed(spark, sf):
    """A table holding the whole log."""
    target = scratch_dir(spark, "q-raw")
    maintain.replace_range(spark, _log(spark, sf), target, "timestamp", "1992-01-01", "2024-02-01", **_BY_MONTH)
    return target


def _replace(spark, sf, scope=None):
    target = _seed(spark, sf)
    staged = scan_log(spark, _log(spark, sf), JobParams(project="alpha", start="2024-01-15", end="2024-01-25"))
    maintain.replace_range(spark, staged, target, "timestamp", "2024-01-15", "2024-01-25", scope=scope, **_BY_MONTH)
    return flat_log(spark.read.parquet(target))


def _replace_emptied(spark, sf):
    """Days 10 to 13 are replaced by rows of day 11 alone: the other three lose theirs."""
    target, log = _seed(spark, sf), _log(spark, sf)
    staged = log.where(maintain.range_condition(log, "timestamp", "2024-01-11", "2024-01-12"))
    maintain.replace_range(spark, staged, target, "timestamp", "2024-01-10", "2024-01-14", **_BY_MONTH)
    return flat_log(spark.read.parquet(target))


def _replace_null_ts(spark, sf):
    """Two loads of a range whose rows of one minute an hour have no timestamp."""
    target, log = scratch_dir(spark, "q-raw"), _log(spark, sf)
    staged = log.withColumn("timestamp", F.when(
        (F.minute("timestamp") != 7) | (F.col("timestamp") < F.lit("2024-01-01").cast("timestamp")), F.col("timestamp")))
    for _ in range(2):
        maintain.replace_range(spark, staged, target, "timestamp", "1992-01-01", "2024-02-01", **_BY_MONTH)
    return flat_log(spark.read.parquet(target))


def _replace_rejected(spark, sf):
    """A load with a tenth of its timestamps missing fails the gate; the table stays as it was."""
    target, log = _seed(spark, sf), _log(spark, sf)
    staged = log.withColumn("timestamp", F.when(F.minute("timestamp") % 4 != 3, F.col("timestamp"))).where("project <> 'gamma'")
    try:
        maintain.replace_range(spark, staged, target, "timestamp", "2024-01-01", "2024-02-01", **_BY_MONTH)
    except quality.DataQualityError:
        return flat_log(spark.read.parquet(target))
    raise AssertionError("the gate let a rejected load pass")


def _ingest_created(spark, sf):
    """The ingest job reads the log's files by path into a target that was created empty."""
    from usage_rollup.plans import run_ingest

    source, target, log = scratch_dir(spark, "q-source"), scratch_dir(spark, "q-raw"), _log(spark, sf)
    by_month = log.withColumn("log_month", maintain.log_partition("timestamp", "month"))
    _land(by_month, source)
    maintain.ensure_target(spark, by_month, target, ["log_month"])
    run_ingest(spark, source, target, JobParams(project="gamma", start="1992-01-01", end="2024-02-01"),
               options={"mergeSchema": "false"}, schema=by_month.schema, **_BY_MONTH)
    return flat_log(spark.read.parquet(target))


def _scan_json(spark, sf):
    """The log as JSON lines, scanned by path with the log's schema."""
    path, log = scratch_dir(spark, "q-json"), _log(spark, sf)
    micros = dict.fromkeys(("timestampFormat", "timestampNTZFormat"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    log.write.options(**micros).json(path)
    return flat_log(scan_log(spark, path, SCAN, fmt="json", options=micros, schema=log.schema))


def _published(spark, sf):
    """A written rollup read back by path, then ad-hoc SQL over it."""
    target = scratch_dir(spark, "q-rollup")
    maintain.write_rollup(spark, _rollup(spark, sf), target)
    return sql_over_rollup(spark, load_rollup(spark, target), USER_SQL, view="pypi_daily_stats")


def _inline_rows(spark, sf):
    """Inline rows with NULL structs next to the log."""
    log = _log(spark, sf)
    day = datetime.datetime(2024, 1, 9, 8)
    rows = [(day, "FR", None, "delta", None, None, None, None)] * 2
    return daily_rollup(log.unionByName(mock_log(spark, rows, log.schema["timestamp"].dataType)))


def _delete(spark, sf):
    target = _seed(spark, sf)
    maintain.delete_range_table(spark, target, "timestamp", "2024-01-10 06:00:00", "2024-01-14", **_BY_MONTH)
    return flat_log(spark.read.parquet(target))


def _delete_all(spark, sf):
    """Every row is deleted; then the range is loaded again."""
    target, log = _seed(spark, sf), _log(spark, sf)
    maintain.delete_range_table(spark, target, "timestamp", "1992-01-01", "2024-02-01", **_BY_MONTH)
    maintain.replace_range(spark, log, target, "timestamp", "1992-01-01", "2024-02-01", **_BY_MONTH)
    return flat_log(spark.read.parquet(target))


def _upsert(spark, sf):
    log = _log(spark, sf)
    target = scratch_dir(spark, "q-rollup")
    early = daily_rollup(log.where(_ts_lt(log, "2024-01-20 12:00:00")))
    maintain.write_rollup(spark, early, target, mode="incremental")
    maintain.write_rollup(spark, daily_rollup(log, "2024-01-19"), target, mode="incremental")
    return spark.read.parquet(target).select(*ROLLUP_COLUMNS)


def _append(spark, sf):
    r = _rollup(spark, sf)
    target = scratch_dir(spark, "q-append")
    cut = F.to_date(F.lit("2024-01-15"))
    maintain.append(r.where(F.col("download_date") < cut), target, max_records=500)
    maintain.append(r.where(F.col("download_date") >= cut), target, max_records=500)
    return spark.read.parquet(target).select(*ROLLUP_COLUMNS)


def _export(spark, sf, start=None, end=None):
    path = scratch_dir(spark, "q-export")
    maintain.export_partitioned(_rollup(spark, sf), "download_date", path)
    return read_partitioned(spark, path, start, end).select(*ROLLUP_COLUMNS, "year", "month")


def _jobs(spark, sf):
    """Three projects of the whole log into a versioned raw table, then the transform job over a range of it, twice."""
    from usage_rollup.plans import run_ingest, run_transform

    log = _log(spark, sf)
    raw = versions.log_table(spark, scratch_dir(spark, "q-raw"), "log_month")
    rollup = versions.rollup_table(spark, scratch_dir(spark, "q-rollup"))
    for project in ("alpha", "beta", "gamma"):
        run_ingest(spark, log, raw, JobParams(project=project, start="1992-01-01", end="2024-02-01"), scope="project", grain="month")
    for start, end in (JOB_RANGE[0], "2024-01-15"), ("2024-01-10", JOB_RANGE[1]):
        run_transform(spark, rollup, start, end, root=raw, mode="incremental")
    return load_rollup(spark, rollup).select(*ROLLUP_COLUMNS)


def _land(rows, path):
    """Append rows to a landing folder, one folder a month; a month that holds most rows is written by several tasks."""
    with maintain.unsorted_writes(rows):
        maintain.clustered(rows, "log_month").write.mode("append").partitionBy("log_month").parquet(path)


def _stream(spark, sf):
    """The whole log lands in three drops, one folder a month, the last with late rows of every year; the rollup is versioned."""
    from usage_rollup.streaming import start_incremental_rollup

    log = _log(spark, sf).withColumn("log_month", F.trunc("timestamp", "month"))
    src, ckpt = scratch_dir(spark, "q-landing"), scratch_dir(spark, "q-stream-ckpt")
    target = versions.rollup_table(spark, scratch_dir(spark, "q-rollup"))
    late, cut = F.dayofmonth("timestamp") == 17, _ts_lt(log, "1998-03-15 12:00:00")
    for drop in (log.where(cut & ~late), log.where(~cut & ~late), log.where(late)):
        _land(drop, src)
        start_incremental_rollup(spark, src, target, ckpt).awaitTermination()
    return target.read().select(*ROLLUP_COLUMNS)


def _stream_additive(spark, sf):
    """The whole log lands in two drops; each micro-batch adds its own counts, a replayed one nothing; then compacted."""
    from usage_rollup.streaming import additive

    log = _log(spark, sf).withColumn("log_month", F.trunc("timestamp", "month"))
    src, ckpt = scratch_dir(spark, "q-landing"), scratch_dir(spark, "q-stream-ckpt")
    table = versions.rollup_table(spark, scratch_dir(spark, "q-partials"))
    late = F.dayofmonth("timestamp") == 17
    for drop in (log.where(~late), log.where(late)):
        _land(drop, src)
        additive.start_additive_rollup(spark, src, table, ckpt, "landing").awaitTermination()
    if additive.add_batch(table, log, 0, "landing"):
        raise AssertionError("a batch was added twice")
    additive.compact(table)
    return additive.read_rollup(table)


# --- versioned tables ----------------------------------------------------------------


def _versioned(spark, sf):
    """Version 1 holds the early log, version 2 a keyed re-run of its end."""
    log = _log(spark, sf)
    table = versions.rollup_table(spark, scratch_dir(spark, "q-versions"))
    versions.write_rollup(table, daily_rollup(log.where(_ts_lt(log, "2024-01-20 12:00:00"))))
    versions.write_rollup(table, daily_rollup(log, "2024-01-19"), "incremental")
    return table


def _versioned_restored(spark, sf):
    """After an upsert and a delete of a range the first version is restored."""
    table = _versioned(spark, sf)
    versions.delete_range(table, "download_date", "1996-01-01", "1998-01-01", grain="month")
    table.restore(1)
    return table.read().select(*ROLLUP_COLUMNS)


def _versioned_history(spark, sf):
    """Rows and downloads of each version: refresh, upsert, delete of a range, restore."""
    table = _versioned(spark, sf)
    versions.delete_range(table, "download_date", "1996-01-01", "1998-01-01", grain="month")
    table.restore(1)
    parts = [table.read(v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("n_rows"),
                               F.sum("daily_download_sum").cast("bigint").alias("downloads")) for v in table.versions()]
    for p in parts[1:]:
        parts[0] = parts[0].unionByName(p)
    return parts[0]


def _versioned_replace(spark, sf):
    """A range replace of a versioned raw log that deletes all projects' rows in the range."""
    log, table = _log(spark, sf), versions.log_table(spark, scratch_dir(spark, "q-raw"), "log_month")
    versions.replace_range(table, log, "timestamp", "1992-01-01", "2024-02-01", grain="month")
    staged = scan_log(spark, table.read(), JobParams(project="alpha", start="2024-01-15", end="2024-01-25"))
    versions.replace_range(table, staged, "timestamp", "2024-01-15", "2024-01-25", grain="month")
    return flat_log(table.read())


def _lattice_reports(spark, sf):
    """The bundle from pre-aggregated levels, built before an upsert and updated after it."""
    log = _log(spark, sf)
    table = versions.rollup_table(spark, scratch_dir(spark, "q-versions"))
    levels = lattice.Lattice(spark, scratch_dir(spark, "q-lattice"), table)
    versions.write_rollup(table, daily_rollup(log.where(_ts_lt(log, "2024-01-20 12:00:00"))))
    levels.update()
    versions.write_rollup(table, daily_rollup(log, "2024-01-19"), "incremental")
    levels.update()
    return reports.bundle_long(lattice.lattice_bundle(levels, 30, AS_OF))


def _upsert_bucketed(spark, sf):
    """A keyed upsert into a bucketed catalog table."""
    log, name = _log(spark, sf), "usage_rollup_bucketed_" + uuid.uuid4().hex[:12]
    bucketed.create_bucketed(spark, daily_rollup(log.where(_ts_lt(log, "2024-01-20 12:00:00"))), name, 8)
    bucketed.upsert_bucketed(spark, name, daily_rollup(log, "2024-01-19"))
    return spark.table(name).select(*ROLLUP_COLUMNS)


def _exact_chunks(spark, sf):
    """Rows per file of the rollup appended in chunks of exactly 500."""
    target = scratch_dir(spark, "q-append")
    maintain.append_exact(_rollup(spark, sf), target, 500)
    per_file = spark.read.parquet(target).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n_rows"))
    return per_file.groupBy("n_rows").agg(F.count(F.lit(1)).alias("n_files"))


def _log_folder(spark, sf):
    """The log in folders of project and month, scanned through the library's own data source."""
    path, log = scratch_dir(spark, "q-landing"), _log(spark, sf)
    rows = log.withColumn("log_month", maintain.log_partition("timestamp", "month"))
    # one folder level a project; the column itself stays in the files
    for project in ("alpha", "beta", "gamma"):
        _land(rows.where(F.col("project") == project), f"{path}/project={project}")
    ntz = log.schema["timestamp"].dataType.typeName() == "timestamp_ntz"
    return flat_log(scan_log(spark, read_log_folder(spark, path, timestamp_ntz=str(ntz).lower()), SCAN))


def _gate_outcomes(spark, sf):
    """What the gate says about each project's rows, and about a project without any."""
    log, out = _log(spark, sf), []
    for project in ("alpha", "beta", "gamma", "nobody"):
        rows = log.where(F.col("project") == project)
        stats = rows.agg(*quality.quality_exprs("timestamp", "country_code")).withColumn("project", F.lit(project)).first().asDict()
        try:
            quality.validate_stats(stats, "timestamp", "country_code", MAX_NULL_PCT)
            outcome = "passed"
        except quality.DataQualityError as e:
            outcome = str(e)
        out.append((project, int(stats["total_rows"]), outcome))
    return spark.createDataFrame(out, "project string, total_rows bigint, outcome string")


def _custom_timestamp(spark, sf):
    """The ingest and transform steps on a log whose timestamp column has another name."""
    from usage_rollup.plans import run_ingest

    log = _log(spark, sf).withColumnRenamed("timestamp", "seen_at")
    target = scratch_dir(spark, "q-raw")
    params = JobParams(project="gamma", start="1996-05-01", end="1999-07-01", ts_col="seen_at")
    run_ingest(spark, log, target, params, columns=["project", "country_code", "file", "details"], **_BY_MONTH)
    return daily_rollup(spark.read.parquet(target), "1997-01-01", ts="seen_at")


def _daily_today(spark, sf):
    """The last 30 days before today of a rollup whose newest date is today, by age in days."""
    r = _rollup(spark, sf)
    shifted = r.withColumn("download_date", F.date_add("download_date", F.datediff(F.current_date(), F.to_date(F.lit(AS_OF)))))
    age = F.datediff(F.current_date(), F.to_date("download_date")).alias("days_ago")
    return reports.daily_series(shifted, 30).select(age, "daily_downloads")


def _unpivoted(wide, value):
    """(download_date, version_column, value): every cell of a wide frame."""
    return wide.unpivot("download_date", [c for c in wide.columns if c != "download_date"], "version_column", value)


def _map_text(df, column):
    """A map column as ``key=value`` pairs in key order."""
    return df.select("download_date", F.array_join(F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("string") if column == "downloads" else F.format_number(e["value"], 4))), ",").alias(column))


def _jobs_all(spark, sf):
    """Ingest the three projects of the whole log into a raw table, then the transform job over all of it."""
    from usage_rollup.plans import run_ingest, run_transform

    log = _log(spark, sf)
    raw, rollup = scratch_dir(spark, "q-raw"), scratch_dir(spark, "q-rollup")
    for project in ("alpha", "beta", "gamma"):
        run_ingest(spark, log, raw, JobParams(project=project, start="1992-01-01", end="2024-02-01"), scope="project", **_BY_MONTH)
    run_transform(spark, rollup, data_source="external_source", root=raw)
    return spark.read.parquet(rollup).select(*ROLLUP_COLUMNS)


def _stream_all(spark, sf):
    """The whole log lands in two drops, one folder a month; the second holds later rows of a month already rolled up."""
    from usage_rollup.streaming import start_incremental_rollup

    log = _log(spark, sf).withColumn("log_month", F.trunc("timestamp", "month"))
    src, target = scratch_dir(spark, "q-landing"), scratch_dir(spark, "q-rollup")
    ckpt = scratch_dir(spark, "q-stream-ckpt")
    cut = _ts_lt(log, "1998-03-15 12:00:00")
    for drop in (log.where(cut), log.where(~cut)):
        _land(drop, src)
        start_incremental_rollup(spark, src, target, ckpt).awaitTermination()
    return spark.read.parquet(target).select(*ROLLUP_COLUMNS)


# --- report queries ------------------------------------------------------------


def _kpi_labels(spark, sf):
    k = reports.kpi_cards(_rollup(spark, sf), AS_OF, digits=6)
    return k.select(
        "last_week_start",
        compact_kpi("last_week_downloads").alias("last_week_label"),
        signed_percent("week_change_pct").alias("week_change_label"),
        compact_kpi("last_month_downloads").alias("last_month_label"),
        signed_percent("month_change_pct").alias("month_change_label"),
        compact_kpi("total_downloads").alias("total_label"),
        long_date("refresh_date").alias("refresh_label"),
    )


def _monthly_labels(spark, sf):
    m = reports.monthly_recent(_rollup(spark, sf))
    return m.select(
        "year_month",
        "monthly_downloads",
        compact_count("monthly_downloads").alias("monthly_downloads_label"),
        compact_kpi("monthly_downloads").alias("monthly_downloads_kpi"),
    )


def _daily_labels(spark, sf):
    d = reports.daily_series(_rollup(spark, sf), 0, AS_OF)
    return d.select(
        "download_date",
        short_date("download_date").alias("date_label"),
        compact_count("daily_downloads").alias("daily_downloads_label"),
    )


SURVEY_IDS = {
    "daily_rollup": "A1 P1 P2 P3 S2", "daily_rollup_range": "A1 F3",
    "scan_filtered_log": "S1 S2 S3 F1 F2", "quality_report": "A2 Q2 Q3 Q4", "quality_report_country": "A2 Q4",
    "weekly_series": "R1 F5 F6 J2 A3 A10 O1", "weekly_series_stale": "R1 F6 (empty)", "last_two_weeks": "R2 O3",
    "monthly_recent": "R3 A4 O4", "last_two_months": "R4 O5", "daily_series": "R11 A9",
    "daily_series_30": "R11 F4", "total_downloads": "R5 A5", "refresh_date": "R6 A6",
    "top_versions_all": "R7 A7 O2", "top_versions_7": "R7 F4", "top_versions_30": "R7 F4",
    "top_versions_90": "R7 F4", "top_runtime": "R8", "top_countries": "R9", "top_breakdowns_30": "R7-R9 B1",
    "version_adoption": "R10 A8 F7", "adoption_versions": "A12", "adoption_pivot": "T3 A13",
    "adoption_share": "T4", "adoption_share_long": "T4 (long form)", "kpi_cards": "T1 T2 T5",
    "sparkline": "O7", "series_slice": "F9", "report_labels": "labels", "daily_labels": "labels",
    "kpi_labels": "labels T5", "sql_over_rollup": "S8", "published_rollup_sql": "S7 S8 W7",
    "top_versions_alias": "R7 P4", "inline_rows_rollup": "S9 A1", "scan_log_from_path": "S1 (path, JSON)",
    "ingest_into_created_target": "W2 W3 S1 (path, options)", "replace_range_rejected": "Q5 Q2 W6 (gate fails)",
    "top_versions_90_past": "R7 F4 (90 days)", "report_bundle": "B1 U1 F8",
    "report_bundle_bad_period": "B1 F8 (whitelist)", "series_slice_missing_bound": "F9 (missing label)",
    "replace_range": "W6 W4 W3 S4 U1", "replace_range_scoped": "W6 (scope)", "delete_range": "W4",
    "replace_range_emptied_date": "W6 (emptied dates)", "replace_range_null_ts": "W6 Q2 (NULL timestamps)",
    "delete_all_then_reload": "W4 W6 (emptied table)",
    "delete_range_frame": "W4 (frame)", "quality_report_staged": "S4 A2 A11 Q4",
    "upsert_by_key": "W8 J1", "append_chunks": "W5", "export_partitioned": "W9 S5", "export_pruned": "S5 (pruning)",
    "ingest_transform_jobs": "S6 W6 W8 (jobs, versioned tables)", "incremental_stream_rollup": "W8 (streaming, versioned target)",
    "incremental_stream_additive": "W8 U1 (streaming, batch ledger)", "versioned_upsert": "W8 W7 J1 (file-level)",
    "versioned_previous": "W7 S7 (older version)", "versioned_restored": "W7 W4 (restore)", "versioned_history": "W7 W8 W4",
    "versioned_replace_range": "W6 Q5", "lattice_bundle": "R1-R11 B1 (pre-aggregated levels)", "report_bundle_shared": "B1 (one scan)",
    "adoption_map": "T3 A13", "adoption_share_map": "T4", "append_exact_chunks": "W5", "scan_log_folder": "S1 S3 (own pushdown)",
    "upsert_bucketed": "W8 J1 (bucketed)", "quality_gate_outcomes": "Q1 Q3 Q5", "custom_timestamp": "W6 A1 (timestamp column)",
    "daily_series_today": "R11 F4 (current_date)",
    "ingest_transform_jobs_all": "S6 W7 (jobs, whole log)", "incremental_stream_rollup_all": "W8 (streaming, whole log)",
}


def _llm():
    """The training-data queries' module, or None where the subpackage is absent (a broken one is an error)."""
    if importlib.util.find_spec("usage_rollup.llm") is None or importlib.util.find_spec("usage_rollup.llm.registry") is None:
        return None
    return importlib.import_module("usage_rollup.llm.registry")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _rollup_queries() | (_llm().queries() if _llm() else {})


def oracle_sql() -> dict[str, str]:
    return _rollup_oracle() | (_llm().oracle_sql() if _llm() else {})


def _rollup_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    R = reports
    return {
        # transform
        "daily_rollup": lambda s, sf: _text_dates(_rollup(s, sf)),
        "daily_rollup_range": lambda s, sf: _text_dates(daily_rollup(_log(s, sf), "2024-01-05", "2024-01-25")),
        # ingest: scan + quality
        "scan_filtered_log": lambda s, sf: flat_log(scan_log(s, _log(s, sf), SCAN)),
        "quality_report": lambda s, sf: quality.quality_report(_log(s, sf), "timestamp", "project", digits=6),
        "quality_report_country": lambda s, sf: quality.quality_report(_log(s, sf), "timestamp", "country_code", digits=6),
        # series
        "weekly_series": lambda s, sf: R.weekly_series(_rollup(s, sf), AS_OF),
        "weekly_series_stale": lambda s, sf: R.weekly_series(_rollup(s, sf), STALE_AS_OF),
        "last_two_weeks": lambda s, sf: R.last_two_weeks(_rollup(s, sf), AS_OF),
        "monthly_recent": lambda s, sf: R.monthly_recent(_rollup(s, sf)),
        "last_two_months": lambda s, sf: R.last_two_months(_rollup(s, sf)),
        "daily_series": lambda s, sf: R.daily_series(_rollup(s, sf), 0, AS_OF),
        "daily_series_30": lambda s, sf: R.daily_series(_rollup(s, sf), 30, AS_OF),
        "total_downloads": lambda s, sf: R.total_downloads(_rollup(s, sf)),
        "refresh_date": lambda s, sf: R.refresh_date(_rollup(s, sf)),
        # breakdowns
        "top_versions_all": lambda s, sf: R.top_versions(_rollup(s, sf), 0, AS_OF),
        "top_versions_7": lambda s, sf: R.top_versions(_rollup(s, sf), 7, AS_OF),
        "top_versions_30": lambda s, sf: R.top_versions(_rollup(s, sf), 30, AS_OF),
        "top_versions_90": lambda s, sf: R.top_versions(_rollup(s, sf), 90, AS_OF),
        # the orders end in the years before, so 90 days differ from 30 there
        "top_versions_90_past": lambda s, sf: R.top_versions(_rollup(s, sf).where(F.col("download_date") <= F.to_date(F.lit(PAST))), 90, PAST),
        "top_versions_alias": lambda s, sf: R.top_versions(_rollup(s, sf), 0, AS_OF, alias="release"),
        "top_runtime": lambda s, sf: R.top_runtimes(_rollup(s, sf), 0, AS_OF),
        "top_countries": lambda s, sf: R.top_countries(_rollup(s, sf), 0, AS_OF),
        "top_breakdowns_30": lambda s, sf: R.top_breakdowns(_rollup(s, sf), 30, AS_OF),
        "version_adoption": lambda s, sf: R.version_adoption(_rollup(s, sf)),
        "adoption_versions": lambda s, sf: R.adoption_versions(R.version_adoption(_rollup(s, sf))),
        "adoption_pivot": lambda s, sf: _unpivoted(R.adoption_pivot(R.version_adoption(_rollup(s, sf))), "downloads"),
        "adoption_share": lambda s, sf: _unpivoted(R.adoption_share(
            R.adoption_pivot(R.version_adoption(_rollup(s, sf))), digits=6), "share_pct"),
        "adoption_share_long": lambda s, sf: R.adoption_share_long(R.version_adoption(_rollup(s, sf)), digits=6),
        "adoption_map": lambda s, sf: _map_text(R.adoption_map(R.version_adoption(_rollup(s, sf))), "downloads"),
        "adoption_share_map": lambda s, sf: _map_text(R.adoption_share_map(R.adoption_map(R.version_adoption(_rollup(s, sf)))), "share_pct"),
        # KPI shaping
        "kpi_cards": lambda s, sf: R.kpi_cards(_rollup(s, sf), AS_OF, digits=6),
        "sparkline": lambda s, sf: R.sparkline(_rollup(s, sf), AS_OF),
        "series_slice": lambda s, sf: R.series_slice(R.weekly_series(_rollup(s, sf), AS_OF), "week_start_date", *SLICE),
        "report_labels": _monthly_labels,
        "daily_labels": _daily_labels,
        "kpi_labels": _kpi_labels,
        "published_rollup_sql": _published,
        "inline_rows_rollup": lambda s, sf: _text_dates(_inline_rows(s, sf)),
        "scan_log_from_path": _scan_json,
        "ingest_into_created_target": _ingest_created,
        "sql_over_rollup": lambda s, sf: sql_over_rollup(s, _rollup(s, sf), USER_SQL),
        "report_bundle": lambda s, sf: R.bundle_long(R.report_bundle(_rollup(s, sf), 30, AS_OF)),
        # 5 is not an allowed period, so the bundle falls back to all time
        "report_bundle_bad_period": lambda s, sf: R.bundle_long(R.report_bundle(_rollup(s, sf), 5, AS_OF)),
        "series_slice_missing_bound": lambda s, sf: R.series_slice(
            R.weekly_series(_rollup(s, sf), AS_OF), "week_start_date", SLICE[0], "2099-01-05"),
        # maintenance
        "replace_range": lambda s, sf: _replace(s, sf),
        "replace_range_scoped": lambda s, sf: _replace(s, sf, scope="project"),
        "replace_range_emptied_date": _replace_emptied,
        "replace_range_null_ts": _replace_null_ts,
        "replace_range_rejected": _replace_rejected,
        "delete_range": _delete,
        "delete_all_then_reload": _delete_all,
        "delete_range_frame": lambda s, sf: flat_log(maintain.delete_range(
            _log(s, sf), "timestamp", "2024-01-10 06:00:00", "2024-01-14")),
        "quality_report_staged": lambda s, sf: quality.quality_report(scan_log(s, _log(s, sf), SCAN), digits=6),
        "upsert_by_key": lambda s, sf: _text_dates(_upsert(s, sf)),
        "append_chunks": lambda s, sf: _text_dates(_append(s, sf)),
        "export_partitioned": lambda s, sf: _text_dates(_export(s, sf)),
        "export_pruned": lambda s, sf: _text_dates(_export(s, sf, "1998-03-15", "1999-02-10")),
        "ingest_transform_jobs": lambda s, sf: _text_dates(_jobs(s, sf)),
        "incremental_stream_rollup": lambda s, sf: _text_dates(_stream(s, sf)),
        "ingest_transform_jobs_all": lambda s, sf: _text_dates(_jobs_all(s, sf)),
        "incremental_stream_rollup_all": lambda s, sf: _text_dates(_stream_all(s, sf)),
        "incremental_stream_additive": lambda s, sf: _text_dates(_stream_additive(s, sf)),
        # versions, levels, layouts
        "versioned_upsert": lambda s, sf: _text_dates(_versioned(s, sf).read().select(*ROLLUP_COLUMNS)),
        "versioned_previous": lambda s, sf: _text_dates(_versioned(s, sf).read(1).select(*ROLLUP_COLUMNS)),
        "versioned_restored": lambda s, sf: _text_dates(_versioned_restored(s, sf)),
        "versioned_history": _versioned_history,
        "versioned_replace_range": _versioned_replace,
        "lattice_bundle": _lattice_reports,
        "report_bundle_shared": lambda s, sf: R.bundle_long(bundle.SharedBundle(_rollup(s, sf), 30, AS_OF)),
        "append_exact_chunks": _exact_chunks,
        "scan_log_folder": _log_folder,
        "upsert_bucketed": lambda s, sf: _text_dates(_upsert_bucketed(s, sf)),
        "quality_gate_outcomes": _gate_outcomes,
        "custom_timestamp": lambda s, sf: _text_dates(_custom_timestamp(s, sf)),
        "daily_series_today": _daily_today,
    }


# --- oracle SQL ------------------------------------------------------------------

_EVENTS_LOG = """
  SELECT ts AS "timestamp",
    CASE WHEN event_type IN ('click', 'view') THEN 'alpha' ELSE 'beta' END AS project,
    CASE WHEN user_id % 3 = 1 THEN 'US' WHEN user_id % 3 = 2 THEN 'DE' END AS country_code,
    CASE WHEN k % 23 = 0 THEN NULL
         ELSE '1.' || CAST(k % 5 AS VARCHAR) || '.' || CAST(event_id % 3 AS VARCHAR) || CASE WHEN event_id % 10 = 0 THEN '.dev1' ELSE '' END
    END AS version,
    CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN '3'
         ELSE '3.' || CAST(8 + k % 2 AS VARCHAR) || '.' || CAST(event_id % 4 AS VARCHAR) END AS python,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'Linux' END AS system_name,
    CASE WHEN user_id % 3 = 1 THEN NULL ELSE 'r1' END AS system_release,
    CASE WHEN k % 2 = 0 THEN 'x86_64' END AS cpu
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e"""

_ORDERS_LOG = """
  SELECT o_orderdate AS "timestamp", 'gamma' AS project, o_orderstatus AS country_code,
    '1.' || CAST(o_custkey % 7 AS VARCHAR) || '.0' AS version,
    '3.' || CAST(o_orderkey % 6 + 7 AS VARCHAR) || '.1' AS python,
    CASE WHEN o_orderpriority LIKE '1%' THEN 'Darwin' ELSE 'Linux' END AS system_name,
    CAST(NULL AS VARCHAR) AS system_release, CAST(NULL AS VARCHAR) AS cpu
  FROM orders"""

_FLAT = '"timestamp", project, country_code, version, python, system_name, system_release, cpu'


def _rollup_sql(log: str = "log", where: str = "") -> str:
    return f"""
  SELECT md5(concat_ws('|', strftime(download_date, '%Y-%m-%d'), system_name, system_release, version,
                       project, country_code, cpu, python_version)) AS load_id,
         download_date, system_name, system_release, version, project, country_code, cpu, python_version,
         COUNT(*) AS daily_download_sum
  FROM (SELECT CAST("timestamp" AS DATE) AS download_date, system_name, system_release, version, project,
               country_code, cpu,
               split_part(python, '.', 1) || '.' || split_part(python, '.', 2) AS python_version
        FROM {log}) pre
  {where}
  GROUP BY ALL"""


def _with(body: str, orders: bool = True) -> str:
    log = _EVENTS_LOG + ("\n  UNION ALL" + _ORDERS_LOG if orders else "")
    return f"WITH log AS ({log}\n),\nrollup AS ({_rollup_sql()}\n)\n{body}"


def _weekly_sql(as_of: str) -> str:
    return f"""
  SELECT strftime(wk, '%Y-%m-%d') AS week_start_date, CAST(SUM(daily_download_sum) AS BIGINT) AS weekly_downloads
  FROM (SELECT date_trunc('week', download_date) AS wk, daily_download_sum FROM rollup) r
  WHERE wk <> (SELECT wk FROM (SELECT date_trunc('week', download_date) AS wk FROM rollup) x
               WHERE wk >= date_trunc('week', DATE '{as_of}' - INTERVAL 28 DAY)
               ORDER BY wk DESC LIMIT 1)
  GROUP BY wk"""


_MONTHLY = """
  SELECT strftime(download_date, '%Y-%m') AS year_month, CAST(SUM(daily_download_sum) AS BIGINT) AS monthly_downloads
  FROM rollup GROUP BY year_month ORDER BY year_month DESC"""


def _top_sql(dim: str, days: int = 0, alias: str | None = None, as_of: str = AS_OF, until: str = "") -> str:
    where = f"WHERE download_date >= DATE '{as_of}' - INTERVAL '{days} days'{until}" if days else ""
    return f"""
  SELECT {dim} AS {alias or dim}, CAST(SUM(daily_download_sum) AS BIGINT) AS total_downloads
  FROM rollup {where} GROUP BY {dim}
  ORDER BY total_downloads DESC, {alias or dim} ASC NULLS LAST LIMIT 10"""


_ADOPTION = """
  SELECT CAST(download_date AS VARCHAR) AS download_date, version,
         CAST(SUM(daily_download_sum) AS BIGINT) AS downloads
  FROM rollup
  WHERE version NOT LIKE '%dev%' AND (version LIKE '1.2%' OR version LIKE '1.3%' OR version LIKE '1.4%')
  GROUP BY download_date, version"""


def _daily_sql(days: int = 0) -> str:
    where = f"WHERE download_date >= DATE '{AS_OF}' - INTERVAL '{days} days'" if days else ""
    return f"""
  SELECT CAST(download_date AS VARCHAR) AS download_date, CAST(SUM(daily_download_sum) AS BIGINT) AS daily_downloads
  FROM rollup {where} GROUP BY download_date"""


# Every cell of the wide forms: all dates by all versions.
_CELLS = """
SELECT d.download_date, 'v' || replace(v.version, '.', '_') AS version_column, {value}
FROM (SELECT download_date, CAST(sum(downloads) AS BIGINT) AS tot FROM adoption GROUP BY download_date) d
CROSS JOIN (SELECT DISTINCT version FROM adoption) v
LEFT JOIN adoption a ON a.download_date = d.download_date AND a.version = v.version"""
_SHARE = "round(CASE WHEN tot > 0 THEN CAST(coalesce(a.downloads, 0) AS DOUBLE) / tot * 100.0 ELSE 0.0 END, 6) AS share_pct"


def _pair_sql(frame: str, label: str, value: str, prefix: str) -> str:
    """Last / previous over a <=2-row frame, change in percent (NULL if prev missing or 0)."""
    return f"""
  SELECT max({label}) AS {prefix}_last_label,
         arg_max({value}, {label}) AS {prefix}_last,
         CASE WHEN count(*) = 2 THEN arg_min({value}, {label}) END AS {prefix}_prev
  FROM {frame}"""


_KPI = f"""
w2 AS (SELECT * FROM ({_weekly_sql(AS_OF)}) w ORDER BY week_start_date DESC LIMIT 2),
m2 AS (SELECT * FROM ({_MONTHLY}) m LIMIT 2 OFFSET 1),
wk AS ({_pair_sql('w2', 'week_start_date', 'weekly_downloads', 'w')}),
mo AS ({_pair_sql('m2', 'year_month', 'monthly_downloads', 'm')}),
tot AS (SELECT CAST(COALESCE(SUM(daily_download_sum), 0) AS BIGINT) AS total_downloads,
               COALESCE(CAST(MAX(download_date) AS VARCHAR), '') AS refresh_date FROM rollup),
kpi AS (
  SELECT w_last_label AS last_week_start, w_last AS last_week_downloads, w_prev AS previous_week_downloads,
         CASE WHEN w_prev <> 0 THEN CAST(w_last - w_prev AS DOUBLE) * 100.0 / CAST(w_prev AS DOUBLE) END AS week_change,
         CASE WHEN m_prev <> 0 THEN CAST(m_last - m_prev AS DOUBLE) * 100.0 / CAST(m_prev AS DOUBLE) END AS month_change,
         round(CASE WHEN w_prev IS NULL OR w_prev = 0 THEN NULL
                    ELSE CAST(w_last - w_prev AS DOUBLE) * 100.0 / CAST(w_prev AS DOUBLE) END, 6) AS week_change_pct,
         m_last_label AS last_month, m_last AS last_month_downloads, m_prev AS previous_month_downloads,
         round(CASE WHEN m_prev IS NULL OR m_prev = 0 THEN NULL
                    ELSE CAST(m_last - m_prev AS DOUBLE) * 100.0 / CAST(m_prev AS DOUBLE) END, 6) AS month_change_pct,
         total_downloads, refresh_date
  FROM wk, mo, tot)"""


def _count_label(c: str) -> str:
    def tier(div, suffix):
        return f"printf('%.1f', round(CAST({c} / {div} AS DECIMAL(38, 6)), 1)) || '{suffix}'"

    return (f"CASE WHEN {c} >= 1000000000 THEN {tier(1000000000, 'B')} WHEN {c} >= 1000000 THEN {tier(1000000, 'M')} "
            f"WHEN {c} >= 1000 THEN {tier(1000, 'K')} ELSE format('{{:,}}', {c}) END")


def _kpi_label(c: str) -> str:
    return (f"CASE WHEN {c} >= 1000000 THEN printf('%.2f', round(CAST({c} / 1000000 AS DECIMAL(38, 6)), 2)) || 'M' "
            f"WHEN {c} >= 1000 THEN printf('%.1f', round(CAST({c} / 1000 AS DECIMAL(38, 6)), 1)) || 'K' "
            f"ELSE format('{{:,}}', {c}) END")


def _pct_label(c: str) -> str:
    return (f"CASE WHEN {c} > 0 THEN '+' ELSE '' END || printf('%.1f', round(CAST({c} AS DECIMAL(38, 6)), 1)) || '%'")


def _bundle_sql(days: int = 30, with_: str | None = None) -> str:
    """The thirteen reports as (report, label, n); ``with_`` opens with other definitions of log and rollup."""
    cards = [("last_week_downloads", "last_week_start", "last_week_downloads"), ("previous_week_downloads", None, "previous_week_downloads"),
             ("week_change_pct", None, "round(week_change * 1000000)"),
             ("last_month_downloads", "last_month", "last_month_downloads"),
             ("previous_month_downloads", None, "previous_month_downloads"), ("month_change_pct", None, "round(month_change * 1000000)"),
             ("total_downloads", "refresh_date", "total_downloads")]
    kpi = " UNION ALL ".join(f"SELECT concat_ws('|', '{c}'{f', {of}' if of else ''}) AS label, CAST({n} AS BIGINT) AS n FROM kpi" for c, of, n in cards)
    parts = [
        ("period", "label", "n", f"(SELECT {'CAST(NULL AS VARCHAR)' if days is None else repr('all time' if days == 0 else f'last {days} days')} AS label, {days} AS n)"),
        ("kpi_cards", "label", "n", f"({kpi})"),
        ("weekly_series", "week_start_date", "weekly_downloads", f"({_weekly_sql(AS_OF)})"),
        ("last_two_weeks", "week_start_date", "weekly_downloads",
         f"(SELECT * FROM ({_weekly_sql(AS_OF)}) w ORDER BY week_start_date DESC LIMIT 2)"),
        ("monthly_recent", "year_month", "monthly_downloads", f"({_MONTHLY} LIMIT 6)"),
        ("last_two_months", "year_month", "monthly_downloads", f"({_MONTHLY} LIMIT 2 OFFSET 1)"),
        ("total_downloads", "''", "total_downloads",
         "(SELECT CAST(COALESCE(SUM(daily_download_sum), 0) AS BIGINT) AS total_downloads FROM rollup)"),
        ("refresh_date", "max_date", "CAST(NULL AS BIGINT)",
         "(SELECT COALESCE(CAST(MAX(download_date) AS VARCHAR), '') AS max_date FROM rollup)"),
        ("top_versions", "version", "total_downloads", f"({_top_sql('version', days)})"),
        ("top_runtimes", "python_version", "total_downloads", f"({_top_sql('python_version', days)})"),
        ("top_countries", "country_code", "total_downloads", f"({_top_sql('country_code', days)})"),
        ("version_adoption", "concat_ws('|', download_date, version)", "downloads", f"({_ADOPTION})"),
        ("daily_series", "download_date", "daily_downloads", f"({_daily_sql(days)})"),
    ]
    sel = [
        f"SELECT '{name}' AS report, CAST({label} AS VARCHAR) AS label, CAST({n} AS BIGINT) AS n FROM {src} t{i}"
        for i, (name, label, n, src) in enumerate(parts)
    ]
    with_ = with_ or _with("")
    return f"{with_.rstrip()},{_KPI}\n" + "\nUNION ALL\n".join(sel)


def _rollup_oracle() -> dict[str, str]:
    rollup_cols = _ROLLUP_TEXT
    no_ts = "\"timestamp\" >= TIMESTAMP '2024-01-01' AND minute(\"timestamp\") = 7"
    in_range = "\"timestamp\" >= TIMESTAMP '2024-01-15' AND \"timestamp\" < TIMESTAMP '2024-01-25'"
    return {
        "daily_rollup": _with(f"SELECT {rollup_cols} FROM rollup"),
        "daily_rollup_range": _with(
            f"SELECT {rollup_cols} FROM rollup "
            "WHERE download_date >= DATE '2024-01-05' AND download_date < DATE '2024-01-25'"),
        "scan_filtered_log": _with(
            f"SELECT {_FLAT} FROM log WHERE project = 'alpha' AND \"timestamp\" >= TIMESTAMP '2024-01-10' "
            "AND \"timestamp\" < TIMESTAMP '2024-01-20 12:00:00'"),
        "quality_report": _with(_quality_sql("project")),
        "quality_report_country": _with(_quality_sql("country_code")),
        "weekly_series": _with(_weekly_sql(AS_OF)),
        "weekly_series_stale": _with(_weekly_sql(STALE_AS_OF)),
        "last_two_weeks": _with(f"SELECT * FROM ({_weekly_sql(AS_OF)}) w ORDER BY week_start_date DESC LIMIT 2"),
        "monthly_recent": _with(_MONTHLY + " LIMIT 6"),
        "last_two_months": _with(_MONTHLY + " LIMIT 2 OFFSET 1"),
        "daily_series": _with(_daily_sql(0)),
        "daily_series_30": _with(_daily_sql(30)),
        "total_downloads": _with(
            "SELECT CAST(COALESCE(SUM(daily_download_sum), 0) AS BIGINT) AS total_downloads FROM rollup"),
        "refresh_date": _with("SELECT COALESCE(CAST(MAX(download_date) AS VARCHAR), '') AS max_date FROM rollup"),
        "top_versions_all": _with(_top_sql("version")),
        "top_versions_7": _with(_top_sql("version", 7)),
        "top_versions_30": _with(_top_sql("version", 30)),
        "top_versions_90": _with(_top_sql("version", 90)),
        "top_versions_90_past": _with(_top_sql("version", 90, as_of=PAST, until=f" AND download_date <= DATE '{PAST}'")),
        "top_versions_alias": _with(_top_sql("version", alias="release")),
        "top_runtime": _with(_top_sql("python_version")),
        "top_countries": _with(_top_sql("country_code")),
        "top_breakdowns_30": _with(_breakdowns_sql(30)),
        "version_adoption": _with(_ADOPTION),
        "adoption_versions": _with(f"SELECT DISTINCT version FROM ({_ADOPTION}) a"),
        "adoption_pivot": _with(f", adoption AS ({_ADOPTION}) {_CELLS.format(value='a.downloads')}"),
        "adoption_share": _with(f", adoption AS ({_ADOPTION}) {_CELLS.format(value=_SHARE)}"),
        "adoption_map": _with(
            f"SELECT download_date, string_agg(version || '=' || downloads, ',' ORDER BY version) AS downloads "
            f"FROM ({_ADOPTION}) a GROUP BY download_date"),
        "adoption_share_map": _with(
            f"SELECT download_date, string_agg(version || '=' || printf('%.4f', 100.0 * downloads / tot), ',' ORDER BY version) AS share_pct "
            f"FROM (SELECT *, SUM(downloads) OVER (PARTITION BY download_date) AS tot FROM ({_ADOPTION}) a) b GROUP BY download_date"),
        "adoption_share_long": _with(
            f"SELECT download_date, version, round(CASE WHEN tot > 0 THEN CAST(downloads AS DOUBLE) / tot * 100.0 "
            f"ELSE 0.0 END, 6) AS share_pct FROM (SELECT *, SUM(downloads) OVER (PARTITION BY download_date) AS tot "
            f"FROM ({_ADOPTION}) a) b"),
        "kpi_cards": _with_kpi("SELECT * EXCLUDE (week_change, month_change) FROM kpi"),
        "sparkline": _with(
            f"SELECT * FROM (SELECT * FROM ({_weekly_sql(AS_OF)}) w ORDER BY week_start_date DESC LIMIT 12) l "
            f"WHERE (SELECT count(*) FROM (SELECT * FROM ({_weekly_sql(AS_OF)}) w2 "
            f"ORDER BY week_start_date DESC LIMIT 12) c) >= 2"),
        "series_slice": _with(
            f"SELECT * FROM ({_weekly_sql(AS_OF)}) w WHERE week_start_date BETWEEN '{min(SLICE)}' AND '{max(SLICE)}'"),
        "report_labels": _with(
            f"SELECT year_month, monthly_downloads, {_count_label('monthly_downloads')} AS monthly_downloads_label, "
            f"{_kpi_label('monthly_downloads')} AS monthly_downloads_kpi FROM ({_MONTHLY} LIMIT 6) m"),
        "daily_labels": _with(
            f"SELECT download_date, strftime(CAST(download_date AS DATE), '%b %-d, %y') AS date_label, "
            f"{_count_label('daily_downloads')} AS daily_downloads_label FROM ({_daily_sql(0)}) d"),
        "kpi_labels": _with_kpi(
            f"SELECT last_week_start, {_kpi_label('last_week_downloads')} AS last_week_label, "
            f"{_pct_label('week_change_pct')} AS week_change_label, "
            f"{_kpi_label('last_month_downloads')} AS last_month_label, "
            f"{_pct_label('month_change_pct')} AS month_change_label, "
            f"{_kpi_label('total_downloads')} AS total_label, "
            f"strftime(CAST(refresh_date AS DATE), '%b %-d, %Y') AS refresh_label FROM kpi"),
        "sql_over_rollup": _with(f"SELECT * FROM (WITH pypi_daily_stats AS (SELECT * FROM rollup) {USER_SQL}) q"),
        "published_rollup_sql": _with(f"SELECT * FROM (WITH pypi_daily_stats AS (SELECT * FROM rollup) {USER_SQL}) q"),
        "inline_rows_rollup": _with(f"SELECT {rollup_cols} FROM rollup").replace("\n),\nrollup", "".join(
            "\n  UNION ALL SELECT TIMESTAMP '2024-01-09 08:00:00', 'delta', 'FR', NULL, NULL, NULL, NULL, NULL" for _ in range(2))
            + "\n),\nrollup", 1),
        "scan_log_from_path": _with(
            f"SELECT {_FLAT} FROM log WHERE project = 'alpha' AND \"timestamp\" >= TIMESTAMP '2024-01-10' "
            "AND \"timestamp\" < TIMESTAMP '2024-01-20 12:00:00'"),
        "ingest_into_created_target": _with(f"SELECT {_FLAT} FROM log WHERE project = 'gamma'"),
        "report_bundle": _bundle_sql(30),
        "report_bundle_bad_period": _bundle_sql(0),
        "series_slice_missing_bound": _with(_weekly_sql(AS_OF)),
        "replace_range": _with(
            f"SELECT {_FLAT} FROM log WHERE NOT ({in_range})\n"
            f"UNION ALL SELECT {_FLAT} FROM log WHERE project = 'alpha' AND {in_range}"),
        "replace_range_scoped": _with(
            f"SELECT {_FLAT} FROM log WHERE NOT ({in_range} AND project = 'alpha')\n"
            f"UNION ALL SELECT {_FLAT} FROM log WHERE project = 'alpha' AND {in_range}"),
        "replace_range_emptied_date": _with(
            f"SELECT {_FLAT} FROM log WHERE CAST(\"timestamp\" AS DATE) NOT IN "
            "(DATE '2024-01-10', DATE '2024-01-12', DATE '2024-01-13')"),
        "replace_range_null_ts": _with(
            f"SELECT {_FLAT} FROM log WHERE NOT ({no_ts})\n" + "\n".join(
                f"UNION ALL SELECT CAST(NULL AS TIMESTAMP) AS {_FLAT} FROM log WHERE {no_ts}" for _ in range(2))),
        "replace_range_rejected": _with(f"SELECT {_FLAT} FROM log"),
        "delete_range": _with(
            f"SELECT {_FLAT} FROM log WHERE NOT (\"timestamp\" >= TIMESTAMP '2024-01-10 06:00:00' "
            "AND \"timestamp\" < TIMESTAMP '2024-01-14')"),
        "delete_all_then_reload": _with(f"SELECT {_FLAT} FROM log"),
        "upsert_by_key": _upsert_sql(),
        "delete_range_frame": _with(
            f"SELECT {_FLAT} FROM log WHERE NOT (\"timestamp\" >= TIMESTAMP '2024-01-10 06:00:00' "
            "AND \"timestamp\" < TIMESTAMP '2024-01-14')"),
        "quality_report_staged": _with(_quality_sql("project").replace(
            "FROM log) s",
            "FROM log WHERE project = 'alpha' AND \"timestamp\" >= TIMESTAMP '2024-01-10' "
            "AND \"timestamp\" < TIMESTAMP '2024-01-20 12:00:00') s")),
        "append_chunks": _with(f"SELECT {rollup_cols} FROM rollup"),
        "export_partitioned": _with(
            f"SELECT {rollup_cols}, year(download_date) AS year, month(download_date) AS month FROM rollup"),
        "export_pruned": _with(
            f"SELECT {rollup_cols}, year(download_date) AS year, month(download_date) AS month FROM rollup "
            "WHERE download_date >= DATE '1998-03-15' AND download_date < DATE '1999-02-10'"),
        "incremental_stream_rollup": _with(f"SELECT {rollup_cols} FROM rollup"),
        "incremental_stream_additive": _with(f"SELECT {rollup_cols} FROM rollup"),
        "ingest_transform_jobs": _with(
            f"SELECT {rollup_cols} FROM rollup "
            f"WHERE download_date >= DATE '{JOB_RANGE[0]}' AND download_date < DATE '{JOB_RANGE[1]}'"),
        "versioned_upsert": _upsert_sql(),
        "versioned_previous": _versions_sql(f"SELECT {rollup_cols} FROM early"),
        "versioned_restored": _versions_sql(f"SELECT {rollup_cols} FROM early"),
        "versioned_history": _versions_sql(
            "SELECT version, count(*) AS n_rows, CAST(sum(daily_download_sum) AS BIGINT) AS downloads FROM ("
            "SELECT 1 AS version, * FROM early UNION ALL SELECT 4, * FROM early UNION ALL SELECT 2, * FROM upserted "
            "UNION ALL SELECT 3, * FROM upserted WHERE NOT (download_date >= DATE '1996-01-01' AND download_date < DATE '1998-01-01')) x "
            "GROUP BY version"),
        "versioned_replace_range": _with(
            f"SELECT {_FLAT} FROM log WHERE NOT ({in_range})\n"
            f"UNION ALL SELECT {_FLAT} FROM log WHERE project = 'alpha' AND {in_range}"),
        "lattice_bundle": _bundle_sql(30, _upserted_rollup()),
        "report_bundle_shared": _bundle_sql(30),
        "append_exact_chunks": _with(
            "SELECT n_rows, n_files FROM (SELECT 500 AS n_rows, count(*) // 500 AS n_files FROM rollup "
            "UNION ALL SELECT count(*) % 500, 1 FROM rollup) x WHERE n_rows > 0 AND n_files > 0"),
        "scan_log_folder": _with(
            f"SELECT {_FLAT} FROM log WHERE project = 'alpha' AND \"timestamp\" >= TIMESTAMP '2024-01-10' "
            "AND \"timestamp\" < TIMESTAMP '2024-01-20 12:00:00'"),
        "upsert_bucketed": _upsert_sql(),
        "quality_gate_outcomes": _with(
            "SELECT p.project, count(l.project) AS total_rows, CASE WHEN count(l.project) = 0 THEN 'No rows loaded' "
            "WHEN 100.0 * (count(l.project) - count(l.country_code)) / count(l.project) > 5 THEN "
            "printf('%.1f', 100.0 * (count(l.project) - count(l.country_code)) / count(l.project)) || "
            "'% of country_code values are null (threshold: 5%)' ELSE 'passed' END AS outcome "
            "FROM (VALUES ('alpha'), ('beta'), ('gamma'), ('nobody')) p(project) LEFT JOIN log l ON l.project = p.project GROUP BY p.project"),
        "custom_timestamp": _with(
            f"SELECT {rollup_cols} FROM rollup WHERE project = 'gamma' AND download_date >= DATE '1997-01-01' "
            "AND download_date < DATE '1999-07-01'"),
        "daily_series_today": _with(
            f"SELECT CAST(DATE '{AS_OF}' - download_date AS INTEGER) AS days_ago, CAST(SUM(daily_download_sum) AS BIGINT) AS daily_downloads "
            f"FROM rollup WHERE download_date >= DATE '{AS_OF}' - INTERVAL '30 days' GROUP BY download_date"),
        "ingest_transform_jobs_all": _with(f"SELECT {rollup_cols} FROM rollup"),
        "incremental_stream_rollup_all": _with(f"SELECT {rollup_cols} FROM rollup"),
    }


def _breakdowns_sql(days: int) -> str:
    """Top 10 per dimension, each dimension ranked on its own (one UNION ALL branch each)."""
    parts = [
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, CAST(SUM(daily_download_sum) AS BIGINT) "
        f"AS total_downloads FROM rollup WHERE download_date >= DATE '{AS_OF}' - INTERVAL '{days} days' GROUP BY {d}"
        for d in ("version", "python_version", "country_code")
    ]
    return ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY total_downloads DESC, "
            "value ASC NULLS LAST) AS rank FROM (" + " UNION ALL ".join(parts) + ") u) r WHERE rank <= 10")


def _with_kpi(body: str) -> str:
    log = _EVENTS_LOG + "\n  UNION ALL" + _ORDERS_LOG
    return f"WITH log AS ({log}\n),\nrollup AS ({_rollup_sql()}\n),{_KPI}\n{body}"


def _quality_sql(key: str) -> str:
    return f"""
  SELECT total_rows, non_null_timestamps, non_null_keys, min_ts, max_ts,
         round(CASE WHEN total_rows > 0 THEN (total_rows - non_null_timestamps) * 100.0 / total_rows END, 6)
           AS null_ts_pct,
         round(CASE WHEN total_rows > 0 THEN (total_rows - non_null_keys) * 100.0 / total_rows END, 6)
           AS null_key_pct,
         COALESCE(total_rows > 0
                  AND (total_rows - non_null_timestamps) * 100.0 / total_rows <= 5
                  AND (total_rows - non_null_keys) * 100.0 / total_rows <= 5, FALSE) AS passed
  FROM (SELECT COUNT(*) AS total_rows, COUNT("timestamp") AS non_null_timestamps, COUNT({key}) AS non_null_keys,
               MIN("timestamp") AS min_ts, MAX("timestamp") AS max_ts FROM log) s"""


_ROLLUP_TEXT = ", ".join(
    "CAST(download_date AS VARCHAR) AS download_date" if c == "download_date" else c for c in ROLLUP_COLUMNS)


def _versions_sql(body: str) -> str:
    """``early``: version 1 of the versioned queries; ``upserted``: version 2."""
    with_ = _upsert_sql().split("\nSELECT")[0]
    return (f"{with_},\nupserted AS (SELECT * FROM early e WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.load_id = e.load_id)\n"
            f"UNION ALL SELECT * FROM batch)\n{body}")


def _upserted_rollup() -> str:
    """A WITH clause whose rollup is that after the upsert."""
    return _versions_sql("").rstrip() + ",\nrollup AS (SELECT * FROM upserted)"


def _upsert_sql() -> str:
    log = _EVENTS_LOG + "\n  UNION ALL" + _ORDERS_LOG
    early = _rollup_sql("(SELECT * FROM log WHERE \"timestamp\" < TIMESTAMP '2024-01-20 12:00:00') l")
    batch = _rollup_sql("log", "WHERE download_date >= DATE '2024-01-19'")
    cols = _ROLLUP_TEXT
    return (f"WITH log AS ({log}\n),\nearly AS ({early}),\nbatch AS ({batch})\n"
            f"SELECT {cols} FROM early e WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.load_id = e.load_id)\n"
            f"UNION ALL SELECT {cols} FROM batch")
