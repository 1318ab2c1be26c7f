"""All reports of one request from one scan of the rollup.

One aggregate with GROUPING SETS over week, month, date, (date, version) and the
three breakdown dimensions gives every sum that the thirteen frames need, all-time
and within the request's trailing days. Its rows are few (days, weeks, months,
versions, ...); they are written once to the shared scratch folder, one folder a
set, and each frame is a small query over its own set. So the rollup is read once
whatever the number of reports, and nothing is held in executor memory for them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usage_rollup.functions.columns import date_label, month_bucket, month_label, week_bucket
from usage_rollup.operators import reports as R
from usage_rollup.params import safe_period
from usage_rollup.session import scratch_dir
from usage_rollup.sources import storage

#: Grouping columns, in the order of the grouping id's bits (first = highest).
_KEYS = ("week", "month", "day", "version", "python_version", "country_code")
#: What each set is called and holds.
SETS = {"week": ("week",), "month": ("month",), "day": ("day",), "adoption": ("day", "version"),
        "version": ("version",), "python_version": ("python_version",), "country_code": ("country_code",)}
#: Frames whose rows grow with the history or the versions: written by the executors, never collected.
LONG_FRAMES = ("weekly_series", "daily_series", "version_adoption")


def _grouping_id(columns) -> int:
    """A column's bit is 0 where it is in the set."""
    return sum(1 << (len(_KEYS) - 1 - i) for i, k in enumerate(_KEYS) if k not in columns)


def shared_aggregate(rollup: DataFrame, days: int = 0, as_of=None) -> DataFrame:
    """(kind, the set's columns, total, recent) for every set in ``SETS``; one shuffle.

    ``recent`` sums the trailing ``days`` (0: everything) and is NULL for a group without
    rows in them. Adoption rows are those of the release lines.
    """
    n = F.col(R.N)
    recent = n if not days else F.when(F.col(R.DATE) >= F.date_sub(R._as_of(as_of), int(days)), n)
    src = rollup.select(week_bucket(R.DATE).alias("week"), month_bucket(R.DATE).alias("month"), F.col(R.DATE).alias("day"),
                        "version", "python_version", "country_code", n.alias("_n"), recent.alias("_recent"))
    kind = F.lit(None).cast("string")
    for name, columns in SETS.items():
        kind = F.when(F.col("_gid") == _grouping_id(columns), F.lit(name)).otherwise(kind)
    sums = src.groupingSets([list(c) for c in SETS.values()], *_KEYS).agg(
        F.sum("_n").cast("bigint").alias("total"), F.sum("_recent").cast("bigint").alias("recent"), F.grouping_id().alias("_gid"))
    named = sums.withColumn("kind", kind).drop("_gid")
    release = R.release_filter(named.where("kind = 'adoption'"))
    return named.where("kind <> 'adoption'").unionByName(release)


class SharedBundle(dict):
    """The thirteen frames of one request by name, over one stored aggregate; ``release()`` removes that."""

    def __init__(self, rollup: DataFrame, days: int = 0, as_of=None, project: str | None = None):
        super().__init__()
        spark = rollup.sparkSession
        days = safe_period(days)
        if project is not None:
            rollup = rollup.where(F.col("project") == F.lit(project))
        base = shared_aggregate(rollup, days, as_of)
        self.spark, self.path = spark, scratch_dir(spark, "bundle")
        base.write.partitionBy("kind").parquet(self.path)
        schema = base.schema
        self.stored = lambda kind: spark.read.schema(schema).parquet(self.path).where(F.col("kind") == kind)
        self._frames(days, as_of)

    def _frames(self, days: int, as_of) -> None:
        week, month, day = self.stored("week"), self.stored("month"), self.stored("day")
        floor = week_bucket(F.date_sub(R._as_of(as_of), 28))
        newest = week.where(F.col("week") >= floor).select(F.max("week")).scalar()
        weekly = week.where(F.col("week") != newest).select(date_label("week").alias("week_start_date"), F.col("total").alias("weekly_downloads"))
        monthly = month.select("month", month_label("month").alias("year_month"), F.col("total").alias("monthly_downloads"))
        months = monthly.orderBy(F.col("month").desc_nulls_last())
        totals = day.agg(F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total_downloads"),
                         F.coalesce(date_label(F.max("day")), F.lit("")).alias("refresh_date"))

        def top(dim: str) -> DataFrame:
            found = self.stored(dim).where("recent is not null").select(dim, F.col("recent").alias("total_downloads"))
            return found.orderBy(F.col("total_downloads").desc_nulls_last(), F.col(dim).asc_nulls_last()).limit(R.TOP_N)

        two_weeks = weekly.orderBy(F.col("week_start_date").desc_nulls_last()).limit(2)
        two_months = months.offset(1).limit(2).drop("month")
        self.update({
            "period": R.period_echo(self.spark, days),
            "weekly_series": weekly.orderBy(F.col("week_start_date").asc_nulls_last()),
            "last_two_weeks": two_weeks,
            "monthly_recent": months.limit(6).drop("month"),
            "last_two_months": two_months,
            "total_downloads": totals.select("total_downloads"),
            "refresh_date": totals.select(F.col("refresh_date").alias("max_date")),
            "top_versions": top("version"),
            "top_runtimes": top("python_version"),
            "top_countries": top("country_code"),
            "version_adoption": self.stored("adoption").select(date_label("day").alias("download_date"), "version", F.col("total").alias("downloads"))
            .orderBy(F.col("download_date").asc_nulls_last(), F.col("version").asc_nulls_last()),
            "daily_series": day.where("recent is not null").select(date_label("day").alias("download_date"), F.col("recent").alias("daily_downloads"))
            .orderBy(F.col("download_date").asc_nulls_last()),
            "kpi_cards": R.kpi_row(two_weeks, two_months, totals),
        })

    def release(self) -> None:
        """Remove the stored aggregate; the frames cannot be read after that."""
        storage.delete_path(self.spark, self.path)


def write_reports(bundle: dict, path: str) -> dict:
    """Write a bundle under ``path``; returns the summary.

    The long frames become JSON-lines folders written by the executors; the others (scalars, pairs,
    top-N) are a few rows each: they are collected and written as ``summary.json``.
    """
    summary = {}
    for name, frame in bundle.items():
        if name in LONG_FRAMES:
            frame.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")
        else:
            summary[name] = [r.asDict() for r in frame.collect()]
    spark = bundle["period"].sparkSession
    storage.write_text(spark, f"{path.rstrip('/')}/summary.json", json.dumps(summary, default=str))
    return summary
