"""Report operators over the daily rollup (series, totals, top-N, adoption, KPIs).

Every report reads the rollup (never the raw log), aggregates with a
partial + final hash aggregate, and returns a small frame. Conventions:

* ``as_of`` replaces the wall clock (default ``current_date()``) so results
  are reproducible; trailing windows are ``date >= as_of - N days``.
* Series labels are ``yyyy-MM-dd`` / ``yyyy-MM`` strings; sums are BIGINT.
* Scalar comparisons (newest loaded week, label existence) are uncorrelated
  scalar subqueries (``DataFrame.scalar()``): one tiny aggregate job whose
  value is inlined, instead of a join.
* Nulls sort last in both directions; top-N ties break on the dimension.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usage_rollup.functions.columns import date_label, month_bucket, month_label, week_bucket
from usage_rollup.functions.labels import period_label
from usage_rollup.params import safe_period
from usage_rollup.session import scratch_dir

DATE = "download_date"
MONTH = "download_month"  # partition column of a stored rollup, when present
N = "daily_download_sum"

# Release-line prefixes of the adoption report and the
# marker that excludes development builds.
ADOPTION_PREFIXES = ("1.2", "1.3", "1.4")
DEV_MARKER = "dev"
TOP_N = 10


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))


def _sum_n(name: str) -> Column:
    return F.sum(N).cast("bigint").alias(name)


# --- filters -------------------------------------------------------------


def trailing_days(rollup: DataFrame, days: int, as_of=None, date_col: str = DATE) -> DataFrame:
    """Keep ``date >= as_of - days`` (inclusive, so 7 spans up to 8 dates); 0 = all."""
    days = int(days or 0)
    if days <= 0:
        return rollup
    lower = F.date_sub(_as_of(as_of), days)
    return _prune_months(rollup, lower).where(F.col(date_col) >= lower)


def _prune_months(rollup: DataFrame, lower: Column) -> DataFrame:
    """On a month-partitioned rollup, state the lower bound on the partition too."""
    if MONTH in rollup.columns:
        return rollup.where(F.col(MONTH) >= F.trunc(lower, "month"))
    return rollup


def newest_recent_week(rollup: DataFrame, as_of=None, weeks: int = 4) -> Column:
    """Scalar: newest loaded week among weeks >= week(as_of - 4 weeks); NULL if none."""
    wk = week_bucket(DATE)
    floor = week_bucket(F.date_sub(_as_of(as_of), 7 * weeks))
    # floor is a Monday, so week(d) >= floor  <=>  d >= floor; the plain date
    # form is what the Parquet reader can take as a pushed filter
    return _prune_months(rollup, floor).where(F.col(DATE) >= floor).select(F.max(wk)).scalar()


def release_filter(df: DataFrame, prefixes=ADOPTION_PREFIXES, exclude=DEV_MARKER, col: str = "version") -> DataFrame:
    """``NOT LIKE '%dev%' AND (LIKE '1.2%' OR ...)``; NULL versions drop out."""
    v = F.col(col)
    keep = reduce(lambda a, b: a | b, [v.startswith(p) for p in prefixes])
    return df.where(~v.contains(exclude) & keep)


def series_slice(series: DataFrame, label_col: str, a, b) -> DataFrame:
    """Inclusive label-to-label slice of an ordered series, bounds in any order.

    Equal or missing bounds, or a bound that is not a label of the series,
    leave it unchanged. The existence check is a scalar subquery.
    """
    if a is None or b is None or a == b:
        return series
    lo, hi = (a, b) if a < b else (b, a)
    c = F.col(label_col)
    found = series.where(c.isin(lo, hi)).select(F.count_distinct(c)).scalar()
    return series.where((found < F.lit(2)) | c.between(F.lit(lo), F.lit(hi)))


# --- series --------------------------------------------------------------


def _weekly(rollup: DataFrame, as_of=None) -> DataFrame:
    wk = week_bucket(DATE)
    newest = newest_recent_week(rollup, as_of)
    return (
        rollup.where(wk != newest)
        .groupBy(wk.alias("_week"))
        .agg(_sum_n("weekly_downloads"))
        .select(date_label("_week").alias("week_start_date"), "weekly_downloads")
    )


def weekly_series(rollup: DataFrame, as_of=None) -> DataFrame:
    """All weeks except the newest loaded one; empty if nothing loaded in the last 4 weeks."""
    return _weekly(rollup, as_of).orderBy(F.col("week_start_date").asc_nulls_last())


def last_two_weeks(rollup: DataFrame, as_of=None) -> DataFrame:
    """Newest two rows of the weekly series, newest first."""
    return _weekly(rollup, as_of).orderBy(F.col("week_start_date").desc_nulls_last()).limit(2)


def _monthly(rollup: DataFrame) -> DataFrame:
    return (
        rollup.groupBy(month_bucket(DATE).alias("_month"))
        .agg(_sum_n("monthly_downloads"))
        .select("_month", month_label("_month").alias("year_month"), "monthly_downloads")
    )


def monthly_recent(rollup: DataFrame, n: int = 6) -> DataFrame:
    """Newest ``n`` months (the running month included), newest first."""
    return _monthly(rollup).orderBy(F.col("_month").desc_nulls_last()).limit(n).drop("_month")


def last_two_months(rollup: DataFrame) -> DataFrame:
    """The two months before the newest (``LIMIT 2 OFFSET 1``), newest first."""
    return _monthly(rollup).orderBy(F.col("_month").desc_nulls_last()).offset(1).limit(2).drop("_month")


def daily_series(rollup: DataFrame, days: int = 0, as_of=None) -> DataFrame:
    """Downloads per date, ascending, optionally over a trailing window."""
    return (
        trailing_days(rollup, days, as_of)
        .groupBy(DATE)
        .agg(_sum_n("daily_downloads"))
        .select(date_label(DATE).alias("download_date"), "daily_downloads")
        .orderBy(F.col("download_date").asc_nulls_last())
    )


# --- scalars -------------------------------------------------------------


def total_downloads(rollup: DataFrame) -> DataFrame:
    """One row: all-time sum, 0 when empty."""
    return rollup.agg(F.coalesce(F.sum(N), F.lit(0)).cast("bigint").alias("total_downloads"))


def refresh_date(rollup: DataFrame) -> DataFrame:
    """One row: newest date as ``yyyy-MM-dd``, ``''`` when empty."""
    return rollup.agg(F.coalesce(date_label(F.max(DATE)), F.lit("")).alias("max_date"))


# --- breakdowns ----------------------------------------------------------


def top_by(rollup: DataFrame, dim: str, days: int = 0, as_of=None, n: int = TOP_N, alias: str | None = None) -> DataFrame:
    """Top ``n`` values of ``dim`` by summed downloads (NULL is a value).

    Order: total desc, then the dimension ascending (nulls last) so ties are
    deterministic. Planned as TakeOrderedAndProject (a per-partition top-n
    then a single merge of n rows per partition).
    """
    out = alias or dim
    return (
        trailing_days(rollup, days, as_of)
        .groupBy(F.col(dim).alias(out))
        .agg(_sum_n("total_downloads"))
        .orderBy(F.col("total_downloads").desc_nulls_last(), F.col(out).asc_nulls_last())
        .limit(n)
    )


def top_versions(rollup, days=0, as_of=None, n=TOP_N, alias="version"):
    return top_by(rollup, "version", days, as_of, n, alias)


def top_runtimes(rollup, days=0, as_of=None, n=TOP_N):
    return top_by(rollup, "python_version", days, as_of, n)


def top_countries(rollup, days=0, as_of=None, n=TOP_N):
    return top_by(rollup, "country_code", days, as_of, n)


def top_breakdowns(rollup: DataFrame, days: int = 0, as_of=None, n: int = TOP_N,
                   dims=("version", "python_version", "country_code")) -> DataFrame:
    """R7-R9 in one pass: top ``n`` per dimension -> (dimension, value, total_downloads, rank).

    One scan and one shuffle with GROUPING SETS (one set per dimension); the
    ranking window then runs over the aggregated rows only, partitioned by
    dimension (each partition holds that dimension's distinct values).
    Same order and tie-break as ``top_by``.
    """
    src = trailing_days(rollup, days, as_of).select(*dims, N)
    g = src.groupingSets([[d] for d in dims], *dims).agg(
        _sum_n("total_downloads"), F.grouping_id().alias("_gid"))
    # grouping_id has a 0 bit for the dimension in the set, 1s elsewhere
    width = len(dims)
    which = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        gid = (1 << width) - 1 - (1 << (width - 1 - i))
        which = F.when(F.col("_gid") == gid, F.lit(d)).otherwise(which)
        value = F.when(F.col("_gid") == gid, F.col(d).cast("string")).otherwise(value)
    long = g.select(which.alias("dimension"), value.alias("value"), "total_downloads")
    w = Window.partitionBy("dimension").orderBy(F.col("total_downloads").desc_nulls_last(),
                                                F.col("value").asc_nulls_last())
    return long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def version_adoption(rollup: DataFrame, prefixes=ADOPTION_PREFIXES, exclude=DEV_MARKER) -> DataFrame:
    """Long form (date, version, downloads) over release versions, by date."""
    return (
        release_filter(rollup, prefixes, exclude)
        .groupBy(DATE, "version")
        .agg(_sum_n("downloads"))
        .select(date_label(DATE).alias("download_date"), "version", "downloads")
        .orderBy(F.col("download_date").asc_nulls_last(), F.col("version").asc_nulls_last())
    )


def adoption_versions(adoption: DataFrame) -> DataFrame:
    """Distinct versions of the adoption report, sorted (one per pivot column)."""
    return adoption.select("version").distinct().orderBy(F.col("version").asc_nulls_last())


def version_column(v: str) -> str:
    """Column name for a pivoted version: ``1.2.0`` -> ``v1_2_0``."""
    return "v" + "".join(ch if ch.isalnum() else "_" for ch in v)


def adoption_map(adoption: DataFrame) -> DataFrame:
    """One row per date with a map version -> downloads, keys ascending: (download_date, downloads).

    The pivot without a width: no list of versions is needed beforehand, no column
    limit applies, and a date's row holds only the versions it has. Rows that name
    a version of a date twice are summed. One shuffle, on the date.
    """
    once = (adoption.repartition("download_date").groupBy("download_date", "version")
            .agg(F.sum("downloads").cast("bigint").alias("downloads")).where(F.col("version").isNotNull()))
    pairs = F.sort_array(F.collect_list(F.struct("version", "downloads")))
    return once.groupBy("download_date").agg(F.map_from_entries(pairs).alias("downloads"))


def adoption_share_map(pivot: DataFrame) -> DataFrame:
    """``adoption_map`` with shares of the date's total in percent (a zero total gives 0)."""
    total = F.aggregate(F.map_values("downloads"), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    share = lambda _, v: F.when(F.col("_total") > 0, F.coalesce(v, F.lit(0)) / F.col("_total") * 100.0).otherwise(0.0)
    return pivot.withColumn("_total", total.cast("double")).select(
        "download_date", F.transform_values("downloads", share).alias("share_pct"))


def listed_versions(adoption: DataFrame) -> tuple[DataFrame, list[str]]:
    """The adoption rows, written once to the shared scratch folder, and their versions.

    What a wide form needs to know its columns; the rollup behind the rows is read
    once instead of once for the list and once for the pivot.
    """
    spark = adoption.sparkSession
    path = scratch_dir(spark, "adoption")
    adoption.write.parquet(path)
    rows = spark.read.schema(adoption.schema).parquet(path)
    return rows, [r["version"] for r in adoption_versions(rows).collect() if r["version"] is not None]


def adoption_pivot(adoption: DataFrame, versions=None) -> DataFrame:
    """One row per date, one column per version; gaps stay NULL, repeated rows are summed.

    Without ``versions`` they are listed first (``listed_versions``). The width is
    not limited by ``spark.sql.pivotMaxValues``; very wide results are better taken as
    ``adoption_map`` or in ``adoption_pivot_blocks``.
    """
    if versions is None:
        adoption, versions = listed_versions(adoption)
    piv = adoption.groupBy("download_date").pivot("version", list(versions)).agg(F.sum("downloads").cast("bigint"))
    cols = [c for c in piv.columns if c != "download_date"]
    return piv.select(
        "download_date", *[F.col(f"`{c}`").alias(version_column(c)) for c in cols]
    ).orderBy(F.col("download_date").asc_nulls_last())


def adoption_pivot_blocks(adoption: DataFrame, width: int = 500, versions=None) -> list[DataFrame]:
    """The wide pivot as frames of at most ``width`` version columns, every date in each."""
    if versions is None:
        adoption, versions = listed_versions(adoption)
    return [adoption_pivot(adoption, versions[i:i + width]) for i in range(0, len(versions), width)]


def adoption_share(pivot: DataFrame, digits: int | None = None) -> DataFrame:
    """Share of the date's total per version column: value/total*100, rounded if ``digits`` is given.

    Missing -> 0; a zero total -> 0; the total is over the pivoted versions.
    Pure projection over the pivot (no extra shuffle).
    """
    vcols = [c for c in pivot.columns if c != "download_date"]
    if not vcols:
        return pivot
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in vcols]).cast("double")
    out = pivot.withColumn("_total", total)  # taken once, not once a column
    share = lambda c: F.when(F.col("_total") > 0, F.coalesce(F.col(c), F.lit(0)) / F.col("_total") * 100.0).otherwise(0.0)
    return out.select("download_date", *[_rounded(share(c), digits).alias(c) for c in vcols])


def _rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def adoption_share_long(adoption: DataFrame, digits: int | None = None) -> DataFrame:
    """Long-form share: downloads / per-date total * 100 (window per date)."""
    w = Window.partitionBy("download_date")
    tot = F.sum("downloads").over(w)
    return adoption.select(
        "download_date",
        "version",
        _rounded(F.when(tot > 0, F.col("downloads") / tot * 100.0).otherwise(F.lit(0.0)), digits).alias("share_pct"),
    )


# --- KPI shaping -----------------------------------------------------------


def change_pct(pair: DataFrame, label: str, value: str, digits: int | None = None) -> DataFrame:
    """Last vs previous over a <=2-row frame -> (last, previous, change_pct).

    ``change_pct = (last - previous) / previous * 100``; NULL unless both rows
    exist, and NULL when previous is 0.
    """
    k = F.count(F.lit(1))
    cur = F.max_by(value, label)
    prev = F.when(k == 2, F.min_by(value, label))
    pct = F.when(k == 2, F.try_divide((cur - prev) * 100.0, prev.cast("double")))
    pct = _rounded(pct, digits)
    return pair.agg(
        F.max(label).alias("last_label"),
        cur.alias("last_value"),
        F.when(k == 2, F.min(label)).alias("previous_label"),
        prev.alias("previous_value"),
        pct.alias("change_pct"),
    )


def sparkline(rollup: DataFrame, as_of=None, points: int = 12, min_points: int = 2) -> DataFrame:
    """Last ``points`` weeks of the weekly series, ascending; empty if < ``min_points``."""
    last = _weekly(rollup, as_of).orderBy(F.col("week_start_date").desc_nulls_last()).limit(points)
    n = last.select(F.count(F.lit(1))).scalar()
    return last.where(n >= F.lit(min_points)).orderBy(F.col("week_start_date").asc_nulls_last())


def kpi_cards(rollup: DataFrame, as_of=None, digits: int | None = None) -> DataFrame:
    """One KPI row: last/previous week and month with change, total, freshness.

    Anchored on the single-row total/freshness aggregate; week and month pairs
    enter as two scalar subqueries over their <=2-row frames (no joins).
    """
    anchor = rollup.agg(
        F.coalesce(F.sum(N), F.lit(0)).cast("bigint").alias("total_downloads"),
        F.coalesce(date_label(F.max(DATE)), F.lit("")).alias("refresh_date"),
    )
    return kpi_row(last_two_weeks(rollup, as_of), last_two_months(rollup), anchor, digits)


def kpi_row(weeks: DataFrame, months: DataFrame, anchor: DataFrame, digits: int | None = None) -> DataFrame:
    """The KPI row from the newest two weeks, the two months before the newest, and the totals' row."""
    wk = change_pct(weeks, "week_start_date", "weekly_downloads", digits)
    mo = change_pct(months, "year_month", "monthly_downloads", digits)
    # one scalar subquery per pair, returning the whole pair as a struct; the
    # fields are read in a second projection so each subquery runs once
    w = wk.select(F.struct(*wk.columns)).scalar()
    m = mo.select(F.struct(*mo.columns)).scalar()
    return anchor.select(w.alias("_w"), m.alias("_m"), "total_downloads", "refresh_date").select(
        F.col("_w.last_label").alias("last_week_start"),
        F.col("_w.last_value").alias("last_week_downloads"),
        F.col("_w.previous_value").alias("previous_week_downloads"),
        F.col("_w.change_pct").alias("week_change_pct"),
        F.col("_m.last_label").alias("last_month"),
        F.col("_m.last_value").alias("last_month_downloads"),
        F.col("_m.previous_value").alias("previous_month_downloads"),
        F.col("_m.change_pct").alias("month_change_pct"),
        "total_downloads",
        "refresh_date",
    )


# --- bundle ------------------------------------------------------------------


def period_echo(spark, days: int) -> DataFrame:
    """One row: the period of a request and its label (reads no table)."""
    return spark.range(1).select(F.lit(int(days)).alias("period_days"), period_label(F.lit(int(days))).alias("period_label"))


def report_bundle(rollup: DataFrame, days: int = 0, as_of=None) -> dict[str, DataFrame]:
    """All reports for one request; ``days`` is whitelisted to {0,7,30,90}.

    Covers every field of the original bundle: the KPI pairs, total and
    freshness (``kpi_cards``, ``last_two_*``), the series, the breakdowns, the
    adoption rows and the period echo. Cache ``rollup`` before calling when the
    frames are evaluated one by one.
    """
    days = safe_period(days)
    return {
        "period": period_echo(rollup.sparkSession, days),
        "weekly_series": weekly_series(rollup, as_of),
        "last_two_weeks": last_two_weeks(rollup, as_of),
        "monthly_recent": monthly_recent(rollup),
        "last_two_months": last_two_months(rollup),
        "total_downloads": total_downloads(rollup),
        "refresh_date": refresh_date(rollup),
        "top_versions": top_versions(rollup, days, as_of),
        "top_runtimes": top_runtimes(rollup, days, as_of),
        "top_countries": top_countries(rollup, days, as_of),
        "version_adoption": version_adoption(rollup),
        "daily_series": daily_series(rollup, days, as_of),
        "kpi_cards": kpi_cards(rollup, as_of),
    }


def bundle_long(bundle: dict[str, DataFrame]) -> DataFrame:
    """Tag and union all reports of the bundle into (report, label, n)."""
    def tag(name, label: Column, n: Column):
        return bundle[name].select(F.lit(name).alias("report"), label.alias("label"), n.cast("bigint").alias("n"))

    kpi = bundle["kpi_cards"]
    # changes in millionths of a percent, so that every value is a whole number
    facts = [F.struct(F.concat_ws("|", F.lit(c), *([F.col(of)] if of else [])).alias("label"), v.cast("bigint").alias("n"))
             for c, of, v in [(c, of, F.round(F.col(c) * (1e6 if c.endswith("pct") else 1))) for c, of in (
                 ("last_week_downloads", "last_week_start"), ("previous_week_downloads", None), ("week_change_pct", None),
                 ("last_month_downloads", "last_month"), ("previous_month_downloads", None), ("month_change_pct", None),
                 ("total_downloads", "refresh_date"))]]
    cards = kpi.select(F.inline(F.array(*facts))).select(F.lit("kpi_cards").alias("report"), "label", "n")
    parts = [
        tag("period", F.col("period_label"), F.col("period_days")),
        cards,
        tag("weekly_series", F.col("week_start_date"), F.col("weekly_downloads")),
        tag("last_two_weeks", F.col("week_start_date"), F.col("weekly_downloads")),
        tag("monthly_recent", F.col("year_month"), F.col("monthly_downloads")),
        tag("last_two_months", F.col("year_month"), F.col("monthly_downloads")),
        tag("total_downloads", F.lit(""), F.col("total_downloads")),
        tag("refresh_date", F.col("max_date"), F.lit(None)),
        tag("top_versions", F.col("version"), F.col("total_downloads")),
        tag("top_runtimes", F.col("python_version"), F.col("total_downloads")),
        tag("top_countries", F.col("country_code"), F.col("total_downloads")),
        tag("version_adoption", F.concat_ws("|", "download_date", "version"), F.col("downloads")),
        tag("daily_series", F.col("download_date"), F.col("daily_downloads")),
    ]
    return reduce(DataFrame.unionByName, parts)
