import datetime as dt

import pytest
from pyspark.sql import functions as F

from usage_rollup.functions.labels import compact_count, compact_kpi, long_date, period_label, short_date, signed_percent
from usage_rollup.operators import reports as R

SCHEMA = "download_date date, version string, python_version string, country_code string, daily_download_sum bigint"


def rollup(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def d(s):
    return dt.date.fromisoformat(s)


def test_weekly_excludes_newest_loaded_week_and_stale_is_empty(spark):
    rows = [(d("2024-01-01"), "1.0", "3.8", "US", 5), (d("2024-01-08"), "1.0", "3.8", "US", 7),
            (d("2024-01-10"), "1.0", "3.8", "US", 1), (d("2023-06-05"), "1.0", "3.8", "US", 2)]
    df = rollup(spark, rows)
    got = [tuple(r) for r in R.weekly_series(df, "2024-01-20").collect()]
    assert got == [("2023-06-05", 2), ("2024-01-01", 5)]
    assert R.weekly_series(df, "2024-06-01").count() == 0
    assert [tuple(r) for r in R.last_two_weeks(df, "2024-01-20").collect()] == [("2024-01-01", 5), ("2023-06-05", 2)]


def test_monthly_and_offset(spark):
    rows = [(d(f"2024-0{m}-03"), "1.0", "3.8", "US", m) for m in range(1, 9)]
    df = rollup(spark, rows)
    assert [r.year_month for r in R.monthly_recent(df).collect()] == [f"2024-0{m}" for m in range(8, 2, -1)]
    assert [tuple(r) for r in R.last_two_months(df).collect()] == [("2024-07", 7), ("2024-06", 6)]


def test_total_and_refresh_on_empty(spark):
    df = rollup(spark, [])
    assert R.total_downloads(df).first()[0] == 0
    assert R.refresh_date(df).first()[0] == ""


def test_trailing_days_inclusive_and_top_tie_break(spark):
    rows = [(d("2024-01-24"), "b", "3.8", None, 3), (d("2024-01-24"), "a", "3.9", "US", 3),
            (d("2024-01-23"), "c", "3.9", "US", 100), (d("2024-01-31"), None, None, None, 3)]
    df = rollup(spark, rows)
    got = [tuple(r) for r in R.top_versions(df, 7, "2024-01-31").collect()]
    assert got == [("a", 3), ("b", 3), (None, 3)]
    assert R.top_versions(df, 0, "2024-01-31").first()[0] == "c"
    assert [tuple(r) for r in R.top_countries(df, 7, "2024-01-31").collect()] == [(None, 6), ("US", 3)]
    assert R.top_by(df, "version", 0, None, n=2).count() == 2


def test_release_filter(spark):
    rows = [(d("2024-01-01"), v, "3.8", "US", 1) for v in ("1.2.0", "1.20.1", "1.3.0.dev4", "1.5.0", None, "1.4.1")]
    got = sorted(r.version for r in R.version_adoption(rollup(spark, rows)).collect())
    assert got == ["1.2.0", "1.20.1", "1.4.1"]


def test_pivot_and_share(spark):
    rows = [(d("2024-01-01"), "1.2.0", "3.8", "US", 1), (d("2024-01-01"), "1.3.0", "3.8", "US", 3),
            (d("2024-01-02"), "1.3.0", "3.8", "US", 2)]
    ad = R.version_adoption(rollup(spark, rows))
    piv = R.adoption_pivot(ad, ["1.2.0", "1.3.0", "1.4.0"])
    assert [tuple(r) for r in piv.collect()] == [("2024-01-01", 1, 3, None), ("2024-01-02", None, 2, None)]
    share = R.adoption_share(piv)
    assert [tuple(r) for r in share.collect()] == [("2024-01-01", 25.0, 75.0, 0.0), ("2024-01-02", 0.0, 100.0, 0.0)]
    auto = R.adoption_pivot(ad)
    assert auto.columns == ["download_date", "v1_2_0", "v1_3_0"]


def test_change_pct(spark):
    pair = spark.createDataFrame([("2024-02", 150), ("2024-01", 100)], "label string, n bigint")
    r = R.change_pct(pair, "label", "n").first()
    assert (r.last_value, r.previous_value, r.change_pct) == (150, 100, 50.0)
    zero = spark.createDataFrame([("2024-02", 150), ("2024-01", 0)], "label string, n bigint")
    assert R.change_pct(zero, "label", "n").first().change_pct is None
    one = spark.createDataFrame([("2024-02", 150)], "label string, n bigint")
    r1 = R.change_pct(one, "label", "n").first()
    assert r1.previous_value is None and r1.change_pct is None


def test_series_slice(spark):
    s = spark.createDataFrame([(f"2024-01-0{i}", i) for i in range(1, 8)], "lbl string, n bigint")
    assert [r.n for r in R.series_slice(s, "lbl", "2024-01-05", "2024-01-02").collect()] == [2, 3, 4, 5]
    assert R.series_slice(s, "lbl", "2024-01-03", "2024-01-03").count() == 7
    assert R.series_slice(s, "lbl", "2024-01-03", "2099-01-01").count() == 7
    assert R.series_slice(s, "lbl", None, "2024-01-03").count() == 7


def test_sparkline_needs_two_points(spark):
    rows = [(d("2024-01-01"), "1.0", "3.8", "US", 5), (d("2024-01-08"), "1.0", "3.8", "US", 7)]
    df = rollup(spark, rows)
    assert R.sparkline(df, "2024-01-20").count() == 0  # one point left after the newest week is excluded
    more = rollup(spark, rows + [(d("2023-12-25"), "1.0", "3.8", "US", 1)])
    assert [r.weekly_downloads for r in R.sparkline(more, "2024-01-20").collect()] == [1, 5]


def test_bundle_and_kpi(spark):
    rows = [(d("2024-01-01"), "1.2.0", "3.8", "US", 5), (d("2024-01-08"), "1.3.0", "3.8", "US", 7),
            (d("2024-01-15"), "1.3.0", "3.9", "DE", 1), (d("2023-12-04"), "1.2.0", "3.8", "US", 4)]
    b = R.report_bundle(rollup(spark, rows), days=5, as_of="2024-01-20")  # 5 is not allowed -> 0
    assert b["top_versions"].count() == 2
    k = b["kpi_cards"].first()
    assert (k.last_week_start, k.last_week_downloads, k.previous_week_downloads) == ("2024-01-08", 7, 5)
    assert k.week_change_pct == pytest.approx(40.0)
    assert (k.last_month, k.last_month_downloads, k.month_change_pct) == ("2023-12", 4, None)
    assert (k.total_downloads, k.refresh_date) == (17, "2024-01-15")
    assert R.bundle_long(b).where(F.col("report") == "total_downloads").first().n == 17


def test_labels(spark):
    df = spark.createDataFrame([(v,) for v in (999, 1000, 1150, 1250, 12345, 1_234_567, 2_500_000_000)], "n bigint")
    got = [tuple(r) for r in df.select(compact_count("n"), compact_kpi("n")).collect()]
    assert got == [("999", "999"), ("1.0K", "1.0K"), ("1.2K", "1.2K"), ("1.3K", "1.3K"), ("12.3K", "12.3K"),
                   ("1.2M", "1.23M"), ("2.5B", "2500.00M")]
    p = spark.createDataFrame([(12.34,), (-4.0,), (0.0,)], "p double").select(signed_percent("p")).collect()
    assert [r[0] for r in p] == ["+12.3%", "-4.0%", "0.0%"]
    dd = spark.createDataFrame([("2026-11-30",)], "s string").select(long_date("s"), short_date("s")).first()
    assert tuple(dd) == ("Nov 30, 2026", "Nov 30, 26")
    pl = spark.createDataFrame([(0,), (30,)], "d int").select(period_label("d")).collect()
    assert [r[0] for r in pl] == ["all time", "last 30 days"]


def test_top_breakdowns_equals_three_top_by(spark):
    from usage_rollup.operators.rollup import daily_rollup
    from usage_rollup.sources.driverdata import download_log

    r = daily_rollup(download_log(spark, "/root/testdata/sf0.001"))
    b = R.top_breakdowns(r, 30, "2024-01-31")
    for dim in ("version", "python_version", "country_code"):
        got = [(x.value, x.total_downloads) for x in
               b.where(F.col("dimension") == dim).orderBy("rank").collect()]
        want = [tuple(x) for x in R.top_by(r, dim, 30, "2024-01-31").collect()]
        assert got == want


def test_with_labels_adds_columns(spark):
    from usage_rollup.functions.labels import with_labels

    df = spark.createDataFrame([("2024-01-05", 1234, 12.5, 2_345_678)], "d string, n bigint, p double, k bigint")
    out = with_labels(df, count_cols=["n"], date_cols=["d"], pct_cols=["p"], kpi_cols=["k"]).first()
    assert (out.n_label, out.d_label, out.p_label, out.k_label) == ("1.2K", "Jan 5, 24", "+12.5%", "2.35M")


def test_share_long_matches_wide(spark):
    rows = [(d("2024-01-01"), "1.2.0", "3.8", "US", 1), (d("2024-01-01"), "1.3.0", "3.8", "US", 3),
            (d("2024-01-02"), "1.3.0", "3.8", "US", 2)]
    ad = R.version_adoption(rollup(spark, rows))
    long = {(r.download_date, r.version): r.share_pct for r in R.adoption_share_long(ad).collect()}
    assert long == {("2024-01-01", "1.2.0"): 25.0, ("2024-01-01", "1.3.0"): 75.0, ("2024-01-02", "1.3.0"): 100.0}


def test_label_rounding_is_decimal_half_up(spark):
    # D9: 1150 -> 1.15K rounds half-up on the decimal value ("1.2K"); binary-float
    # formatting would give "1.1K" here
    df = spark.createDataFrame([(1150,), (1_005_000,)], "n bigint")
    got = [tuple(r) for r in df.select(compact_count("n"), compact_kpi("n")).collect()]
    assert got == [("1.2K", "1.2K"), ("1.0M", "1.01M")]
