"""The bundle from one scan, the pre-aggregated levels, and the map-valued pivot."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from usage_rollup.operators import bundle, lattice, versions
from usage_rollup.operators import reports as R
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.plans.inspect import count_nodes
from usage_rollup.sources import storage
from usage_rollup.sources.driverdata import download_log

SF = "/root/testdata/sf0.001"
AS_OF = "2024-01-31"
SCHEMA = "download_date date, project string, version string, python_version string, country_code string, daily_download_sum bigint"


@pytest.fixture(scope="module")
def rollup(spark):
    return daily_rollup(download_log(spark, SF)).persist()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("days", [0, 30])
def test_shared_bundle_equals_the_separate_reports(rollup, days):
    want, got = R.report_bundle(rollup, days, AS_OF), bundle.SharedBundle(rollup, days, AS_OF)
    assert list(got) == list(want) and len(got) == 13
    for name in want:
        assert rows(got[name]) == rows(want[name]), name
    got.release()


def test_edges(spark):
    day = dt.date(2024, 1, 8)
    odd = [(None, "a", None, None, None, 2), (day, "a", None, "3.8", None, 3), (day, "b", "1.3.0", None, "US", 5)]
    for data in (odd, []):
        df = spark.createDataFrame(data, SCHEMA)
        for days in (0, 7):
            want, got = R.report_bundle(df, days, "2024-01-12"), bundle.SharedBundle(df, days, "2024-01-12")
            for name in want:
                assert rows(got[name]) == rows(want[name]), (name, days, len(data))
    only = bundle.SharedBundle(spark.createDataFrame(odd, SCHEMA), 0, "2024-01-12", project="b")
    assert only["total_downloads"].first()[0] == 5


def test_one_scan_and_one_shuffle(spark, scratch, rollup):
    path = scratch("bundle-rollup")
    rollup.write.parquet(path)
    plan = bundle.shared_aggregate(spark.read.parquet(path).where("project = 'gamma'"), 30, AS_OF)
    # the union's two branches share one aggregate at run time
    assert count_nodes(plan, "Scan parquet") <= 2
    b = bundle.SharedBundle(spark.read.parquet(path), 30, AS_OF)
    for name, frame in b.items():
        assert path.split("/")[-1] not in " ".join(frame.inputFiles()), name


def test_write_reports_collects_only_short_frames(spark, scratch, rollup):
    out = scratch("reports")
    summary = bundle.write_reports(bundle.SharedBundle(rollup, 30, AS_OF), out)
    assert not set(summary) & set(bundle.LONG_FRAMES) and len(summary) == 10
    assert json.loads(storage.read_text(spark, f"{out}/summary.json"))["top_versions"] == summary["top_versions"]
    assert spark.read.json(f"{out}/daily_series").count() == R.daily_series(rollup, 30, AS_OF).count()


def test_lattice_equals_the_rollup_and_reads_the_small_tables(spark, scratch, rollup):
    table = versions.rollup_table(spark, scratch("lat-rollup"))
    levels = lattice.Lattice(spark, scratch("lat"), table)
    early = rollup.where("download_date < '2024-01-20'")
    versions.write_rollup(table, early)
    levels.update()
    versions.write_rollup(table, rollup.where("download_date >= '2024-01-18'"), "incremental")
    with pytest.raises(lattice.StaleLatticeError):
        levels.choose()
    changed = levels.update()
    assert set(map(tuple, changed.values())) == {("2024-01-01",)}  # the month of the upsert alone
    assert set(map(tuple, levels.update().values())) == {()}
    want, got = R.report_bundle(rollup, 30, AS_OF), lattice.lattice_bundle(levels, 30, AS_OF)
    for name in want:
        assert rows(got[name]) == rows(want[name]), name
        if name != "period":
            read = " ".join(got[name].inputFiles())
            folder = lambda path: path.split("/")[-1]
            assert folder(table.root) not in read and folder(levels.tables["plain"].root[:-len("/plain")]) in read, name
    assert "country_code" in levels.choose(["country_code"]).columns
    assert levels.choose(["cpu"]).count() == table.read().count()  # no level has it: the rollup
    one = lattice.lattice_bundle(levels, 0, AS_OF, project="gamma")["total_downloads"].first()[0]
    assert one == rollup.where("project = 'gamma'").agg(F.sum("daily_download_sum")).first()[0]


def test_lattice_is_made_anew_after_its_version_was_dropped(spark, scratch, rollup):
    table = versions.rollup_table(spark, scratch("lat-rollup"))
    levels = lattice.Lattice(spark, scratch("lat"), table, {"plain": ()})
    small = rollup.where("project <> 'gamma'")
    versions.write_rollup(table, small)
    levels.update()
    for _ in range(2):
        versions.write_rollup(table, small.where("country_code = 'US'"))
    table.vacuum(keep=1)
    levels.update()
    assert levels.choose().agg(F.sum("daily_download_sum")).first() == small.where("country_code = 'US'").agg(F.sum("daily_download_sum")).first()


def test_map_pivot(spark):
    data = [("2024-01-01", "1.2.0", 1), ("2024-01-01", "1.3.0", 2), ("2024-01-01", "1.3.0", 1), ("2024-01-02", "1.3.0", 0),
            ("2024-01-02", None, 4)]
    adoption = spark.createDataFrame(data, "download_date string, version string, downloads bigint")
    pivot = R.adoption_map(adoption)
    assert count_nodes(pivot, "Exchange") == 1
    assert {r.download_date: r.downloads for r in pivot.collect()} == {"2024-01-01": {"1.2.0": 1, "1.3.0": 3}, "2024-01-02": {"1.3.0": 0}}
    share = {r.download_date: r.share_pct for r in R.adoption_share_map(pivot).collect()}
    assert share == {"2024-01-01": {"1.2.0": 25.0, "1.3.0": 75.0}, "2024-01-02": {"1.3.0": 0.0}}


def test_wide_pivot_is_not_bound_by_the_pivot_limit(spark):
    before = spark.conf.get("spark.sql.pivotMaxValues")
    data = [("2024-01-01", f"1.2.{i}", i) for i in range(30)]
    adoption = spark.createDataFrame(data, "download_date string, version string, downloads bigint")
    try:
        spark.conf.set("spark.sql.pivotMaxValues", "10")
        wide = R.adoption_pivot(adoption)
        assert len(wide.columns) == 31 and wide.first()["v1_2_29"] == 29
        blocks = R.adoption_pivot_blocks(adoption, 12)
        assert [len(b.columns) - 1 for b in blocks] == [12, 12, 6]
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)


def test_shares_are_not_rounded_by_default(spark):
    adoption = spark.createDataFrame([("d", "1.2.0", 1), ("d", "1.3.0", 2)], "download_date string, version string, downloads bigint")
    assert R.adoption_share_long(adoption).where("version = '1.2.0'").first().share_pct == pytest.approx(100 / 3, rel=1e-15)
    assert R.adoption_share(R.adoption_pivot(adoption), 2).first()["v1_2_0"] == 33.33
