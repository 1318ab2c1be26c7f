import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import log_row
from usage_rollup.operators import maintain
from usage_rollup.operators.quality import DataQualityError
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.sources import storage
from usage_rollup.sources.driverdata import flat_log
from usage_rollup.sources.scan import mock_log, read_partitioned

ROWS = [
    log_row("2023-01-01 10:00:00", project="a"),
    log_row("2023-01-02 10:00:00", project="a"),
    log_row("2023-01-02 11:00:00", project="b"),
    log_row("2023-01-03 10:00:00", project="a"),
    log_row("2023-01-04 10:00:00", project="b"),
]


def _rows(spark, path):
    return sorted((str(r.timestamp), r.project) for r in flat_log(spark.read.parquet(path)).collect())


def _load(spark, target, rows, start, end, scope=None):
    return maintain.replace_range(spark, mock_log(spark, rows), target, "timestamp", start, end, scope=scope)


def test_replace_twice_equals_once(spark, scratch):
    t = scratch("rr")
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    new = [log_row("2023-01-02 12:00:00", project="a")]
    _load(spark, t, new, "2023-01-02", "2023-01-03")
    once = _rows(spark, t)
    _load(spark, t, new, "2023-01-02", "2023-01-03")
    assert _rows(spark, t) == once
    # default scope deletes every project's rows in the range (b on 01-02 is gone)
    assert once == [("2023-01-01 10:00:00", "a"), ("2023-01-02 12:00:00", "a"), ("2023-01-03 10:00:00", "a"),
                    ("2023-01-04 10:00:00", "b")]


def test_date_without_new_rows_loses_old_rows(spark, scratch):
    t = scratch("rr")
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    _load(spark, t, [log_row("2023-01-02 09:00:00", project="a")], "2023-01-02", "2023-01-04")
    got = _rows(spark, t)
    assert ("2023-01-03 10:00:00", "a") not in got
    assert "log_date=2023-01-03" not in " ".join(storage.list_partitions(spark, t, "log_date"))
    assert storage.list_partitions(spark, t, "log_date") == ["2023-01-01", "2023-01-02", "2023-01-04"]


def test_scope_keeps_other_projects(spark, scratch):
    t = scratch("rr")
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    _load(spark, t, [log_row("2023-01-02 12:00:00", project="a")], "2023-01-02", "2023-01-03", scope="project")
    got = _rows(spark, t)
    assert ("2023-01-02 11:00:00", "b") in got and ("2023-01-02 10:00:00", "a") not in got


def test_mid_day_end_keeps_rest_of_boundary_day(spark, scratch):
    t = scratch("rr")
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    _load(spark, t, [log_row("2023-01-01 09:00:00", project="a")], "2023-01-01", "2023-01-02 10:30:00")
    got = _rows(spark, t)
    assert ("2023-01-02 11:00:00", "b") in got and ("2023-01-02 10:00:00", "a") not in got
    assert ("2023-01-01 10:00:00", "a") not in got


def test_empty_staged_leaves_target_untouched(spark, scratch):
    t = scratch("rr")
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    before = _rows(spark, t)
    assert _load(spark, t, [], "2023-01-01", "2023-01-05") == 0
    assert _rows(spark, t) == before


def test_quality_failure_leaves_target_untouched(spark, scratch):
    t = scratch("rr")
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    before = _rows(spark, t)
    bad = [log_row("2023-01-02 12:00:00", project=None)] * 3 + [log_row("2023-01-02 12:00:00", project="a")]
    with pytest.raises(DataQualityError):
        _load(spark, t, bad, "2023-01-02", "2023-01-03")
    assert _rows(spark, t) == before


def test_delete_range_table_and_missing_target(spark, scratch):
    t = scratch("rr")
    maintain.delete_range_table(spark, t, "timestamp", "2023-01-01", "2023-01-02")  # missing: skipped
    assert not storage.exists(spark, t)
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    maintain.delete_range_table(spark, t, "timestamp", "2023-01-02", "2023-01-04")
    assert [p for _, p in _rows(spark, t)] == ["a", "b"]


def _rollup_rows(rows):
    return sorted((r.load_id, r.daily_download_sum) for r in rows)


def test_upsert_replaces_overlapping_keys(spark, scratch):
    t = scratch("up")
    first = [log_row("2023-01-01 10:00:00")] * 2 + [log_row("2023-01-02 10:00:00")]
    second = [log_row("2023-01-02 10:00:00")] * 5 + [log_row("2023-01-03 10:00:00")]
    maintain.upsert_by_key(spark, t, daily_rollup(mock_log(spark, first)))
    maintain.upsert_by_key(spark, t, daily_rollup(mock_log(spark, second)))
    got = {r.download_date: r.daily_download_sum for r in spark.read.parquet(t).collect()}
    assert got == {dt.date(2023, 1, 1): 2, dt.date(2023, 1, 2): 5, dt.date(2023, 1, 3): 1}
    # twice = once
    maintain.upsert_by_key(spark, t, daily_rollup(mock_log(spark, second)))
    again = {r.download_date: r.daily_download_sum for r in spark.read.parquet(t).collect()}
    assert again == got


def test_upsert_keeps_colliding_keys_in_batch(spark, scratch):
    t = scratch("up")
    rows = [log_row("2023-01-02 01:00:00", sys_name=None, sys_release="x"),
            log_row("2023-01-02 01:00:00", sys_name="x", sys_release=None)]
    maintain.upsert_by_key(spark, t, daily_rollup(mock_log(spark, rows)))
    maintain.upsert_by_key(spark, t, daily_rollup(mock_log(spark, rows)))
    assert spark.read.parquet(t).count() == 2


def test_append_chunks_files(spark, scratch):
    t = scratch("ap")
    df = spark.range(1000).coalesce(1)
    assert maintain.append(df, t, max_records=100) == 1000
    assert storage.count_files(spark, t) == 10
    assert spark.read.parquet(t).count() == 1000


def test_ensure_target_creates_empty(spark, scratch):
    t = scratch("et")
    df = spark.range(5).withColumn("d", F.lit("2023-01-01"))
    assert maintain.ensure_target(spark, df, t) is True
    assert maintain.ensure_target(spark, df, t) is False
    assert spark.read.parquet(t).count() == 0


def test_catalog_database_and_table(spark):
    maintain.ensure_database(spark, "usage_stats_test")
    name = "usage_stats_test.raw_t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.range(3)
    assert maintain.ensure_target(spark, df, name) is True
    assert maintain.append(df, name) == 3
    assert spark.table(name).count() == 3 and maintain.target_exists(spark, name)


def test_export_partitions_and_pruning(spark, scratch):
    p = scratch("ex")
    rows = [log_row(ts) for ts in ("2023-01-31 10:00:00", "2023-02-01 10:00:00", "2023-02-15 10:00:00",
                                   "2023-03-01 10:00:00")]
    maintain.export_partitioned(daily_rollup(mock_log(spark, rows)), "download_date", p)
    assert sorted(storage.list_partitions(spark, p, "year")) == ["2023"]
    back = read_partitioned(spark, p)
    assert back.count() == 4 and set(back.columns) >= {"year", "month"}
    assert dict(back.dtypes)["month"] == "int"
    feb = read_partitioned(spark, p, "2023-02-01", "2023-03-01")
    assert feb.count() == 2
    # rewriting one month keeps the others
    maintain.export_partitioned(daily_rollup(mock_log(spark, rows[1:2])), "download_date", p)
    assert read_partitioned(spark, p).count() == 3


def test_interrupted_publish_is_completed_by_next_run(spark, scratch, monkeypatch):
    t = scratch("rr")
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    real_swap = maintain._swap_in

    def crash_mid_swap(spark_, new_path, target, partition_col, touched, max_records, schema):
        # the driver dies after removing one touched partition and before writing any
        storage.delete_partition(spark_, target, partition_col, touched[0])
        raise RuntimeError("driver lost")

    monkeypatch.setattr(maintain, "_swap_in", crash_mid_swap)
    with pytest.raises(RuntimeError):
        _load(spark, t, [log_row("2023-01-02 12:00:00", project="a")], "2023-01-02", "2023-01-04")
    monkeypatch.setattr(maintain, "_swap_in", real_swap)
    assert maintain.finish_pending(spark, t, "log_date") is True
    assert _rows(spark, t) == [("2023-01-01 10:00:00", "a"), ("2023-01-02 12:00:00", "a"),
                               ("2023-01-04 10:00:00", "b")]
    assert maintain.finish_pending(spark, t, "log_date") is False


def test_day_grain_rollup_upsert(spark, scratch):
    t = scratch("up-day")
    first = [log_row("2023-01-01 10:00:00")] * 2 + [log_row("2023-01-02 10:00:00")]
    second = [log_row("2023-01-02 10:00:00")] * 5 + [log_row("2023-02-03 10:00:00")]
    maintain.write_rollup(spark, daily_rollup(mock_log(spark, first)), t, "incremental", grain="day")
    maintain.write_rollup(spark, daily_rollup(mock_log(spark, second)), t, "incremental", grain="day")
    back = spark.read.parquet(t)
    assert "download_month" not in back.columns
    assert storage.list_partitions(spark, t, "download_date") == ["2023-01-01", "2023-01-02", "2023-02-03"]
    got = {r.download_date: r.daily_download_sum for r in back.collect()}
    assert got == {dt.date(2023, 1, 1): 2, dt.date(2023, 1, 2): 5, dt.date(2023, 2, 3): 1}
    with pytest.raises(ValueError):
        maintain.write_rollup(spark, daily_rollup(mock_log(spark, first)), t, "full", grain="week")


def test_range_dates_follow_the_session_zone():
    from usage_rollup.functions.dates import range_dates

    assert range_dates("2023-04-02 01:00:00+02", "2023-04-03") == ["2023-04-01", "2023-04-02"]
    assert range_dates("2023-04-02 01:00:00+02", "2023-04-03", "Europe/Berlin") == ["2023-04-02"]
    assert range_dates("2023-01-01", "2023-01-03") == ["2023-01-01", "2023-01-02"]
    assert range_dates("2023-01-01", "2023-01-03 10:30:00") == ["2023-01-01", "2023-01-02", "2023-01-03"]


def test_replace_is_idempotent_with_zoned_timestamps_in_another_session_zone(spark, scratch):
    # TIMESTAMP (with zone) rows, a session zone that is not UTC: partitions, bounds and
    # the delete must agree, so re-loading a range's own rows changes nothing
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        t = scratch("rr-tz")
        rows = [log_row(dt.datetime(2023, 1, 1) + dt.timedelta(hours=5 * i), project="a") for i in range(20)]
        log = mock_log(spark, rows)
        maintain.replace_range(spark, log, t, "timestamp", "2022-12-31", "2023-01-06")
        before = sorted(r.timestamp for r in spark.read.parquet(t).collect())
        again = log.where(maintain.range_condition(log, "timestamp", "2023-01-02", "2023-01-03 06:00:00"))
        assert again.count() > 0
        maintain.replace_range(spark, again, t, "timestamp", "2023-01-02", "2023-01-03 06:00:00")
        after = sorted(r.timestamp for r in spark.read.parquet(t).collect())
        assert after == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_catalog_table_targets(spark):
    maintain.ensure_database(spark, "usage_maint_test")
    raw, rollup = "usage_maint_test.raw_log", "usage_maint_test.daily_stats"
    for t in (raw, rollup):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    maintain.replace_range(spark, mock_log(spark, ROWS), raw, "timestamp", "2023-01-01", "2023-01-05")
    assert spark.table(raw).count() == len(ROWS)
    maintain.replace_range(spark, mock_log(spark, [log_row("2023-01-02 09:00:00", project="a")]), raw,
                           "timestamp", "2023-01-02", "2023-01-04")
    got = sorted((str(r.timestamp), r.project) for r in flat_log(spark.table(raw)).collect())
    assert got == [("2023-01-01 10:00:00", "a"), ("2023-01-02 09:00:00", "a"), ("2023-01-04 10:00:00", "b")]
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {raw}").collect()]
    assert parts == ["log_date=2023-01-01", "log_date=2023-01-02", "log_date=2023-01-04"]

    first = [log_row("2023-01-01 10:00:00")] * 2
    second = [log_row("2023-01-01 10:00:00")] * 3 + [log_row("2023-02-01 10:00:00")]
    maintain.write_rollup(spark, daily_rollup(mock_log(spark, first)), rollup, "incremental")
    maintain.write_rollup(spark, daily_rollup(mock_log(spark, second)), rollup, "incremental")
    got = {r.download_date: r.daily_download_sum for r in spark.table(rollup).collect()}
    assert got == {dt.date(2023, 1, 1): 3, dt.date(2023, 2, 1): 1}
    maintain.write_rollup(spark, daily_rollup(mock_log(spark, first)), rollup, "full")
    assert {r.daily_download_sum for r in spark.table(rollup).collect()} == {2}


def test_replace_without_clustering_the_staged_rows(spark, scratch):
    t = scratch("rr-nc")
    maintain.replace_range(spark, mock_log(spark, ROWS), t, "timestamp", "2023-01-01", "2023-01-05",
                           cluster_staged=False)
    maintain.replace_range(spark, mock_log(spark, [log_row("2023-01-02 12:00:00", project="a")]), t,
                           "timestamp", "2023-01-02", "2023-01-03", cluster_staged=False)
    assert [p for _, p in _rows(spark, t)] == ["a", "a", "a", "b"]


def test_truncated_manifest_counts_as_incomplete(spark, scratch):
    from usage_rollup.operators import maintain
    from usage_rollup.sources import storage

    target = scratch("cut")
    spark.range(3).write.parquet(target)
    pend = maintain._pending_dir(spark, target)
    spark.range(1).write.parquet(f"{pend}/new")
    storage.write_text(spark, f"{pend}/manifest.json", '{"touched": [')
    assert maintain.finish_pending(spark, target, "id") is False
    assert not storage.exists(spark, pend)


def test_pending_folder_does_not_depend_on_the_spelling(spark):
    from usage_rollup.operators.maintain import _pending_dir

    assert len({_pending_dir(spark, p) for p in ("/tmp/x-table", "file:/tmp/x-table", "file:///tmp/x-table/")}) == 1


def test_full_refresh_discards_a_pending_snapshot(spark, scratch):
    from usage_rollup.operators import maintain
    from usage_rollup.operators.rollup import daily_rollup
    from usage_rollup.sources import storage
    from usage_rollup.sources.driverdata import download_log

    rollup = daily_rollup(download_log(spark, "/root/testdata/sf0.001", False))
    target = scratch("refresh")
    maintain.write_rollup(spark, rollup, target)
    pend = maintain._pending_dir(spark, target)
    old = maintain.with_rollup_partition(rollup.limit(1), "download_month")
    old.write.partitionBy("download_month").parquet(f"{pend}/new")
    storage.write_text(spark, f"{pend}/manifest.json",
                       '{"partition_col": "download_month", "touched": ["2024-01-01"], "schema": ' + old.schema.json() + "}")
    n = maintain.write_rollup(spark, rollup, target)
    maintain.write_rollup(spark, rollup.limit(0), target, mode="incremental")
    assert spark.read.parquet(target).count() == n


def _nulled(rows):
    return [(None, *r[1:]) for r in rows]


def test_null_timestamps_load_twice_and_stored_ones_stay(spark, scratch):
    t = scratch("rr-null")
    rows = [log_row(f"2023-01-0{1 + i % 4} 10:00:00", project="a") for i in range(30)] + _nulled(ROWS[:1])
    for _ in range(2):
        _load(spark, t, rows, "2023-01-01", "2023-01-05")
    back = spark.read.parquet(t)
    assert back.where("timestamp IS NULL").count() == 2 and back.where("timestamp IS NOT NULL").count() == 30
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    assert spark.read.parquet(t).where("timestamp IS NULL").count() == 2


def test_upsert_with_null_dates_twice_equals_once(spark, scratch):
    t = scratch("up-null")
    batch = daily_rollup(mock_log(spark, ROWS + _nulled(ROWS[:2])))
    for _ in range(2):
        assert maintain.upsert_by_key(spark, t, batch) == batch.count()
    assert _rollup_rows(spark.read.parquet(t).collect()) == _rollup_rows(batch.collect())


def test_only_null_dates_then_dates(spark, scratch):
    t = scratch("up-only-null")
    maintain.upsert_by_key(spark, t, daily_rollup(mock_log(spark, _nulled(ROWS[:1]))))
    maintain.upsert_by_key(spark, t, daily_rollup(mock_log(spark, ROWS)))
    assert spark.read.parquet(t).count() == 1 + daily_rollup(mock_log(spark, ROWS)).count()


def test_emptied_target_and_created_target_can_be_loaded(spark, scratch):
    t, created = scratch("rr-empty"), scratch("rr-created")
    _load(spark, t, ROWS, "2023-01-01", "2023-01-05")
    maintain.delete_range_table(spark, t, "timestamp", "2023-01-01", "2023-01-05")
    assert not maintain.target_exists(spark, t)
    maintain.delete_range_table(spark, t, "timestamp", "2023-01-01", "2023-01-05")
    frame = mock_log(spark, ROWS).withColumn("log_date", F.to_date("timestamp"))
    assert maintain.ensure_target(spark, frame, created, ["log_date"]) is True
    assert maintain.ensure_target(spark, frame, created, ["log_date"]) is False
    for path in (t, created):
        _load(spark, path, ROWS, "2023-01-01", "2023-01-05")
        _load(spark, path, ROWS, "2023-01-01", "2023-01-05")
        assert len(_rows(spark, path)) == len(ROWS)


def test_replace_needs_both_bounds(spark, scratch):
    with pytest.raises(ValueError):
        maintain.replace_range(spark, mock_log(spark, ROWS), scratch("rr-bounds"), "timestamp")


def test_month_grain_replace_and_delete(spark, scratch):
    t = scratch("rr-month")
    kw = {"partition_col": "log_month", "grain": "month"}
    rows = ROWS + [log_row("2023-02-03 10:00:00", project="a")]
    maintain.replace_range(spark, mock_log(spark, rows), t, "timestamp", "2023-01-01", "2023-03-01", **kw)
    maintain.replace_range(spark, mock_log(spark, ROWS[:1]), t, "timestamp", "2023-01-01", "2023-01-04", **kw)
    assert [ts for ts, _ in _rows(spark, t)] == ["2023-01-01 10:00:00", "2023-01-04 10:00:00", "2023-02-03 10:00:00"]
    maintain.delete_range_table(spark, t, "timestamp", "2023-01-31", "2023-02-04", **kw)
    assert storage.list_partitions(spark, t, "log_month") == ["2023-01-01"]


def test_full_refresh_that_dies_in_the_swap_is_completed(spark, scratch, monkeypatch):
    t = scratch("refresh-crash")
    old, new = daily_rollup(mock_log(spark, ROWS)), daily_rollup(mock_log(spark, [log_row("2023-02-01 10:00:00")]))
    maintain.write_rollup(spark, old, t)

    def lost(spark_, new_path, target, partition_col, touched, *rest):
        storage.delete_partition(spark_, target, partition_col, touched[0])
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(maintain, "_swap_in", lost)
        with pytest.raises(RuntimeError):
            maintain.write_rollup(spark, new, t)
    maintain.upsert_by_key(spark, t, new.limit(0))  # any later call finishes the refresh first
    assert _rollup_rows(spark.read.parquet(t).collect()) == _rollup_rows(new.collect())


def test_append_after_a_dead_upsert_loses_nothing(spark, scratch, monkeypatch):
    t = scratch("append-crash")
    first, batch = (daily_rollup(mock_log(spark, r)) for r in (ROWS[:2], ROWS[2:]))
    maintain.write_rollup(spark, first, t)
    with monkeypatch.context() as m:
        m.setattr(maintain, "_swap_in", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            maintain.upsert_by_key(spark, t, batch)
    extra = maintain.with_rollup_partition(daily_rollup(mock_log(spark, [log_row("2023-01-09 10:00:00")])))
    assert maintain.append(extra, t, partition_by=["download_month"]) == 1
    maintain.upsert_by_key(spark, t, batch)
    assert spark.read.parquet(t).count() == first.count() + batch.count() + 1
