import datetime as dt
import hashlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import assert_subset_equal, log_row
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.sources.scan import mock_log


def test_golden_two_rows_one_group(spark):
    # two downloads on the same day differing only in the patch level of the runtime
    rows = [
        log_row("2023-04-02 14:49:15", python="3.8.2", sys_name="Linux", sys_release="4.15.0-66-generic",
                cpu="x86_64", file_null=True),
        log_row("2023-04-02 14:49:15", python="3.8.1", sys_name="Linux", sys_release="4.15.0-66-generic",
                cpu="x86_64", file_null=True),
    ]
    for ts_type in (T.TimestampNTZType(), T.TimestampType()):
        out = daily_rollup(mock_log(spark, rows, ts_type), "2023-04-01", "2023-04-03")
        assert out.count() == 1
        assert_subset_equal(
            out,
            [(dt.date(2023, 4, 2), "pkg", "3.8", "x86_64", "Linux", 2)],
            ["download_date", "project", "python_version", "cpu", "system_name", "daily_download_sum"],
        )


def test_sample_rows_duplicates_counted_and_null_dims(spark):
    rows = [
        log_row("2023-04-02 19:44:39", country="FI", version="0.7.1"),
        log_row("2023-04-02 19:44:39", country="FI", version="0.7.1"),
        log_row("2023-04-01 10:29:47", country="US", version="0.7.2.dev1322"),
    ]
    out = daily_rollup(mock_log(spark, rows))
    assert_subset_equal(
        out,
        [(dt.date(2023, 4, 2), "0.7.1", "FI", None, None, None, 2),
         (dt.date(2023, 4, 1), "0.7.2.dev1322", "US", None, None, None, 1)],
        ["download_date", "version", "country_code", "system_name", "cpu", "python_version", "daily_download_sum"],
    )


def test_range_is_half_open_on_date(spark):
    rows = [log_row("2023-03-31 23:59:59"), log_row("2023-04-01 00:00:00"), log_row("2023-04-02 23:59:59"),
            log_row("2023-04-03 00:00:00")]
    out = daily_rollup(mock_log(spark, rows), "2023-04-01", "2023-04-03")
    assert sorted(r.download_date for r in out.collect()) == [dt.date(2023, 4, 1), dt.date(2023, 4, 2)]


def test_python_version_edge_cases(spark):
    rows = [log_row("2023-04-02 01:00:00", python=p) for p in ("3", None, "3.11.4", "3.12")]
    got = {r.python_version for r in daily_rollup(mock_log(spark, rows)).collect()}
    assert got == {"3.", None, "3.11", "3.12"}


def test_load_id_is_md5_of_pipe_joined_non_null_dims(spark):
    rows = [log_row("2023-04-02 01:00:00", version="1.0", python="3.8.2", sys_name="Linux", cpu=None)]
    r = daily_rollup(mock_log(spark, rows)).first()
    expected = hashlib.md5("2023-04-02|Linux|1.0|pkg|US|3.8".encode()).hexdigest()
    assert r.load_id == expected


def test_load_id_collides_when_null_shifts(spark):
    rows = [log_row("2023-04-02 01:00:00", sys_name=None, sys_release="x"),
            log_row("2023-04-02 01:00:00", sys_name="x", sys_release=None)]
    out = daily_rollup(mock_log(spark, rows)).collect()
    assert len(out) == 2 and out[0].load_id == out[1].load_id


def test_null_parent_struct_gives_null_leaves(spark):
    rows = [log_row("2023-04-02 01:00:00", file_null=True)]
    r = daily_rollup(mock_log(spark, rows)).first()
    assert r.version is None and r.system_name is None


def test_rollup_total_equals_row_count_on_driver_data(spark):
    from usage_rollup.sources.driverdata import download_log

    log = download_log(spark, "/root/testdata/sf0.001")
    r = daily_rollup(log)
    assert r.agg(F.sum("daily_download_sum")).first()[0] == log.count()
