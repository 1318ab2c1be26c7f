import pytest

from usage_rollup.params import DEFAULT_END, DEFAULT_START, JobParams, safe_period
from usage_rollup.plans.inspect import pushed_filters
from usage_rollup.schema import LOG_COLUMNS
from usage_rollup.sources.scan import log_predicate


def test_defaults_and_overrides():
    p = JobParams(project="pkg")
    assert (p.start, p.end, p.ts_col) == (DEFAULT_START, DEFAULT_END, "timestamp")
    q = p.with_(start="2021-11-03", end="2021-11-17", ts_col="seen_at")
    assert (q.start, q.ts_col, q.project) == ("2021-11-03", "seen_at", "pkg")
    with pytest.raises(ValueError):
        JobParams(project="")


def test_log_columns():
    assert LOG_COLUMNS == ["timestamp", "country_code", "url", "project", "file", "details", "tls_protocol",
                           "tls_cipher"]


def test_period_whitelist():
    assert [safe_period(x) for x in (0, 7, 30, 90, 5, "30", None, "x")] == [0, 7, 30, 90, 0, 30, 0, 0]


def test_predicate_text(spark):
    p = JobParams(project="wheelhouse", start="2019-08-05", end="2019-08-12 06:30:00")
    s = str(log_predicate(p))
    assert "wheelhouse" in s and "2019-08-05" in s and "2019-08-12 06:30:00" in s


def test_custom_timestamp_column_pushed(spark, scratch):
    path = scratch("custom-ts")
    spark.sql("SELECT TIMESTAMP_NTZ'2021-11-09 05:00:00' AS seen_at, 'pkg' AS project, 'US' AS country_code") \
        .write.parquet(path)
    from usage_rollup.sources.scan import scan_log

    p = JobParams(project="pkg", start="2021-11-03", end="2021-11-17", ts_col="seen_at")
    df = scan_log(spark, path, p, columns=["project", "country_code"])
    assert df.count() == 1 and df.columns[0] == "seen_at"
    pf = " ".join(pushed_filters(df))
    assert "seen_at" in pf and "project" in pf


def test_scan_json_source_with_explicit_schema(spark, scratch):
    from helpers import log_row
    from usage_rollup.sources.scan import mock_log, scan_log

    path = scratch("json-src")
    rows = [log_row("2019-08-06 10:00:00", project="pkg", version="1.0"),
            log_row("2019-08-06 11:00:00", project="other"),
            log_row("2019-09-30 10:00:00", project="pkg")]
    mock_log(spark, rows).write.json(path)
    df = scan_log(spark, path, JobParams(project="pkg", start="2019-08-05", end="2019-08-12"), fmt="json")
    got = df.collect()
    assert len(got) == 1 and got[0].file.version == "1.0" and df.columns == LOG_COLUMNS


def test_billing_project_reaches_connectors_only(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameReader
    from usage_rollup.sources import scan

    seen = {}
    monkeypatch.setattr(DataFrameReader, "load", lambda self, path=None: scan.mock_log(spark, []))
    monkeypatch.setattr(DataFrameReader, "options", lambda self, **kw: seen.update(kw) or self)
    p = JobParams(project="pkg", billing_project="payer")
    scan.scan_log(spark, "some.table", p, fmt="warehouse_connector")
    assert seen == {"parentProject": "payer"}
    seen.clear()
    scan.scan_log(spark, "/x", p, fmt="parquet")
    assert seen == {}
