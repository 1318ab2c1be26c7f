import pytest

from helpers import log_row
from usage_rollup.operators.quality import DataQualityError, check_quality, quality_report
from usage_rollup.sources.scan import mock_log


@pytest.mark.parametrize("total, stamps, keys, message", [
    (40, 40, 40, None),
    (40, 38, 38, None),  # exactly 5 %
    (40, 37, 40, "timestamp values are null"),
    (40, 40, 31, "project values are null"),
    (0, 0, 0, "No rows loaded"),
])
def test_gate(spark, total, stamps, keys, message):
    rows = spark.range(total).selectExpr(
        f"if(id < {stamps}, timestamp'2022-05-06 07:08:09', null) as timestamp", f"if(id < {keys}, 'alpha', null) as project")
    if message:
        with pytest.raises(DataQualityError, match=message):
            check_quality(rows)
    else:
        assert check_quality(rows)["total_rows"] == total


def test_quality_report_and_check_on_frame(spark):
    rows = [log_row("2023-04-02 01:00:00") for _ in range(18)] + [log_row("2023-04-02 01:00:00", project=None)] * 2
    df = mock_log(spark, rows)
    r = quality_report(df).first()
    assert (r.total_rows, r.non_null_timestamps, r.non_null_keys) == (20, 20, 18)
    assert r.null_key_pct == pytest.approx(10.0) and r.passed is False
    with pytest.raises(DataQualityError, match="10.0% of project values are null"):
        check_quality(df)


def test_quality_report_empty_frame(spark):
    df = mock_log(spark, [])
    r = quality_report(df).first()
    assert r.total_rows == 0 and r.passed is False and r.null_ts_pct is None
