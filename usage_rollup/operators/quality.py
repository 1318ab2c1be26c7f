"""Data-quality gate over staged log rows (one aggregate pass).

``quality_stats`` computes count, non-null counts of the timestamp and key
columns and the timestamp range in a single global aggregate (partial per
task, one row per task shuffled to the final merge). ``check_quality``
raises ``DataQualityError`` before anything touches the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from usage_rollup.params import MAX_NULL_PCT


# Gate messages (kept matchable with the original's wording).
MSG_NO_ROWS = "No rows loaded"
MSG_NULLS = "{pct:.1f}% of {column} values are null (threshold: {limit:g}%)"


class DataQualityError(Exception):
    """Raised when staged rows fail the quality gate."""


def quality_exprs(ts: str = "timestamp", key: str = "project") -> list[Column]:
    """The five statistics as aggregate expressions (also usable in an Observation)."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.col(ts)).alias("non_null_timestamps"),
        F.count(F.col(key)).alias("non_null_keys"),
        F.min(F.col(ts)).alias("min_ts"),
        F.max(F.col(ts)).alias("max_ts"),
    ]


def quality_stats(df: DataFrame, ts: str = "timestamp", key: str = "project") -> DataFrame:
    return df.agg(*quality_exprs(ts, key))


def _null_pct(total: Column, non_null: Column) -> Column:
    return F.when(total > 0, (total - non_null) * 100.0 / total)


def quality_report(df: DataFrame, ts: str = "timestamp", key: str = "project",
                   max_null_pct: float = MAX_NULL_PCT, digits: int | None = None) -> DataFrame:
    """One summary row: the statistics, null rates and whether the gate passes."""
    s = quality_stats(df, ts, key)
    t, nts, nk = F.col("total_rows"), F.col("non_null_timestamps"), F.col("non_null_keys")
    pts, pk = _null_pct(t, nts), _null_pct(t, nk)
    if digits is not None:
        pts, pk = F.round(pts, digits), F.round(pk, digits)
    passed = (t > 0) & (_null_pct(t, nts) <= max_null_pct) & (_null_pct(t, nk) <= max_null_pct)
    return s.select(
        "total_rows", "non_null_timestamps", "non_null_keys", "min_ts", "max_ts",
        pts.alias("null_ts_pct"), pk.alias("null_key_pct"), F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def validate_stats(stats, ts_label: str = "timestamp", key_label: str = "project",
                   max_null_pct: float = MAX_NULL_PCT) -> dict:
    """Apply the gate to already-computed statistics (a Row, dict or tuple).

    Exactly ``max_null_pct`` passes; above it fails. Returns the summary.
    """
    if isinstance(stats, Row):
        stats = stats.asDict()
    if isinstance(stats, dict):
        total = stats["total_rows"]
        nts = stats["non_null_timestamps"]
        nk = stats.get("non_null_keys", stats.get("non_null_projects"))
        min_ts, max_ts = stats.get("min_ts"), stats.get("max_ts")
    else:
        total, nts, nk, min_ts, max_ts = stats
    if not total:
        raise DataQualityError(MSG_NO_ROWS)
    null_ts = (total - nts) * 100 / total
    null_key = (total - nk) * 100 / total
    for pct, column in ((null_ts, ts_label), (null_key, key_label)):
        if pct > max_null_pct:
            raise DataQualityError(MSG_NULLS.format(pct=pct, column=column, limit=max_null_pct))
    return {"total_rows": total, "min_ts": min_ts, "max_ts": max_ts,
            "null_ts_pct": null_ts, "null_key_pct": null_key}


def check_quality(df: DataFrame, ts: str = "timestamp", key: str = "project",
                  max_null_pct: float = MAX_NULL_PCT) -> dict:
    """Run the one-pass statistics job and apply the gate (brings back one row)."""
    row = quality_stats(df, ts, key).first()
    return validate_stats(row, "timestamp", key, max_null_pct)
