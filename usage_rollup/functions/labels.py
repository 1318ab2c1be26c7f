"""Display labels as columns.

Compact counts, signed percents and dates are rendered JVM-side with
``when`` + decimal rounding (half-up) + ``format_string``/``date_format``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label tiers, suffixes, decimals and date patterns of the
# original's display formatting.
COUNT_TIERS = ((1_000_000_000, "B", 1), (1_000_000, "M", 1), (1_000, "K", 1))
KPI_TIERS = ((1_000_000, "M", 2), (1_000, "K", 1))
LONG_DATE = "MMM d, yyyy"
SHORT_DATE = "MMM d, yy"
ALL_TIME = "all time"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fixed(x: Column, digits: int) -> Column:
    # round() on a decimal is half-up and keeps exactly `digits` places,
    # which the decimal-to-string cast prints as is
    return F.round(x.cast("decimal(38,6)"), digits).cast("string")


def _grouped(x: Column) -> Column:
    # integer with thousands separators, e.g. 12,345
    return F.format_number(x.cast("bigint"), 0)


def _tiered(x: Column, tiers) -> Column:
    out = _grouped(x)
    for floor, suffix, digits in reversed(tiers):  # build inside-out so the largest tier is tested first
        out = F.when(x >= floor, F.concat(_fixed(x / floor, digits), F.lit(suffix))).otherwise(out)
    return out


def compact_count(n) -> Column:
    """1.2B / 3.4M / 5.6K (one decimal); below 1000 the grouped integer."""
    return _tiered(_c(n), COUNT_TIERS)


def compact_kpi(n) -> Column:
    """KPI style: 1.23M (two decimals), 4.5K (one decimal), no B tier."""
    return _tiered(_c(n), KPI_TIERS)


def signed_percent(p) -> Column:
    """``+12.3%`` / ``-4.0%`` / ``0.0%``; NULL stays NULL."""
    x = _c(p)
    return F.concat(F.when(x > 0, F.lit("+")).otherwise(F.lit("")), _fixed(x, 1), F.lit("%"))


def long_date(d) -> Column:
    """``Nov 30, 2026``."""
    return F.date_format(F.to_date(_c(d)), LONG_DATE)


def short_date(d) -> Column:
    """``Nov 30, 26``."""
    return F.date_format(F.to_date(_c(d)), SHORT_DATE)


def period_label(days) -> Column:
    """``all time`` for 0, else ``last N days``."""
    x = _c(days)
    return F.when(x == 0, F.lit(ALL_TIME)).otherwise(
        F.concat(F.lit("last "), x.cast("string"), F.lit(" days"))
    )


def with_labels(df: DataFrame, count_cols=(), date_cols=(), pct_cols=(), kpi_cols=()) -> DataFrame:
    """Add ``<col>_label`` columns to a report frame (one projection)."""
    extra = {}
    for c in count_cols:
        extra[f"{c}_label"] = compact_count(c)
    for c in kpi_cols:
        extra[f"{c}_label"] = compact_kpi(c)
    for c in pct_cols:
        extra[f"{c}_label"] = signed_percent(c)
    for c in date_cols:
        extra[f"{c}_label"] = short_date(c)
    return df.withColumns(extra) if extra else df
