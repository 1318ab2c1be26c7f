"""Column expressions shared by the operators.

Every function returns a ``pyspark.sql.Column`` built from built-in
functions only, so all of it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from usage_rollup.schema import ROLLUP_DIMENSIONS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound_like(value, dtype) -> Column:
    """A literal bound cast to the compared column's type.

    Comparing a ``timestamp_ntz`` column with a ``timestamp`` literal would
    make Catalyst cast the column instead (and lose the pushed filter); cast
    the literal to the column's own type so the predicate reaches the scan.
    """
    return F.lit(value).cast(dtype)


def half_open(c, start, end, dtype=None) -> Column:
    """``start <= c < end``; NULL stays NULL (and a WHERE drops it)."""
    col = _c(c)
    if dtype is not None:
        return (col >= bound_like(start, dtype)) & (col < bound_like(end, dtype))
    return (col >= F.lit(start)) & (col < F.lit(end))


def day_bucket(ts) -> Column:
    """``timestamp::date``."""
    return F.to_date(_c(ts))


def week_bucket(d) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.trunc(_c(d), "week")


def month_bucket(d) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(_c(d), "month")


def date_label(d) -> Column:
    """``yyyy-MM-dd`` label of a date (series labels are strings)."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def month_label(d) -> Column:
    """``YYYY-MM`` label: year, dash, zero-padded month."""
    return F.date_format(_c(d), "yyyy-MM")


def python_major_minor(v) -> Column:
    """Runtime ``major.minor`` from a full version string.

    NULL stays NULL (``concat`` propagates it); missing parts become empty
    strings, so ``'3'`` gives ``'3.'`` (a split part beyond the end is ``''``).
    """
    c = _c(v)
    dot = F.lit(".")
    return F.concat(F.split_part(c, dot, F.lit(1)), dot, F.split_part(c, dot, F.lit(2)))


def load_id(dims: list[str] | None = None) -> Column:
    """MD5 surrogate key over the rollup dimensions joined by ``|``.

    NULL dimensions are skipped by ``concat_ws`` (so the key is not unique
    in general); the date is rendered ``yyyy-MM-dd``.
    """
    parts = []
    for name in dims or ROLLUP_DIMENSIONS:
        c = F.col(name)
        parts.append(date_label(c) if name == "download_date" else c)
    return F.md5(F.concat_ws("|", *parts))
