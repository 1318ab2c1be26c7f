"""Plan inspection: read what Catalyst chose (for tests and tuning).

``explain`` prints; these helpers capture the text and pick out the parts we
assert on: pushed filters, read schema, shuffle count, top-N fusion.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[(.*?)\]\n", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (.*)\n", plan_text(df))


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[(.*?)\]\n", plan_text(df))


def count_nodes(df: DataFrame, name: str) -> int:
    """Operators named ``name`` in the physical plan tree (subqueries excluded)."""
    text = plan_text(df, "formatted")
    tree = text.split("\n\n", 1)[0]
    return len(re.findall(rf"\b{re.escape(name)}\b", tree))


def shuffle_count(df: DataFrame) -> int:
    return count_nodes(df, "Exchange")
