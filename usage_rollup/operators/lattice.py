"""Pre-aggregated daily rollups by fewer dimensions, and the choice among them.

A report needs the date, the project and at most one further dimension. The
lattice keeps one versioned table for each such set of columns: the rollup summed over
all others. Their rows look like the rollup's (date, dimension, downloads), so
every report runs on them unchanged; ``choose`` hands out the smallest table that
holds the columns a report names.

The tables are maintained from a versioned rollup. Each records the rollup's version it was
made from, so an update compares two manifests and recomputes just the
partitions that changed between them (an upsert of a few days touches one or two months).
The order of dimensions is their cost: fewer columns first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usage_rollup.operators import reports as R
from usage_rollup.operators import versions
from usage_rollup.operators.maintain import ROLLUP_DATE
from usage_rollup.operators.versions import VersionedTable
from usage_rollup.params import safe_period

N = "daily_download_sum"
#: Name and further dimensions of each level, smallest first.
LEVELS = {"plain": (), "runtime": ("python_version",), "country": ("country_code",), "version": ("version",)}
#: The columns that each report of a bundle reads besides date and project.
REPORT_COLUMNS = {"top_versions": ("version",), "top_runtimes": ("python_version",), "top_countries": ("country_code",),
                  "version_adoption": ("version",)}
_FACT = "rollup_version"


class StaleLatticeError(RuntimeError):
    """A level was made from another version of the rollup."""


class Lattice:
    """The levels of one versioned rollup, under one root."""

    def __init__(self, spark: SparkSession, root: str, rollup: VersionedTable, levels: dict | None = None):
        self.rollup = rollup
        self.levels = dict(levels or LEVELS)
        self.tables = {name: VersionedTable(spark, f"{root.rstrip('/')}/{name}", rollup.partition_col) for name in self.levels}

    def _columns(self, name: str) -> list[str]:
        part = [] if self.rollup.partition_col == ROLLUP_DATE else [self.rollup.partition_col]
        return [ROLLUP_DATE, "project", *self.levels[name], *part]

    def built_from(self, name: str) -> int:
        """Version of the rollup that a level was made from (0: not made yet)."""
        return int(self.tables[name].manifest().facts.get(_FACT, 0))

    def update(self) -> dict[str, list[str]]:
        """Bring every level to the rollup's newest version; returns the partitions recomputed by level.

        Reads only the partitions that changed, once for all levels that start from the same version.
        """
        now = self.rollup.manifest()
        out = {}
        for name, table in self.tables.items():
            since = self.built_from(name)
            if since == now.version:
                out[name] = []
                continue
            known = since in self.rollup.versions()
            # a level of a version that was dropped since is made anew
            changed = versions.changed_partitions(self.rollup, since, now.version) if known else sorted(now.parts)
            part = {v: now.parts[v] for v in changed if v in now.parts}
            rows = self.rollup._read(now.schema, part).drop("gen")
            keys = self._columns(name)
            summed = rows.groupBy(*keys).agg(F.sum(N).cast("bigint").alias(N))
            versions.replace_partitions(table, summed, changed if known else None, {_FACT: now.version}, operation=f"rollup {now.version}")
            out[name] = changed
        return out

    def choose(self, columns=()) -> DataFrame:
        """The smallest level that holds date, project and ``columns``; the rollup itself if none does.

        Raises ``StaleLatticeError`` if that level is behind the rollup.
        """
        for name, dims in self.levels.items():
            if set(columns) <= {ROLLUP_DATE, "project", self.rollup.partition_col, *dims}:
                if self.built_from(name) != self.rollup.current():
                    raise StaleLatticeError(f"level {name} is of rollup version {self.built_from(name)}, not {self.rollup.current()}")
                return self.tables[name].read()
        return self.rollup.read()


def lattice_bundle(lattice: Lattice, days: int = 0, as_of=None, project: str | None = None) -> dict[str, DataFrame]:
    """The frames of ``reports.report_bundle``, each from the smallest level that answers it."""
    days = safe_period(days)

    def source(name: str) -> DataFrame:
        df = lattice.choose(REPORT_COLUMNS.get(name, ()))
        return df if project is None else df.where(F.col("project") == F.lit(project))

    reports = {
        "weekly_series": lambda r: R.weekly_series(r, as_of),
        "last_two_weeks": lambda r: R.last_two_weeks(r, as_of),
        "monthly_recent": R.monthly_recent,
        "last_two_months": R.last_two_months,
        "total_downloads": R.total_downloads,
        "refresh_date": R.refresh_date,
        "top_versions": lambda r: R.top_versions(r, days, as_of),
        "top_runtimes": lambda r: R.top_runtimes(r, days, as_of),
        "top_countries": lambda r: R.top_countries(r, days, as_of),
        "version_adoption": R.version_adoption,
        "daily_series": lambda r: R.daily_series(r, days, as_of),
        "kpi_cards": lambda r: R.kpi_cards(r, as_of),
    }
    return {"period": R.period_echo(lattice.rollup.spark, days)} | {name: f(source(name)) for name, f in reports.items()}
