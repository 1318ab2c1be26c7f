"""Job parameters (ingest + transform) and report-period whitelist."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Trailing-day periods a report request may ask for; any other
# value means "all time" (0).
REPORT_PERIODS = (0, 7, 30, 90)

# Default ingest window and table name. The project to load has
# no default; the database name is ours.
DEFAULT_START = "2019-04-01"
DEFAULT_END = "2023-11-30"
DEFAULT_DATABASE = "download_stats"
DEFAULT_TABLE = "pypi_file_downloads"
DEFAULT_TS_COL = "timestamp"
# Rows per written file: 0 leaves file sizes to Spark.
NO_LIMIT = 0
DEFAULT_EXPORT_ROWS = 1_000_000
MAX_NULL_PCT = 5.0


@dataclass(frozen=True)
class JobParams:
    """Parameters of one ingest run: which project, which half-open range."""

    project: str
    start: str = DEFAULT_START
    end: str = DEFAULT_END
    database: str = DEFAULT_DATABASE
    table: str = DEFAULT_TABLE
    ts_col: str = DEFAULT_TS_COL
    billing_project: str | None = None

    def with_(self, **kw) -> "JobParams":
        return replace(self, **kw)

    def __post_init__(self):
        for name in ("project", "start", "end", "ts_col", "table", "database"):
            if not isinstance(getattr(self, name), str) or not getattr(self, name):
                raise ValueError(f"JobParams.{name} must be a non-empty string")


def safe_period(days) -> int:
    """Whitelist a trailing-days request: {0, 7, 30, 90}, anything else -> 0."""
    try:
        d = int(days)
    except (TypeError, ValueError):
        return 0
    return d if d in REPORT_PERIODS else 0
