"""usage_rollup: Spark-native analytics over package download logs.

Stages: sources (scan/resolve) -> quality gate -> table maintenance ->
daily rollup -> reports. Everything is DataFrame / Spark SQL; no Python UDFs.
"""

from usage_rollup.params import JobParams, REPORT_PERIODS, safe_period  # noqa: F401
from usage_rollup.schema import (  # noqa: F401
    LOG_COLUMNS,
    LOG_SCHEMA,
    ROLLUP_COLUMNS,
    ROLLUP_DIMENSIONS,
    ROLLUP_SCHEMA,
)
from usage_rollup.session import get_session, scratch_dir  # noqa: F401
