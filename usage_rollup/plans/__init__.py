"""End-to-end jobs (ingest, transform, report) and plan inspection helpers."""

from usage_rollup.plans.ingest import run_ingest  # noqa: F401
from usage_rollup.plans.transform import run_transform  # noqa: F401
from usage_rollup.plans.report import collect_reports, run_reports  # noqa: F401
