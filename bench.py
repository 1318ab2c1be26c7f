"""Benchmark: the headline jobs (ingest, rollup, maintenance, reports) at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints ONE JSON line: total wall seconds and per-query seconds. Each query is
a real job (write or collect), timed end to end:

* ``ingest_initial`` / ``ingest_replace``: stage + gate + partitioned write, then
  an idempotent 10-day range replace for one project;
* ``rollup_build``: nested log -> daily rollup, written (full refresh);
* ``rollup_upsert``: keyed incremental load of a 7-day re-run;
* ``export``: year/month partitioned zstd export of the rollup;
* report queries over the materialized rollup, and the whole bundle.

A small warm-up job (not counted) starts the JVM side first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from usage_rollup.operators import maintain  # noqa: E402
from usage_rollup.operators import reports as R  # noqa: E402
from usage_rollup.operators.rollup import daily_rollup  # noqa: E402
from usage_rollup.params import JobParams  # noqa: E402
from usage_rollup.plans.report import collect_reports, run_reports  # noqa: E402
from usage_rollup.session import get_session, scratch_dir  # noqa: E402
from usage_rollup.sources.driverdata import download_log  # noqa: E402
from usage_rollup.sources.scan import scan_log  # noqa: E402

AS_OF = "2024-01-31"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", max(cpus, 8),
                        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        if isinstance(out, int):
            rows[name] = out
        elif isinstance(out, list):
            rows[name] = len(out)
        elif isinstance(out, dict):
            rows[name] = sum(len(v) for v in out.values())
        return out

    # warm-up (not counted)
    spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.count(F.lit(1))).collect()

    log = download_log(spark, sf_dir)
    raw = scratch_dir(spark, "bench-raw")
    timed("ingest_initial", lambda: maintain.replace_range(
        spark, download_log(spark, sf_dir, with_orders=False), raw, "timestamp", "2024-01-01", "2024-02-01"))
    staged = scan_log(spark, download_log(spark, sf_dir, with_orders=False),
                      JobParams(project="alpha", start="2024-01-10", end="2024-01-20"))
    timed("ingest_replace", lambda: maintain.replace_range(
        spark, staged, raw, "timestamp", "2024-01-10", "2024-01-20"))

    rollup_path = scratch_dir(spark, "bench-rollup")
    timed("rollup_build", lambda: maintain.write_rollup(spark, daily_rollup(log), rollup_path, "full"))
    timed("rollup_upsert", lambda: maintain.upsert_by_key(
        spark, rollup_path, daily_rollup(log, "2024-01-20", "2024-01-27")))
    export_path = scratch_dir(spark, "bench-export")
    def export():
        maintain.export_partitioned(spark.read.parquet(rollup_path), "download_date", export_path)
        return spark.read.parquet(export_path).count()

    timed("export", export)

    rollup = spark.read.parquet(rollup_path)
    report_queries = {
        "weekly_series": lambda: R.weekly_series(rollup, AS_OF),
        "monthly_recent": lambda: R.monthly_recent(rollup),
        "last_two_months": lambda: R.last_two_months(rollup),
        "top_versions_30": lambda: R.top_versions(rollup, 30, AS_OF),
        "top_countries": lambda: R.top_countries(rollup, 0, AS_OF),
        "top_breakdowns_30": lambda: R.top_breakdowns(rollup, 30, AS_OF),
        "version_adoption": lambda: R.version_adoption(rollup),
        "adoption_share": lambda: R.adoption_share(
            R.adoption_pivot(R.version_adoption(rollup))),
        "daily_series": lambda: R.daily_series(rollup, 0, AS_OF),
        "kpi_cards": lambda: R.kpi_cards(rollup, AS_OF),
    }
    for name, q in report_queries.items():
        timed(name, lambda q=q: q().collect())

    def bundle():
        # the 13 reports of one request, evaluated concurrently over one stored aggregate
        return collect_reports(run_reports(spark, rollup_path, 30, AS_OF), workers=cpus, release=True)

    timed("report_bundle", bundle)

    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(sf_dir).replace("sf", "")
    try:
        sf = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "end_to_end_wall_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus,
                      "spark": spark.version, "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
