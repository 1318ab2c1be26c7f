"""Write docs/PLANS.md: the physical plans of the headline operators.

Materializes the driver log (nested, partitioned by log_date) and its rollup
(partitioned by download_month) under the shared checkpoint folder, then
records ``explain()`` for each operator over those stored tables.

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from usage_rollup.operators import maintain as M  # noqa: E402
from usage_rollup.operators import reports as R  # noqa: E402
from usage_rollup.operators.rollup import daily_rollup  # noqa: E402
from usage_rollup.params import JobParams  # noqa: E402
from usage_rollup.plans.inspect import plan_text  # noqa: E402
from usage_rollup.plans.transform import prune_log_dates  # noqa: E402
from usage_rollup.session import get_session, scratch_dir  # noqa: E402
from usage_rollup.sources.driverdata import download_log  # noqa: E402
from usage_rollup.sources.scan import read_partitioned, scan_log  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false",
                                              "spark.sql.maxMetadataStringLength": "400"})
    raw, rp, ex = scratch_dir(spark, "plans-raw"), scratch_dir(spark, "plans-rollup"), scratch_dir(spark, "plans-ex")
    (download_log(spark, sf).withColumn("log_date", F.to_date("timestamp"))
     .write.partitionBy("log_date").parquet(raw))
    M.write_rollup(spark, daily_rollup(download_log(spark, sf)), rp)
    M.export_partitioned(spark.read.parquet(rp), "download_date", ex)
    log, rollup = spark.read.parquet(raw), spark.read.parquet(rp)
    batch = M.with_rollup_partition(spark.read.parquet(rp).where(F.col("download_date") >= "2024-01-20"))
    old = rollup.where(F.col("download_month") == F.lit("2024-01-01").cast("date"))
    staged = scan_log(spark, log, JobParams(project="alpha", start="2024-01-10", end="2024-01-20"))
    cases = [
        ("S1-S3 scan_log (project + range pushed)", staged),
        ("A1 daily_rollup over the raw table, date range + partition bounds",
         daily_rollup(prune_log_dates(log, "2024-01-05", "2024-01-25"), "2024-01-05", "2024-01-25")),
        ("A2 quality statistics", staged.agg(F.count(F.lit(1)), F.count("timestamp"), F.min("timestamp"))),
        ("R1 weekly_series (scalar subquery)", R.weekly_series(rollup, "2024-01-31")),
        ("R4 last_two_months (offset)", R.last_two_months(rollup)),
        ("R7 top_versions, 30 days (top-N fusion, month pruning)", R.top_versions(rollup, 30, "2024-01-31")),
        ("R7-R9 top_breakdowns (grouping sets)", R.top_breakdowns(rollup, 30, "2024-01-31")),
        ("T3/T4 adoption_share (pivot with fixed values)",
         R.adoption_share(R.adoption_pivot(R.version_adoption(rollup), ["1.2.0", "1.3.0", "1.4.0"]))),
        ("T5 kpi_cards (two scalar subqueries)", R.kpi_cards(rollup, "2024-01-31")),
        ("W4/W6 scoped survivors (anti-join on staged scope values)",
         M.delete_range_scoped(log.where(F.col("log_date").isin(
             [F.lit(f"2024-01-{d:02d}").cast("date") for d in range(10, 20)])), staged.withColumn(
             "log_date", F.to_date("timestamp")), "timestamp", "2024-01-10", "2024-01-20", "project")),
        ("W8 upsert_frame (anti-join on month + key)", M.upsert_frame(old, batch)),
        ("S5 read_partitioned with pruning", read_partitioned(spark, ex, "1998-03-15", "1999-02-10")),
    ]
    out = ["# Physical plans of the headline operators", "",
           f"Generated by `tools/dump_plans.py` at `{os.path.basename(sf)}` on local[8], Spark {spark.version}, "
           "AQE on (plans shown before runtime re-optimization). Paths shortened.", ""]
    for title, df in cases:
        text = plan_text(df, "simple")
        text = re.sub(r"file:[^\],]*?(usage_rollup/[a-z-]+)-[0-9a-f]{32}", r"\1", text)
        text = re.sub(r"#\d+L?", "", text)
        out += [f"## {title}", "", "```", text.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"),
              "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
