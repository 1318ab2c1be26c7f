"""Command line for spark-submit: ingest, transform, report.

    spark-submit usage_rollup/cli.py ingest --source s3a://.../raw --target s3a://.../log \\
        --project my-package --start 2024-01-01 --end 2024-01-02
    spark-submit usage_rollup/cli.py transform --root s3a://.../log --target s3a://.../rollup \\
        --start 2024-01-01 --end 2024-01-02 --mode incremental
    spark-submit usage_rollup/cli.py report --rollup s3a://.../rollup --days 30

``report`` prints one JSON object (report name -> rows). With ``--output-path`` the long series are written
by the executors instead, and only the short reports are printed. ``--versioned`` keeps a table's older versions
(see ``operators.versions``) and takes its root folder as the target or source.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from usage_rollup.operators import versions  # noqa: E402
from usage_rollup.operators.bundle import write_reports  # noqa: E402
from usage_rollup.params import DEFAULT_DATABASE, DEFAULT_END, DEFAULT_START, DEFAULT_TABLE, JobParams  # noqa: E402
from usage_rollup.session import get_session, ship_package  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="usage_rollup")
    sub = p.add_subparsers(dest="cmd", required=True)

    i = sub.add_parser("ingest", help="filtered scan -> quality gate -> idempotent range replace")
    i.add_argument("--source", required=True)
    i.add_argument("--format", default="parquet")
    i.add_argument("--target", help="path or table (default: --database and --table)")
    i.add_argument("--database", default=DEFAULT_DATABASE)
    i.add_argument("--table", default=DEFAULT_TABLE)
    i.add_argument("--billing-project", help="passed to connectors as parentProject")
    i.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="reader option, may be repeated")
    i.add_argument("--grain", choices=["month", "day"], default="day", help="span of the target's partitions")
    i.add_argument("--versioned", action="store_true", help="the target is the root of a versioned table")
    i.add_argument("--project", required=True)
    i.add_argument("--start", default=DEFAULT_START)
    i.add_argument("--end", default=DEFAULT_END)
    i.add_argument("--timestamp-column", default="timestamp")
    i.add_argument("--scope", default=None, help="restrict the range delete to this column's staged values")
    i.add_argument("--chunk-size", type=int, default=0)
    i.add_argument("--no-cluster", action="store_true",
                   help="skip rebalancing staged rows (backfills from a time-ordered source)")

    t = sub.add_parser("transform", help="daily rollup -> full or keyed incremental write (+ export)")
    t.add_argument("--root", help="raw log path (external source)")
    t.add_argument("--database", help="catalog database (warehouse source)")
    t.add_argument("--table", default=DEFAULT_TABLE)
    t.add_argument("--versioned-source", action="store_true", help="--root is a versioned table of --log-grain")
    t.add_argument("--log-grain", choices=["month", "day"], help="span of the raw log's partitions")
    t.add_argument("--versioned", action="store_true", help="the target is the root of a versioned table")
    t.add_argument("--target", required=True)
    t.add_argument("--start")
    t.add_argument("--end")
    t.add_argument("--mode", choices=["full", "incremental"], default="full")
    t.add_argument("--grain", choices=["month", "day"], default="month")
    t.add_argument("--export-path")

    r = sub.add_parser("report", help="the report bundle as JSON")
    r.add_argument("--rollup", required=True, help="rollup path or table name")
    r.add_argument("--days", type=int, default=0)
    r.add_argument("--as-of", default=None)
    r.add_argument("--project", default=None, help="report on one project of a shared rollup")
    r.add_argument("--grain", choices=["month", "day"], default="month")
    r.add_argument("--versioned", action="store_true", help="the rollup is the root of a versioned table")
    r.add_argument("--output-path", help="write the long reports there")
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session(profile=os.environ.get("USAGE_ROLLUP_PROFILE", "cluster"))
    ship_package(spark)
    partition = {"day": "log_date", "month": "log_month"}
    if args.cmd == "ingest":
        from usage_rollup.plans import run_ingest

        params = JobParams(project=args.project, start=args.start, end=args.end, ts_col=args.timestamp_column,
                           database=args.database, table=args.table, billing_project=args.billing_project)
        target = versions.log_table(spark, args.target, partition[args.grain]) if args.versioned else args.target
        n = run_ingest(spark, args.source, target, params, fmt=args.format, scope=args.scope,
                       max_records=args.chunk_size, cluster_staged=not args.no_cluster,
                       options=dict(o.split("=", 1) for o in args.option), grain=args.grain, partition_col=partition[args.grain])
        print(json.dumps({"rows_loaded": n}))
    elif args.cmd == "transform":
        from usage_rollup.plans import run_transform

        source = "external_source" if args.root else "warehouse"
        target = versions.rollup_table(spark, args.target, args.grain) if args.versioned else args.target
        root = versions.log_table(spark, args.root, partition[args.log_grain or "day"]) if args.versioned_source else args.root
        n = run_transform(spark, target, args.start, args.end, data_source=source, database=args.database, root=root, mode=args.mode,
                          export_path=args.export_path, grain=args.grain, table=args.table)
        print(json.dumps({"rollup_rows_written": n}))
    else:
        from usage_rollup.plans import collect_reports, run_reports

        rollup = versions.rollup_table(spark, args.rollup, args.grain) if args.versioned else args.rollup
        frames = run_reports(spark, rollup, args.days, args.as_of, project=args.project)
        if args.output_path:
            rows = write_reports(frames, args.output_path)
            frames.release()
        else:
            rows = {k: [r.asDict() for r in v] for k, v in collect_reports(frames, release=True).items()}
        print(json.dumps(rows, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
