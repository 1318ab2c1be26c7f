"""Report job: the whole report bundle for one request, from one scan of the rollup."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession

from usage_rollup.operators.bundle import SharedBundle
from usage_rollup.sources.scan import load_rollup


def run_reports(spark: SparkSession, rollup, days: int = 0, as_of=None, project: str | None = None) -> SharedBundle:
    """``rollup`` is a DataFrame, Parquet path, table name or versioned table; ``days`` is whitelisted.

    ``project`` restricts every report to one project's rows (a filter pushed
    into the rollup scan). The frames read a small stored aggregate, which
    ``release()`` removes.
    """
    return SharedBundle(rollup if isinstance(rollup, DataFrame) else load_rollup(spark, rollup), days, as_of, project)


def collect_reports(frames: dict[str, DataFrame], workers: int = 8, release: bool = False) -> dict[str, list[Row]]:
    """Evaluate the bundle's frames concurrently and bring all of them to the driver.

    For callers that want every row (a dashboard's cache of one project). The series and the
    adoption rows grow with the history; ``bundle.write_reports`` leaves those to the executors.
    ``release`` removes the aggregate that the frames read.
    """
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = {name: pool.submit(df.collect) for name, df in frames.items()}
        out = {name: f.result() for name, f in futures.items()}
    if release and isinstance(frames, SharedBundle):
        frames.release()
    return out
