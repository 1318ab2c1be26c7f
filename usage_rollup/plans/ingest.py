"""Ingest job: filtered scan -> stage + quality gate -> idempotent range replace.

Spark shape: one pass over the source writes the staged rows to the shared
checkpoint folder; the gate statistics are read from what was staged; a last
job rewrites only the touched date partitions of the target.
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession

from usage_rollup.operators import versions
from usage_rollup.operators.maintain import LOG_PARTITION, ensure_database, replace_range
from usage_rollup.params import NO_LIMIT, JobParams
from usage_rollup.schema import LOG_COLUMNS
from usage_rollup.sources.scan import scan_log

log = logging.getLogger("usage_rollup.ingest")


def run_ingest(
    spark: SparkSession,
    source,
    target,
    params: JobParams,
    fmt: str = "parquet",
    columns=LOG_COLUMNS,
    scope: str | None = None,
    max_records: int = NO_LIMIT,
    cluster_staged: bool = True,
    options: dict | None = None,
    schema=None,
    partition_col: str = LOG_PARTITION,
    grain: str = "day",
) -> int:
    """Load ``params.project`` rows of ``[start, end)`` from ``source`` into ``target``.

    ``source`` is a DataFrame, a catalog table (``fmt="table"``) or what the
    reader ``fmt`` loads with ``options``. ``target`` is a path, a catalog table's
    name, a ``VersionedTable``, or None for the parameters' own database and table. The
    database of a catalog target is created if missing. Returns rows loaded; 0 means nothing matched and the target was left untouched.
    Raises ``DataQualityError`` before the target is modified.
    """
    t0 = time.time()
    staged: DataFrame = scan_log(spark, source, params, columns, fmt, options, schema=schema)
    if target is None:
        target = f"{params.database}.{params.table}"
    if isinstance(target, versions.VersionedTable):
        n = versions.replace_range(target, staged, params.ts_col, params.start, params.end, scope=scope,
                                   max_records=max_records, grain=grain)
        return _logged(n, params, t0)
    if "/" not in target and ":" not in target and "." in target:
        ensure_database(spark, target.rsplit(".", 1)[0])
    n = replace_range(spark, staged, target, params.ts_col, params.start, params.end,
                      scope=scope, max_records=max_records, cluster_staged=cluster_staged,
                      partition_col=partition_col, grain=grain)
    return _logged(n, params, t0)


def _logged(n: int, params: JobParams, t0: float) -> int:
    elapsed = time.time() - t0
    if n == 0:
        log.warning("no rows matched %s in [%s, %s)", params.project, params.start, params.end)
    log.info("ingest finished: %d rows in %d min %.2f s", n, elapsed // 60, elapsed % 60)
    return n
