"""Table maintenance: range replace, keyed upsert, append, export.

Tables are Parquet directories partitioned by a date column (``log_date`` for
the raw log, ``download_month`` for the rollup), given as a path or as a
catalog table name; for a table the files under its location are maintained
the same way and its partition list is synced afterwards.

Publish protocol (range replace and keyed upsert). Spark cannot overwrite a
path it is reading, and dynamic partition overwrite alone leaves partitions
that receive no rows untouched. So:

1. stage the incoming rows once into the shared checkpoint folder and take the
   row count and the quality statistics from what was staged;
2. compute the new content of the *touched* partitions only (survivors of
   the old partitions plus staged rows) and write it, with the list of
   touched partitions, as a complete snapshot into a fixed per-target
   "pending" folder; this cuts the lineage to the target;
3. copy that content, already laid out, into the target with dynamic partition
   overwrite and no further shuffle, so only touched partitions are replaced
   and all others are never read or written;
4. remove touched partitions that ended up empty, then the pending folder.

A full refresh of an existing table takes the same way with every partition
touched. Rows with a NULL date live in the NULL partition: a range replace keeps
the stored ones (as SQL DELETE does), an upsert replaces them by key.

One writer per target at a time (as with the original loader); the pending
folder is per target. A failure before step 3 leaves the target untouched. A failure during 3-4
leaves a complete snapshot behind; the next maintenance call on that target
first swaps it in again (``finish_pending``), which is idempotent, so no
interrupted run leaves a gap. Every intermediate lives in
``spark.checkpoint.dir``, never on a machine-local disk, so it survives
executor loss; executor loss inside a job is handled by task retry.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usage_rollup.functions.columns import bound_like
from usage_rollup.functions.dates import range_dates, session_zone
from usage_rollup.operators.quality import quality_exprs, validate_stats
from usage_rollup.params import DEFAULT_EXPORT_ROWS, MAX_NULL_PCT, NO_LIMIT
from usage_rollup.session import scratch_dir, shared_root
from usage_rollup.sources import storage

LOG_PARTITION = "log_date"
# The rollup is partitioned by month by default: a day of rollup rows is far
# smaller than a day of raw rows, so day directories would mostly hold tiny
# files; a keyed upsert rewrites the months its batch touches. When a day of
# rollup rows is itself large (many projects), use grain="day": partitions
# are then the dates and an upsert rewrites only the days it touches.
ROLLUP_PARTITION = "download_month"
ROLLUP_DATE = "download_date"
ROLLUP_GRAINS = {"month": ROLLUP_PARTITION, "day": ROLLUP_DATE}
#: Files that a task of a partitioned write holds open at once.
OPEN_FILES = 50
#: Parts of a rebalanced write's shuffle: as many as Spark writes straight through (the default of
#: ``spark.shuffle.sort.bypassMergeThreshold``); with more, it keeps a task's rows to order them by part.
REBALANCE_PARTS = 200
#: Settings of a partitioned write. So high a number of parts to keep makes AQE merge parts up to its
#: smallest size (1 MB) only, not up to the advisory one: merged thin values would be too many files.
WRITE_SETTINGS = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
                  "spark.sql.adaptive.coalescePartitions.minPartitionNum": "10000"}


def rollup_partition_column(grain: str = "month") -> str:
    if grain not in ROLLUP_GRAINS:
        raise ValueError(f"grain must be one of {sorted(ROLLUP_GRAINS)}")
    return ROLLUP_GRAINS[grain]


def with_rollup_partition(df: DataFrame, partition_col: str = ROLLUP_PARTITION) -> DataFrame:
    """Add ``download_month`` (first day of the month of ``download_date``) if it is the partition."""
    if partition_col != ROLLUP_PARTITION or ROLLUP_PARTITION in df.columns:
        return df
    return df.withColumn(ROLLUP_PARTITION, F.trunc(F.col(ROLLUP_DATE), "month"))


def clustered(df: DataFrame, *cols: str) -> DataFrame:
    """Cluster rows by the partition columns before a partitioned write.

    A ``REBALANCE`` hint: AQE hashes on ``cols``, merges small partitions and
    splits skewed ones, so each table partition is written by one task (one
    file) unless it is hot, in which case several tasks share it. Without it
    every task writes a file into every partition it holds rows for. The number
    of parts is fixed, so that the rows pass through whatever
    ``spark.sql.shuffle.partitions`` is.
    """
    return df.hint("rebalance", REBALANCE_PARTS, *cols)


@contextmanager
def unsorted_writes(df: DataFrame):
    """Partitioned writes of ``df`` inside hold several files open instead of sorting each task's rows first.

    The sort keeps a task's rows in memory, and how many these are is decided by compressed
    bytes (a scan split, a shuffle block). An open file holds one row group at most. A task
    that meets more than ``OPEN_FILES`` partition values sorts the rows from there on (Spark's
    figure of a task's peak memory leaves that sort out). Rebalanced parts are therefore
    merged up to 1 MB only, so such a task holds little. Limits that the session already sets stay.
    """
    conf = df.sparkSession.conf
    ours = {k: v for k, v in WRITE_SETTINGS.items() if int(conf.get(k, None) or 0) <= 0}
    for k, v in ours.items():
        conf.set(k, v)
    try:
        yield
    finally:
        for k in ours:
            conf.unset(k)


# --- catalog helpers (W1-W3) -------------------------------------------------


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def target_exists(spark: SparkSession, target: str) -> bool:
    """Existence probe: a catalog table, or a path that holds data files."""
    if _is_path(target):
        return storage.has_data(spark, target)
    return spark.catalog.tableExists(target)


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def _location(spark: SparkSession, target: str) -> str | None:
    """Storage folder of a target: the path itself, or a catalog table's location (None if missing)."""
    if _is_path(target):
        return target
    if not spark.catalog.tableExists(target):
        return None
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect():
        if r.col_name == "Location":
            return r.data_type
    raise ValueError(f"{target} has no storage location")


def _sync_catalog(spark: SparkSession, target: str) -> None:
    """After files changed under a catalog table: sync its partition list and cached metadata."""
    if not _is_path(target):
        spark.sql(f"MSCK REPAIR TABLE {target} SYNC PARTITIONS")
        spark.sql(f"REFRESH TABLE {target}")


def _read_touched(spark: SparkSession, target: str, partition_col: str, touched: list[str],
                  schema: T.StructType) -> DataFrame:
    """The touched partitions of ``target``; ``schema`` stands in for a table without data files."""
    loc = _location(spark, target)
    if not storage.has_data(spark, loc):
        return spark.createDataFrame([], schema)
    # a table whose only partition is the NULL one has no inferable partition type
    stored = spark.read.parquet(loc).withColumn(partition_col, F.col(partition_col).cast(schema[partition_col].dataType))
    dates = [_date(v) for v in touched if v != storage.NULL_PARTITION]
    cond = F.col(partition_col).isin(dates)
    if storage.NULL_PARTITION in touched:
        cond = cond | F.col(partition_col).isNull()
    return stored.where(cond)


def ensure_target(spark: SparkSession, df: DataFrame, target: str, partition_by: list[str] | None = None) -> bool:
    """Create an empty table with ``df``'s schema if missing; True if created."""
    if target_exists(spark, target) or (_is_path(target) and storage.exists(spark, f"{target.rstrip('/')}/_SUCCESS")):
        return False
    w = df.limit(0).write.mode("ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target or ":" in target:
        w.parquet(target)
    else:
        w.format("parquet").saveAsTable(target)
    return True


# --- range delete / replace (W4, W6) -------------------------------------------


def range_condition(df: DataFrame, ts: str, start, end, scope: Column | None = None) -> Column:
    """``ts in [start, end)`` (AND the optional scope), NULL-safe to False."""
    dtype = df.schema[ts].dataType
    cond = (F.col(ts) >= bound_like(start, dtype)) & (F.col(ts) < bound_like(end, dtype))
    if scope is not None:
        cond = cond & scope
    return F.coalesce(cond, F.lit(False))


def delete_range(target: DataFrame, ts: str, start, end, scope: Column | None = None) -> DataFrame:
    """Rows that survive ``DELETE WHERE ts >= start AND ts < end [AND scope]``.

    Rows whose condition is NULL (NULL timestamp) survive, as in SQL DELETE.
    """
    return target.where(~range_condition(target, ts, start, end, scope))


def delete_range_scoped(target: DataFrame, staged: DataFrame, ts: str, start, end,
                        scope: str | None = None) -> DataFrame:
    """Survivors of a range delete limited to the ``scope`` values present in ``staged``.

    Without ``scope`` this is ``delete_range``. With it, in-range rows are
    deleted only when their ``scope`` value occurs in the staged rows: an
    anti-join against the staged distinct values (AQE broadcasts that side
    at run time when it is small), never a driver-side list.
    """
    if not scope:
        return delete_range(target, ts, start, end)
    in_range = range_condition(target, ts, start, end)
    outside = target.where(~in_range)
    inside = target.where(in_range).join(staged.select(scope).distinct(), scope, "left_anti")
    return outside.unionByName(inside)


def _date(v) -> _dt.date:
    s = str(v)
    return _dt.date.fromisoformat(s[:10])


def _range_dates(spark: SparkSession, start, end, grain: str = "day") -> list[str]:
    """Partition dates (days, or first days of months) a half-open timestamp range touches (session zone)."""
    days = range_dates(start, end, session_zone(spark))
    return days if grain == "day" else sorted({f"{d[:7]}-01" for d in days})


def log_partition(ts: str, grain: str = "day") -> Column:
    """The raw table's partition value: the day of ``ts``, or the first day of its month."""
    if grain not in ROLLUP_GRAINS:
        raise ValueError(f"grain must be one of {sorted(ROLLUP_GRAINS)}")
    day = F.to_date(F.col(ts))
    return day if grain == "day" else F.trunc(day, "month")


def _pending_dir(spark: SparkSession, target: str) -> str:
    """Fixed per-target folder (under the shared checkpoint dir) of an unpublished change."""
    h = hashlib.sha1(storage.qualified(spark, target).encode()).hexdigest()[:20]
    # under the configured root, not the per-application subfolder: a restarted
    # driver must find what the previous one left
    return f"{shared_root(spark)}/usage_rollup/pending-{h}"


def _swap_in(spark: SparkSession, new_path: str, target: str, partition_col: str, touched: list[str],
             max_records: int | None, schema) -> None:
    """Dynamic-overwrite the touched partitions from ``new_path``; drop emptied ones.

    The snapshot's files are already one or a few per partition, so they are
    copied without another shuffle.
    """
    # the schema is passed on because a fully emptied range writes no files
    new = spark.read.schema(schema).parquet(new_path)
    w = (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_col))
    if max_records:
        w = w.option("maxRecordsPerFile", int(max_records))
    with unsorted_writes(new):
        w.parquet(target)
    present = set(storage.list_partitions(spark, new_path, partition_col))
    for value in touched:
        if value not in present:
            storage.delete_partition(spark, target, partition_col, value)


def finish_pending(spark: SparkSession, target: str, partition_col: str | None = None, max_records: int | None = None) -> bool:
    """Complete a publish that an earlier run computed but did not finish.

    The new content (``_SUCCESS``) and then the manifest (touched partitions,
    schema) are written before any partition of the target is swapped, so a run
    that died while swapping left a full snapshot behind; swapping it in again
    is idempotent. Returns True if there was one.
    """
    loc = _location(spark, target)
    if loc is None:
        return False
    pend = _pending_dir(spark, loc)
    if not (storage.exists(spark, f"{pend}/new/_SUCCESS") and storage.exists(spark, f"{pend}/manifest.json")):
        if storage.exists(spark, pend):
            storage.delete_path(spark, pend)  # an unfinished snapshot: the target was never touched
        return False
    try:
        manifest = json.loads(storage.read_text(spark, f"{pend}/manifest.json"))
    except ValueError:  # cut off: the swap never began
        storage.delete_path(spark, pend)
        return False
    partition_col = partition_col or manifest["partition_col"]
    touched = manifest["touched"]
    schema = T.StructType.fromJson(manifest["schema"])
    _swap_in(spark, f"{pend}/new", loc, partition_col, touched, max_records, schema)
    storage.delete_path(spark, pend)
    _sync_catalog(spark, target)
    return True


def discard_pending(spark: SparkSession, target: str) -> None:
    """Remove an unpublished change of ``target``."""
    loc = _location(spark, target)
    if loc is not None:
        storage.delete_path(spark, _pending_dir(spark, loc))


def _publish(spark: SparkSession, new: DataFrame, target: str, partition_col: str, touched: list[str],
             max_records: int | None, staged_path: str | None = None) -> None:
    """Snapshot the touched partitions' new content, then swap it into the target.

    ``touched`` holds partition values (a few per run: the loaded range). When
    the new content already lies in ``staged_path``, that folder becomes the
    snapshot (one rename).
    """
    pend = _pending_dir(spark, _location(spark, target))
    if not (staged_path and storage.rename(spark, staged_path, f"{pend}/new")):
        with unsorted_writes(new):
            (clustered(new, partition_col).write.mode("overwrite").option("maxRecordsPerFile", int(max_records or 0))
             .partitionBy(partition_col).parquet(f"{pend}/new"))
    # manifest last: a snapshot counts as complete only once both exist
    manifest = {"partition_col": partition_col, "touched": list(touched), "schema": new.schema.jsonValue()}
    storage.write_text(spark, f"{pend}/manifest.json", json.dumps(manifest))
    finish_pending(spark, target, partition_col, max_records)


def _first_load(spark: SparkSession, stage_path: str, target: str, partition_col: str,
                max_records: int | None, schema: T.StructType) -> None:
    """Create the target from the staged rows (already laid out as the target is).

    On the same file system the staged folder is moved into place (one
    metadata operation, and the target appears whole); otherwise it is copied
    without another shuffle, as in ``_swap_in``. A catalog target is created as a
    partitioned table.
    """
    staged = spark.read.schema(schema).parquet(stage_path)
    if not _is_path(target):
        w = staged.write.mode("append").format("parquet").partitionBy(partition_col)
        if max_records:
            w = w.option("maxRecordsPerFile", int(max_records))
        with unsorted_writes(staged):
            w.saveAsTable(target)
        return
    if not storage.exists(spark, target) and storage.rename(spark, stage_path, target):
        return
    w = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records:
        w = w.option("maxRecordsPerFile", int(max_records))
    with unsorted_writes(staged):
        w.partitionBy(partition_col).parquet(target)


def replace_range(
    spark: SparkSession,
    staged: DataFrame,
    target: str,
    ts: str = "timestamp",
    start=None,
    end=None,
    scope: str | None = None,
    partition_col: str = LOG_PARTITION,
    max_records: int = NO_LIMIT,
    key: str = "project",
    max_null_pct: float = MAX_NULL_PCT,
    cluster_staged: bool = True,
    grain: str = "day",
) -> int:
    """Idempotently replace ``[start, end)`` of a date-partitioned Parquet table.

    Returns the number of staged rows (0: nothing staged, target untouched).
    ``scope=None`` deletes every row in the range (parity with the
    single-project loader, which deletes all projects' rows in the range);
    ``scope="project"`` (or any column name) restricts the delete to the values
    present in the staged rows.

    ``cluster_staged`` rebalances the staged rows on the date partition before
    they are written (one shuffle of the loaded range; right for the usual
    day-sized loads and for unordered sources). For a long backfill from a
    source already laid out by time, ``False`` writes each input split's dates
    directly and skips that shuffle.

    ``grain="month"`` partitions by the first day of the month, for logs so thin
    that day folders would hold tiny files; keep it (and ``partition_col``) fixed
    per table.

    Staged rows with a NULL timestamp (within the gate's limit) are added to the
    NULL partition; stored ones are in no range and stay.
    """
    if start is None or end is None:
        raise ValueError("replace_range needs both start and end")
    finish_pending(spark, target, partition_col, max_records)
    staged = staged.withColumn(partition_col, log_partition(ts, grain))
    # 1. stage once; count and statistics come from the staged files, so a task
    # that ran twice cannot count its rows twice
    schema = staged.schema
    stage_path = scratch_dir(spark, "staged")
    src = clustered(staged, partition_col) if cluster_staged else staged
    with unsorted_writes(staged):
        (src.write.mode("overwrite")
         .option("maxRecordsPerFile", int(max_records or 0)).partitionBy(partition_col).parquet(stage_path))
    staged_dates = storage.list_partitions(spark, stage_path, partition_col)
    try:
        if not staged_dates:
            return 0
        staged_df = spark.read.schema(schema).parquet(stage_path)
        stats = staged_df.agg(*quality_exprs(ts, key)).first().asDict()
        if not stats.get("total_rows"):
            return 0
        validate_stats(stats, "timestamp", key, max_null_pct)
        if not target_exists(spark, target):
            _first_load(spark, stage_path, target, partition_col, max_records, schema)
            return int(stats["total_rows"])
        # 2. new content of the touched partitions only (partition-pruned read)
        touched = sorted(set(_range_dates(spark, start, end, grain)) | set(staged_dates))
        old = _read_touched(spark, target, partition_col, touched, schema)
        survivors = delete_range_scoped(old, staged_df, ts, start, end, scope)
        # 3 + 4. snapshot, swap touched partitions, drop emptied ones
        _publish(spark, survivors.unionByName(staged_df), target, partition_col, touched, max_records)
        return int(stats["total_rows"])
    finally:
        storage.delete_path(spark, stage_path)


def delete_range_table(spark: SparkSession, target: str, ts: str, start, end,
                       partition_col: str = LOG_PARTITION, grain: str = "day") -> None:
    """Delete ``[start, end)`` from a date-partitioned table (all scopes).

    Skipped when the target does not exist. Only partitions of the range are
    read and rewritten; partitions left empty are removed.
    """
    if not target_exists(spark, target):
        return
    finish_pending(spark, target, partition_col)
    if not storage.has_data(spark, _location(spark, target)):
        return
    touched = _range_dates(spark, start, end, grain)
    old = _read_touched(spark, target, partition_col, touched,
                        T.StructType([T.StructField(partition_col, T.DateType())]))
    _publish(spark, delete_range(old, ts, start, end), target, partition_col, touched, None)


# --- keyed upsert (W8) ----------------------------------------------------------


def upsert_frame(target: DataFrame, batch: DataFrame, key: str = "load_id",
                 partition_col: str | None = ROLLUP_PARTITION) -> DataFrame:
    """``target`` rows whose key is not in ``batch``, plus all of ``batch``.

    Tolerates duplicate keys inside the batch (delete+insert, not MERGE).
    When the key determines ``partition_col`` (the rollup key starts with the
    date, which fixes the month), the anti-join also matches on it.
    """
    keys = batch.select(F.col(key).alias("_k"), *([F.col(partition_col).alias("_p")] if partition_col else [])).distinct()
    same = F.col(key) == F.col("_k")
    if partition_col:
        same = same & F.col(partition_col).eqNullSafe(F.col("_p"))  # a NULL date is a partition, too
    return target.join(keys, same, "left_anti").unionByName(batch)


def upsert_by_key(spark: SparkSession, target: str, batch: DataFrame, key: str = "load_id",
                  partition_col: str = ROLLUP_PARTITION) -> int:
    """Keyed incremental load of a partitioned table; returns batch rows.

    Only partitions holding batch rows are read and rewritten. For the rollup
    the partition column (month) is derived from the key's leading date.
    """
    finish_pending(spark, target, partition_col)
    batch = with_rollup_partition(batch, partition_col)
    schema = batch.schema
    stage_path = scratch_dir(spark, "batch")
    with unsorted_writes(batch):
        clustered(batch, partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(stage_path)
    touched = storage.list_partitions(spark, stage_path, partition_col)
    try:
        if not touched:
            return 0
        staged = spark.read.schema(schema).parquet(stage_path)
        n = staged.count()
        if not target_exists(spark, target):
            _first_load(spark, stage_path, target, partition_col, None, schema)
            return n
        old = _read_touched(spark, target, partition_col, touched, schema)
        _publish(spark, upsert_frame(old, staged, key, partition_col), target, partition_col, touched, None)
        return n
    finally:
        storage.delete_path(spark, stage_path)


# --- plain writes (W5, W7, W9) ------------------------------------------------------


def append(df: DataFrame, target: str, max_records: int = NO_LIMIT,
           partition_by: list[str] | None = None) -> int:
    """Append rows, at most ``max_records`` per file (0: no limit); returns rows written.

    Parallel write tasks replace the chunk loop; the row count is observed in
    the writing tasks, above any shuffle, where each task counts once.
    """
    finish_pending(df.sparkSession, target)  # else a later publish would swap older rows over these
    obs = Observation("append")
    src = clustered(df, *partition_by) if partition_by else df
    src = src.observe(obs, F.count(F.lit(1)).alias("n"))
    w = src.write.mode("append").option("maxRecordsPerFile", int(max_records))
    if partition_by:
        w = w.partitionBy(*partition_by)
    with unsorted_writes(df):
        if "/" in target or ":" in target:
            w.parquet(target)
        else:
            w.format("parquet").saveAsTable(target)
    return _observed_rows(obs, df)


def append_exact(df: DataFrame, target: str, chunk: int, partition_by: list[str] | None = None) -> int:
    """Append rows as files of exactly ``chunk`` rows, the last one with the rest; returns rows written.

    ``append`` bounds the rows of a file, but every task ends with a file that is
    not full. Here the rows are numbered first: they are staged with their place in
    their partition, the partitions' counts give every partition the number of
    its first row, and the shuffle deals out whole chunks. So 1,000 rows in chunks of
    100 give 10 files however many tasks write. With ``partition_by`` the chunks are
    cut within each partition value instead (each value ends with its own rest).
    """
    if chunk < 1:
        raise ValueError("chunk must be positive")
    spark = df.sparkSession
    finish_pending(spark, target)
    by = list(partition_by or [])
    stage_path = scratch_dir(spark, "chunks")
    try:
        numbered = df.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
        numbered.write.parquet(stage_path)
        staged = spark.read.schema(numbered.schema).parquet(stage_path)
        # one row a write task (and partition value): a small window
        sizes = staged.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"))
        before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_n")
        names = {c: f"_of_{i}" for i, c in enumerate([*by, "_part"])}
        offsets = sizes.select(*[F.col(c).alias(n) for c, n in names.items()], before.alias("_before"))
        inside = (F.row_number().over(Window.partitionBy(*by, "_part").orderBy("_at")) - 1 if by
                  else F.col("_at").bitwiseAND((1 << 33) - 1))  # the id counts up within its partition
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
        placed = (staged.join(offsets, same).withColumn("_row", F.col("_before") + inside)
                  .withColumn("_chunk", F.floor(F.col("_row") / chunk)))
        out = placed.repartition(*by, "_chunk").sortWithinPartitions(*by, "_chunk", "_row").select(*df.columns)
        w = out.write.mode("append").option("maxRecordsPerFile", int(chunk))
        if by:
            w = w.partitionBy(*by)
        if _is_path(target):
            w.parquet(target)
        else:
            w.format("parquet").saveAsTable(target)
        return staged.count()
    finally:
        storage.delete_path(spark, stage_path)


def _observed_rows(obs: Observation, df: DataFrame) -> int:
    """The observed row count; counted anew where an empty write left no task to report it."""
    try:
        n = obs.get.get("n")
    except Exception:  # noqa: BLE001 - no metrics were reported
        n = None
    return df.count() if n is None else int(n)


def write_rollup(spark: SparkSession, rollup: DataFrame, target: str, mode: str = "full",
                 grain: str = "month") -> int:
    """Materialize the rollup: ``full`` rewrites it, ``incremental`` upserts by key.

    ``grain`` picks the partitioning (``month`` or ``day``); keep it fixed per table.
    """
    part = rollup_partition_column(grain)
    if mode == "incremental":
        return upsert_by_key(spark, target, rollup, partition_col=part)
    if mode != "full":
        raise ValueError("mode must be 'full' or 'incremental'")
    # an interrupted publish is completed first: its snapshot may be the only whole copy until the new one exists
    finish_pending(spark, target)
    rollup = with_rollup_partition(rollup, part)
    loc = _location(spark, target)
    old = storage.list_partitions(spark, loc, part) if loc else []
    if old and _is_path(target):
        stored = set(spark.read.parquet(loc).columns)
        if stored != set(rollup.columns):
            raise ValueError(f"columns differ from those of {target}: {sorted(stored ^ set(rollup.columns))}")
    if old and (_is_path(target) or set(spark.table(target).columns) == set(rollup.columns)):
        # an existing table: snapshot first, then swap every partition, so a crash loses nothing
        stage_path = scratch_dir(spark, "refresh")
        try:
            with unsorted_writes(rollup):
                clustered(rollup, part).write.mode("overwrite").partitionBy(part).parquet(stage_path)
            staged = spark.read.schema(rollup.schema).parquet(stage_path)
            n = staged.count()
            touched = sorted(set(old) | set(storage.list_partitions(spark, stage_path, part)))
            _publish(spark, staged, target, part, touched, None, staged_path=stage_path)
        finally:
            storage.delete_path(spark, stage_path)
        return n
    obs = Observation("rollup")
    src = clustered(rollup, part).observe(obs, F.count(F.lit(1)).alias("n"))
    w = src.write.mode("overwrite").partitionBy(part)
    with unsorted_writes(rollup):
        if _is_path(target):
            w.parquet(target)
        else:
            w.format("parquet").saveAsTable(target)
    return _observed_rows(obs, rollup)


def with_year_month(df: DataFrame, date_col: str = ROLLUP_DATE) -> DataFrame:
    return df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})


def export_partitioned(df: DataFrame, date_col: str, path: str, max_records: int = NO_LIMIT,
                       row_group_rows: int = DEFAULT_EXPORT_ROWS) -> None:
    """Export as zstd Parquet partitioned by ``year``/``month``, ``row_group_rows`` rows a row group at most.

    The Parquet writer closes a row group at its row limit or at its byte size,
    whichever comes first. ``max_records`` bounds the rows of a file (0: no limit).

    Rows are rebalanced on (year, month): each month is written by one task
    unless it dominates, in which case AQE splits it over several tasks (no
    month lands whole on one task, no task writes into every month).
    Dynamic overwrite rewrites only the exported months.
    """
    out = with_year_month(df, date_col)
    with unsorted_writes(out):
        (clustered(out, "year", "month")
         .write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("compression", "zstd")
         .option("maxRecordsPerFile", int(max_records))
         .option("parquet.block.row.count.limit", int(row_group_rows))
         .partitionBy("year", "month")
         .parquet(path))
