"""Additive incremental rollup: a micro-batch costs its own rows, with a batch ledger.

``incremental`` recomputes the dates that a micro-batch touches, so a late file costs
a rescan of its date. Here each micro-batch is rolled up by itself and its partial
counts are appended to a versioned table; the rollup is their sum. What makes that safe
is the ledger: the number of the last applied batch is published in the same
atomic step as its counts (``Manifest.facts``). A batch that is replayed after
a crash is either not in the table at all, or is recognised and skipped; it can't be
counted twice or get lost.

Partial rows of a month pile up, one folder a batch. ``compact`` sums the months that
hold several folders; the result of reading the table does not change by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from usage_rollup.functions.columns import load_id
from usage_rollup.operators import versions
from usage_rollup.operators.maintain import with_rollup_partition
from usage_rollup.operators.rollup import daily_rollup
from usage_rollup.operators.versions import VersionedTable
from usage_rollup.schema import ROLLUP_COLUMNS, ROLLUP_DIMENSIONS
from usage_rollup.streaming.incremental import MAX_FILES

N = "daily_download_sum"


def last_batch(table: VersionedTable, stream: str) -> int:
    """Number of the last batch of a stream that the table holds; -1 before the first."""
    return int(table.manifest().facts.get(f"stream:{stream}", -1))


def add_batch(table: VersionedTable, batch: DataFrame, epoch: int, stream: str, ts: str = "timestamp") -> bool:
    """Add a micro-batch's counts; False if this batch of the stream is in the table already."""
    if epoch <= last_batch(table, stream):
        return False
    counts = with_rollup_partition(daily_rollup(batch, ts=ts), table.partition_col)
    with versions._Undo(table.begin(f"batch {epoch} of {stream}")) as change:
        change.commit(versions._joined(change.base.parts, change.write(counts)), counts.schema, {f"stream:{stream}": epoch})
    return True


def read_rollup(table: VersionedTable) -> DataFrame:
    """The rollup: partial counts summed by key."""
    return _summed(table.read()).select(*ROLLUP_COLUMNS)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*ROLLUP_DIMENSIONS).agg(F.sum(N).cast("bigint").alias(N)).withColumn("load_id", load_id())


def compact(table: VersionedTable, folders: int = 2) -> list[str]:
    """Sum the partitions that lie in ``folders`` folders or more; returns their values."""
    base = table.manifest()
    many = {v: e for v, e in base.parts.items() if len(e) >= folders}
    if many:
        rows = table._read(base.schema, many).drop("gen")
        summed = with_rollup_partition(_summed(rows), table.partition_col).select(*base.schema.fieldNames())
        versions.replace_partitions(table, summed, sorted(many), operation="compact")
    return sorted(many)


def start_additive_rollup(spark: SparkSession, source_path: str, table: VersionedTable, checkpoint: str, stream: str = "log",
                          ts: str = "timestamp", available_now: bool = True, max_files_per_trigger: int | None = MAX_FILES,
                          schema=None):
    """Start the streaming query over newly landed log files; returns the ``StreamingQuery``.

    ``stream`` names the source in the table's ledger: one name for one ``checkpoint`` folder, which
    numbers the batches. A new checkpoint folder reads every file anew and needs a new name and table.
    """
    schema = schema or spark.read.option("basePath", source_path).parquet(source_path).schema
    reader = spark.readStream.schema(schema).option("basePath", source_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))

    def apply(batch: DataFrame, epoch: int) -> None:
        add_batch(table, batch, epoch, stream, ts)

    w = reader.parquet(source_path).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
