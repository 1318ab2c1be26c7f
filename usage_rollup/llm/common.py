"""Shared helpers of the operators: scratch tables and connected components."""

from __future__ import annotations

import ctypes
import functools

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, ship_package
from ..sources import storage

#: Rows of text handed to Python at once, unless the session says otherwise: a batch stands in memory
#: several times, in the executor and in its worker, and documents are long.
BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"
#: Tables written by ``stored`` in this process, oldest first.
_written: list[str] = []


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    ship_package(spark)
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many stored tables there are, for ``remove_since``."""
    return len(_written)


def remove_since(spark: SparkSession, mark: int, keep: DataFrame) -> None:
    """Remove the tables stored since ``mark`` that ``keep`` does not read."""
    used = " ".join(keep.inputFiles())
    for path in _written[mark:]:
        if path.rsplit("/", 1)[-1] not in used:
            storage.delete_path(spark, path)
            _written.remove(path)


def lean(run):
    """A task function whose worker gives its memory back to the system when the task ends."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    """Return free memory of this process to the system (workers are reused by later stages)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not glibc


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, component) of every node in ``edges(a, b)``; component is the smallest node reached.

    Min-label propagation with pointer jumping. Each round sends labels over the
    edges (pre-aggregated ``min``) and then follows the label's own label, so
    the rounds grow with the logarithm of a component's diameter. Labels live
    in written tables; only a change count reaches the driver.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("component")), "cc-labels")
    for _ in range(max_rounds):
        near = both.join(label.withColumnRenamed("node", "b"), "b").select(
            F.col("a").alias("node"), F.lit(None).cast(label.schema["component"].dataType).alias("component"), F.col("component").alias("m"))
        # a node's own label goes along with its neighbours', so one grouping has both
        step = (near.union(label.select("node", "component", F.col("component").alias("m")))
                .groupBy("node").agg(F.max("component").alias("component"), F.min("m").alias("to")))
        jump = label.select(F.col("node").alias("to"), F.col("component").alias("next"))
        new = stored(step.join(jump, "to", "left")
                     .select("node", F.least("to", F.coalesce("next", "to")).alias("component"),
                             (F.least("to", F.coalesce("next", "to")) < F.col("component")).alias("changed")),
                     "cc-labels")
        label = new.select("node", "component")
        if new.where("changed").limit(1).count() == 0:
            return label
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
