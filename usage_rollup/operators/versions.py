"""Versioned publish: immutable data folders and one small manifest a version.

Layout of a table::

    <root>/data/gen=<token>/<partition>=<value>/part-*.parquet   written once, never changed
    <root>/_versions/v00000007.json                              what version 7 consists of
    <root>/_current                                              number of a recent version

A manifest names, for each partition value, the folders (and, where only some
files of a folder are left, the files) that hold its rows. A change writes new
data folders and then publishes with one atomic step: its manifest is renamed to
the next number, which fails if another writer took that number. So

* readers resolve one manifest and see one version, whatever is being written;
* a run that dies before the publish step leaves data that no version names, and a
  run that dies after it is complete: there is nothing to finish or roll back;
* of two concurrent writers the later one fails cleanly (``ConcurrentWriteError``);
* an older version stays readable and can be restored, which publishes its content
  anew, without copying data.

Incoming rows are written once, straight into their data folder: a range replace
adds that folder to the partitions it touches and rewrites the survivors only. A
keyed upsert finds the files that hold a matched key and rewrites just these; all
other files of the touched partitions are kept by name.

``_current`` only spares readers a listing; they look for later numbers from there.
Driver-side state is metadata: partition values, and file names of touched folders.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usage_rollup.operators.maintain import (LOG_PARTITION, ROLLUP_DATE, _range_dates, clustered, delete_range_scoped,
                                             log_partition, rollup_partition_column, unsorted_writes, with_rollup_partition)
from usage_rollup.operators.quality import quality_exprs, validate_stats
from usage_rollup.params import MAX_NULL_PCT, NO_LIMIT
from usage_rollup.sources import storage

#: Up to so many keys of a batch are also stated as literals, so that the Parquet
#: reader can skip row groups by their Bloom filters; beyond it the join alone decides.
KEY_LITERALS = 1000
#: Folders younger than this may belong to a running writer.
GRACE_SECONDS = 24 * 3600


class ConcurrentWriteError(RuntimeError):
    """Another writer published first; nothing was changed."""


@dataclass(frozen=True)
class Manifest:
    """What one version consists of: per partition value a list of (folder token, files or None for all)."""

    version: int
    operation: str = ""
    schema: T.StructType | None = None
    parts: dict[str, list[tuple[str, list[str] | None]]] = field(default_factory=dict)
    #: small facts that are published together with the data (a stream's last batch, a source's version)
    facts: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "operation": self.operation, "schema": self.schema.jsonValue(),
                           "parts": self.parts, "facts": self.facts})

    @staticmethod
    def from_json(text: str) -> "Manifest":
        d = json.loads(text)
        parts = {v: [(g, files) for g, files in entries] for v, entries in d["parts"].items()}
        return Manifest(d["version"], d["operation"], T.StructType.fromJson(d["schema"]), parts, d["facts"])


class VersionedTable:
    """A partitioned Parquet table under ``root`` whose versions are immutable."""

    def __init__(self, spark: SparkSession, root: str, partition_col: str, bloom_col: str | None = None):
        self.spark, self.root, self.partition_col, self.bloom_col = spark, root.rstrip("/"), partition_col, bloom_col

    # --- versions -------------------------------------------------------------

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/_versions/v{version:08d}.json"

    def current(self) -> int:
        """Number of the newest version; 0 before the first."""
        hint = f"{self.root}/_current"
        n = int(storage.read_text(self.spark, hint)) if storage.exists(self.spark, hint) else 0
        while storage.exists(self.spark, self._manifest_path(n + 1)):
            n += 1
        return n

    def versions(self) -> list[int]:
        """Numbers of the versions that are still kept."""
        names = [name for name, _ in storage.list_names(self.spark, f"{self.root}/_versions")]
        return [int(name[1:9]) for name in names if name.endswith(".json")]

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.current() if version is None else version
        if version == 0:
            return Manifest(0)
        path = self._manifest_path(version)
        if not storage.exists(self.spark, path):
            raise ValueError(f"{self.root} has no version {version}")
        return Manifest.from_json(storage.read_text(self.spark, path))

    def history(self) -> DataFrame:
        """version, operation, partitions, folders: one row per kept version."""
        rows = [(m.version, m.operation, len(m.parts), len({g for e in m.parts.values() for g, _ in e}))
                for m in map(self.manifest, self.versions())]
        return self.spark.createDataFrame(rows, "version int, operation string, partitions int, folders int")

    # --- reading --------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the newest). An emptied table reads as no rows."""
        m = self.manifest(version)
        if m.schema is None:
            raise ValueError(f"{self.root} has no version yet")
        return self._read(m.schema, m.parts).drop("gen")

    def _read(self, schema: T.StructType, parts: dict, with_file: bool = False) -> DataFrame:
        """Rows of ``parts`` with their folder (``gen``), and their file's name (``_file``) if wanted."""
        wide = T.StructType([f for f in schema.fields if f.name != self.partition_col]
                            + [T.StructField("gen", T.StringType()), schema[self.partition_col]])
        paths = [f"{folder}/{name}" if name else folder for value, entries in parts.items() for g, files in entries
                 for folder in [self._folder(g, value)] for name in (files if files is not None else [None])]
        if not paths:
            df = self.spark.createDataFrame([], wide)
            return df.withColumn("_file", F.lit(None).cast("string")) if with_file else df
        df = self.spark.read.schema(wide).option("basePath", f"{self.root}/data").parquet(*paths)
        return df.select("*", F.col("_metadata.file_name").alias("_file")) if with_file else df

    def _folder(self, gen: str, value: str) -> str:
        return f"{self.root}/data/gen={gen}/{self.partition_col}={value}"

    # --- changing -------------------------------------------------------------

    def begin(self, operation: str) -> "Change":
        return Change(self, self.manifest(), operation)

    def restore(self, version: int) -> int:
        """Publish the content of an older version as the newest one; returns its number."""
        old = self.manifest(version)
        return self.begin(f"restore {version}").commit(old.parts, old.schema)

    def vacuum(self, keep: int = 2, grace_seconds: float = GRACE_SECONDS) -> list[str]:
        """Drop manifests but the last ``keep`` and the data folders that none of these names; returns the folders.

        Folders younger than ``grace_seconds`` stay: a running writer may be about to name them.
        """
        if keep < 1:
            raise ValueError("keep at least one version")
        versions = self.versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        for v in versions[:-keep]:
            storage.delete_path(self.spark, self._manifest_path(v))
        named = {f"gen={g}" for m in kept for entries in m.parts.values() for g, _ in entries}
        limit = time.time() * 1000 - grace_seconds * 1000
        gone = [name for name, changed in storage.list_names(self.spark, f"{self.root}/data")
                if name.startswith("gen=") and name not in named and changed <= limit]
        for name in gone:
            storage.delete_path(self.spark, f"{self.root}/data/{name}")
        return gone


class Change:
    """One change under way: data folders written so far, and the version it builds on."""

    def __init__(self, table: VersionedTable, base: Manifest, operation: str):
        self.table, self.base, self.operation = table, base, operation
        self.token, self.gens = uuid.uuid4().hex[:12], []

    def write(self, df: DataFrame, max_records: int = NO_LIMIT, cluster: bool = True, sort_by: str | None = None) -> dict:
        """Write ``df`` into a new data folder; returns its entries by partition value."""
        t = self.table
        gen = f"{self.base.version + 1}-{self.token}-{len(self.gens)}"
        self.gens.append(gen)
        src = clustered(df, t.partition_col) if cluster else df
        if sort_by:  # files whose rows lie together by this column can be told apart by its bounds
            src = src.sortWithinPartitions(t.partition_col, sort_by)
        w = src.write.partitionBy(t.partition_col).option("maxRecordsPerFile", int(max_records or 0))
        if t.bloom_col:
            w = w.option(f"parquet.bloom.filter.enabled#{t.bloom_col}", "true")
        path = f"{t.root}/data/gen={gen}"
        with unsorted_writes(df):
            w.parquet(path)
        return {v: [(gen, None)] for v in storage.list_partitions(t.spark, path, t.partition_col)}

    def commit(self, parts: dict, schema: T.StructType, facts: dict | None = None) -> int:
        """Publish; raises ``ConcurrentWriteError`` if another writer published since ``begin``.

        ``facts`` are added to those of the version before.
        """
        t, n = self.table, self.base.version + 1
        m = Manifest(n, self.operation, T.StructType([f for f in schema.fields if f.name != "gen"]),
                     {v: e for v, e in sorted(parts.items()) if e}, {**self.base.facts, **(facts or {})})
        if not storage.put_if_absent(t.spark, t._manifest_path(n), m.to_json()):
            self.abort()
            raise ConcurrentWriteError(f"version {n} of {t.root} was published by another writer")
        storage.replace_text(t.spark, f"{t.root}/_current", str(n))
        return n

    def published(self) -> bool:
        """Whether a manifest names this change's data, however its writer ended."""
        path = self.table._manifest_path(self.base.version + 1)
        return storage.exists(self.table.spark, path) and any(
            g in self.gens for e in Manifest.from_json(storage.read_text(self.table.spark, path)).parts.values() for g, _ in e)

    def abort(self) -> None:
        """Remove what was written, unless it was published."""
        if self.published():
            return
        for gen in self.gens:
            storage.delete_path(self.table.spark, f"{self.table.root}/data/gen={gen}")


def _columns_fit(base: Manifest, schema: T.StructType) -> None:
    if base.schema is None:
        return
    old, new = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (base.schema, schema))
    if old != new:
        raise ValueError(f"columns differ from those of the table: {sorted(set(old.items()) ^ set(new.items()))}")


def _joined(*parts: dict) -> dict:
    out: dict = {}
    for p in parts:
        for v, entries in p.items():
            out[v] = out.get(v, []) + list(entries)
    return out


class _Undo:
    """Removes a change's folders if the block fails in this process."""

    def __init__(self, change: Change):
        self.change = change

    def __enter__(self):
        return self.change

    def __exit__(self, kind, *_):
        if kind is not None and not issubclass(kind, ConcurrentWriteError):
            self.change.abort()


def replace_range(table: VersionedTable, staged: DataFrame, ts: str = "timestamp", start=None, end=None,
                  scope: str | None = None, max_records: int = NO_LIMIT, key: str = "project",
                  max_null_pct: float = MAX_NULL_PCT, grain: str = "day") -> int:
    """Replace ``[start, end)`` by the staged rows; returns their number (0: nothing staged, no new version).

    As ``maintain.replace_range``, with the same gate before anything is published.
    """
    if start is None or end is None:
        raise ValueError("replace_range needs both start and end")
    staged = staged.withColumn(table.partition_col, log_partition(ts, grain))
    with _Undo(table.begin("replace range")) as change:
        base = change.base
        _columns_fit(base, staged.schema)
        new = change.write(staged, max_records)
        rows = table._read(staged.schema, new).drop("gen")
        stats = rows.agg(*quality_exprs(ts, key)).first().asDict()
        if not stats.get("total_rows"):
            change.abort()
            return 0
        validate_stats(stats, "timestamp", key, max_null_pct)
        touched = {v: base.parts[v] for v in _range_dates(table.spark, start, end, grain) if v in base.parts}
        old = table._read(base.schema or staged.schema, touched).drop("gen")
        left = change.write(delete_range_scoped(old, rows, ts, start, end, scope), max_records) if touched else {}
        rest = {v: e for v, e in base.parts.items() if v not in touched}
        change.commit(_joined(rest, left, new), staged.schema)
        return int(stats["total_rows"])


def delete_range(table: VersionedTable, ts: str, start, end, grain: str = "day") -> int:
    """Delete ``[start, end)``; returns the version (the current one if no partition of the range is stored)."""
    with _Undo(table.begin("delete range")) as change:
        base = change.base
        touched = {v: base.parts[v] for v in _range_dates(table.spark, start, end, grain) if v in base.parts}
        if not touched:
            return base.version
        old = table._read(base.schema, touched).drop("gen")
        left = change.write(delete_range_scoped(old, old, ts, start, end))
        return change.commit(_joined({v: e for v, e in base.parts.items() if v not in touched}, left), base.schema)


def append(table: VersionedTable, df: DataFrame, max_records: int = NO_LIMIT) -> int:
    """Add rows to their partitions; no stored file is read. Returns the version."""
    with _Undo(table.begin("append")) as change:
        _columns_fit(change.base, df.schema)
        return change.commit(_joined(change.base.parts, change.write(df, max_records)), df.schema)


def refresh(table: VersionedTable, df: DataFrame, max_records: int = NO_LIMIT, sort_by: str | None = None) -> int:
    """Replace the whole content (and, if they differ, the columns); returns the rows. The old version stays readable."""
    with _Undo(table.begin("refresh")) as change:
        new = change.write(df, max_records, sort_by=sort_by)
        n = table._read(df.schema, new).count()
        change.commit(new, df.schema)
        return n


def replace_partitions(table: VersionedTable, df: DataFrame, values: list[str] | None = None, facts: dict | None = None,
                       operation: str = "replace partitions") -> int:
    """Replace the named partitions (None: all) by ``df``'s rows; one without rows goes. Returns the version."""
    with _Undo(table.begin(operation)) as change:
        base = change.base
        if values is not None:
            _columns_fit(base, df.schema)
        rest = {} if values is None else {v: e for v, e in base.parts.items() if v not in set(values)}
        return change.commit(_joined(rest, change.write(df)), df.schema, facts)


def changed_partitions(table: VersionedTable, since: int, until: int | None = None) -> list[str]:
    """Partition values whose content may differ between two versions (0: before the first)."""
    old, new = table.manifest(since).parts, table.manifest(until).parts
    return sorted(v for v in {*old, *new} if old.get(v) != new.get(v))


def upsert(table: VersionedTable, batch: DataFrame, key: str = "load_id", within: str | None = None,
           max_records: int = NO_LIMIT) -> int:
    """Replace rows by key; returns the batch's rows. Only files that hold a matched key are rewritten.

    The key determines the partition, and ``within`` if given (a column whose bounds
    in the batch then narrow the search, by row group statistics). A key may occur
    several times in the batch.
    """
    part = table.partition_col
    with _Undo(table.begin("upsert")) as change:
        base = change.base
        _columns_fit(base, batch.schema)
        new = change.write(batch, max_records, sort_by=within)
        if not new:
            change.abort()
            return 0
        rows = table._read(batch.schema, new).drop("gen")
        stats = rows.agg(F.count(F.lit(1)).alias("n"), *([F.min(within).alias("lo"), F.max(within).alias("hi")] if within else [])).first()
        touched = {v: base.parts[v] for v in new if v in base.parts}
        keys = rows.select(F.col(key).alias("_k"), F.col(part).alias("_p")).distinct()
        same = (F.col(key) == F.col("_k")) & F.col(part).eqNullSafe(F.col("_p"))
        old = table._read(base.schema or batch.schema, touched, with_file=True)
        if within and stats["lo"] is not None:
            old = old.where(F.col(within).between(F.lit(stats["lo"]), F.lit(stats["hi"])) | F.col(within).isNull())
        literal = [r["_k"] for r in keys.select("_k").distinct().limit(KEY_LITERALS + 1).collect()]
        if len(literal) <= KEY_LITERALS:
            old = old.where(F.col(key).isin([k for k in literal if k is not None]))
        hit = {(r["gen"], r["_file"]) for r in old.join(keys, same, "left_semi").select("gen", "_file").distinct().collect()}
        kept, matched = _split_files(table, touched, hit)
        left = {}
        if matched:
            affected = table._read(base.schema, matched).drop("gen")
            left = change.write(affected.join(keys, same, "left_anti"), max_records, sort_by=within)
        rest = {v: e for v, e in base.parts.items() if v not in touched}
        change.commit(_joined(rest, kept, left, new), batch.schema)
        return int(stats["n"])


def _split_files(table: VersionedTable, parts: dict, hit: set[tuple[str, str]]) -> tuple[dict, dict]:
    """(entries without the hit files, entries of the hit files)."""
    gens = {g for g, _ in hit}
    kept: dict = {}
    matched: dict = {}
    for value, entries in parts.items():
        for gen, files in entries:
            if gen not in gens:
                kept.setdefault(value, []).append((gen, files))
                continue
            files = files if files is not None else storage.list_data_files(table.spark, table._folder(gen, value))
            on = [f for f in files if (gen, f) in hit]
            off = [f for f in files if (gen, f) not in hit]
            if off:
                kept.setdefault(value, []).append((gen, off))
            if on:
                matched.setdefault(value, []).append((gen, on))
    return kept, matched


def write_rollup(table: VersionedTable, rollup: DataFrame, mode: str = "full", grain: str = "month") -> int:
    """Materialize the rollup into a versioned table: ``full`` or ``incremental`` (by ``load_id``)."""
    rollup = with_rollup_partition(rollup, rollup_partition_column(grain))
    if mode == "full":
        return refresh(table, rollup, sort_by=ROLLUP_DATE)
    if mode == "incremental":
        return upsert(table, rollup, within=ROLLUP_DATE)
    raise ValueError("mode must be 'full' or 'incremental'")


def rollup_table(spark: SparkSession, root: str, grain: str = "month") -> VersionedTable:
    """A versioned rollup, with Bloom filters on its key."""
    return VersionedTable(spark, root, rollup_partition_column(grain), bloom_col="load_id")


def log_table(spark: SparkSession, root: str, partition_col: str = LOG_PARTITION) -> VersionedTable:
    """A versioned raw log."""
    return VersionedTable(spark, root, partition_col)
