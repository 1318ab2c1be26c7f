"""A folder of log files as a data source that plans and prunes its own partitions.

    spark.dataSource.register(LogFolder)
    spark.read.format("log_folder").load("/landing")

For landing areas whose files Spark's own readers can't prune: the source is handed the
query's filters on project and time and uses them in three places. Folders named
``project=...``, ``log_date=...`` or ``log_month=...`` that cannot match are never
listed; Parquet row groups whose statistics exclude the filter are not read; rows
are filtered before they are handed to Spark. The files left are dealt out into
partitions of about ``partition_bytes``. Spark applies the filters again, so the source only
ever has to be right about what it leaves out.

Options: ``path``; ``file_format`` (``parquet`` or ``json``, default parquet); ``ts_col`` (default
``timestamp``); ``timestamp_ntz`` (``true`` for a column without zone); ``partition_bytes``. Paths are opened
with ``pyarrow.fs``, so they must be reachable from the workers' Python; times in
folder names are UTC days. Listing happens once, when the query is planned.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)
from pyspark.sql.pandas.types import to_arrow_schema

from usage_rollup.schema import log_schema

DEFAULT_PARTITION_BYTES = 128 << 20
#: Spark setting that lets Python sources see filters.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class Files(InputPartition):
    """Paths of the files of one partition."""

    def __init__(self, paths: list[str]):
        self.paths = paths


def _utc(v) -> dt.datetime:
    v = v if isinstance(v, dt.datetime) else dt.datetime.fromisoformat(str(v))
    return v.astimezone(dt.timezone.utc).replace(tzinfo=None) if v.tzinfo else v


class Bounds:
    """What the pushed filters say about project and time (bounds inclusive, wider than the filters at most)."""

    def __init__(self):
        self.projects: set | None = None
        self.low: dt.datetime | None = None
        self.high: dt.datetime | None = None

    def add(self, f: Filter, ts_col: str) -> None:
        column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        if column == "project" and isinstance(f, (EqualTo, In)):
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.projects = values if self.projects is None else self.projects & values
        elif column == ts_col and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
            self.low = max(self.low or _utc(f.value), _utc(f.value))
        if column == ts_col and isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
            self.high = min(self.high or _utc(f.value), _utc(f.value))

    def folder_may_match(self, name: str) -> bool:
        """Whether a folder of this name can hold rows within the bounds."""
        key, _, value = name.partition("=")
        if key == "project":
            return self.projects is None or value in self.projects
        if key not in ("log_date", "log_month") or value.startswith("__"):
            return True
        first = dt.datetime.fromisoformat(value)
        after = first + dt.timedelta(days=1) if key == "log_date" else (first.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        return (self.low is None or self.low < after) and (self.high is None or self.high >= first)

    def expression(self, schema: pa.Schema, ts_col: str):
        """The same as a filter on rows; None without bounds."""
        parts = []
        if self.projects is not None:
            parts.append(ds.field("project").isin(sorted(p for p in self.projects if p is not None)))
        kind = schema.field(ts_col).type

        def at(v):
            return pa.scalar(v.replace(tzinfo=dt.timezone.utc) if kind.tz else v, kind)

        if self.low is not None:
            parts.append(ds.field(ts_col) >= at(self.low))
        if self.high is not None:
            parts.append(ds.field(ts_col) <= at(self.high))
        out = None
        for p in parts:
            out = p if out is None else out & p
        return out


class LogFolderReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.path = options["path"]
        self.format = options.get("file_format", "parquet")
        if self.format not in ("parquet", "json"):
            raise ValueError("file_format must be parquet or json")
        self.ts_col = options.get("ts_col", "timestamp")
        self.bytes = int(options.get("partition_bytes", DEFAULT_PARTITION_BYTES))
        self.schema, self.bounds = schema, Bounds()

    def pushFilters(self, filters):
        for f in filters:
            self.bounds.add(f, self.ts_col)
            yield f  # Spark evaluates each of them again

    def partitions(self) -> list[InputPartition]:
        system, root = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        found, todo = [], [root]
        while todo:
            for info in sorted(system.get_file_info(pafs.FileSelector(todo.pop())), key=lambda i: i.path):
                if info.base_name.startswith(("_", ".")):
                    continue
                if info.type == pafs.FileType.Directory:
                    if self.bounds.folder_may_match(info.base_name):
                        todo.append(info.path)
                elif info.type == pafs.FileType.File and info.size:
                    found.append((info.path, info.size))
        out, held, size = [], [], 0
        for path, n in found:
            if held and size + n > self.bytes:
                out.append(Files(held))
                held, size = [], 0
            held.append(path)
            size += n
        return out + [Files(held)] if held or not out else out

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None or not partition.paths:
            return
        system = pafs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else pafs.LocalFileSystem()
        schema = to_arrow_schema(self.schema)
        kind = ds.ParquetFileFormat(read_options=ds.ParquetReadOptions(coerce_int96_timestamp_unit="us")) if self.format == "parquet" else "json"
        files = ds.dataset(partition.paths, format=kind, schema=schema, filesystem=system)
        for b in files.to_batches(filter=self.bounds.expression(schema, self.ts_col), batch_size=8192):
            if b.num_rows:
                yield b


class LogFolder(DataSource):
    """See the module's description."""

    @classmethod
    def name(cls) -> str:
        return "log_folder"

    def schema(self) -> T.StructType:
        ntz = self.options.get("timestamp_ntz", "false").lower() == "true"
        return log_schema(T.TimestampNTZType() if ntz else T.TimestampType())

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return LogFolderReader(schema, dict(self.options))


def read_log_folder(spark: SparkSession, path: str, **options) -> DataFrame:
    """The folder as a DataFrame, with filter pushdown switched on in this session."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(LogFolder)
    return spark.read.format("log_folder").options(**{k: str(v) for k, v in options.items()}).load(path)
