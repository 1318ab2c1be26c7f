"""Thin helpers over the cluster file system (Hadoop FileSystem via the session).

Only metadata operations: existence, listing partition directories, and
removing partition directories that a range replace emptied. Works for any
Hadoop-compatible store (HDFS, object stores, local files in tests).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Directory value under which Spark stores rows whose partition value is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def has_data(spark: SparkSession, path: str) -> bool:
    """A folder that holds a data file, at any depth (stops at the first one found)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        if not it.next().getPath().getName().startswith((".", "_")):
            return True
    return False


def list_partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first-level ``column=value`` directories under ``path``."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(prefix):
            out.append(name[len(prefix):])
    return sorted(out)


def delete_partition(spark: SparkSession, path: str, column: str, value: str) -> bool:
    fs, p = _fs_and_path(spark, f"{path.rstrip('/')}/{column}={value}")
    return bool(fs.delete(p, True))


def count_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> int:
    """Number of data files under ``path`` (recursive)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return 0
    it = fs.listFiles(p, True)
    n = 0
    while it.hasNext():
        if it.next().getPath().getName().endswith(suffix):
            n += 1
    return n


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively remove a folder this library created (scratch and pending data)."""
    fs, p = _fs_and_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small UTF-8 file (a manifest) without a Spark job; overwrites.

    The file appears under its name only when complete (written aside, then renamed).
    """
    fs, p = _fs_and_path(spark, path)
    aside = p.suffix(".tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"could not rename {aside} to {p}")


def qualified(spark: SparkSession, path: str) -> str:
    """One spelling per path: scheme and authority filled in, no trailing slash."""
    fs, p = _fs_and_path(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_and_path(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Move ``src`` to ``dst`` when both live on one file system; False otherwise."""
    fs, ps = _fs_and_path(spark, src)
    fd, pd = _fs_and_path(spark, dst)
    if fs.getUri().toString() != fd.getUri().toString():
        return False
    parent = pd.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(ps, pd))


def list_names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of what lies directly in a folder, hidden entries included."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), int(s.getModificationTime())) for s in fs.listStatus(p))


def list_data_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the data files directly in a folder."""
    return [name for name, _ in list_names(spark, folder) if not name.startswith(("_", "."))]


def _move(spark: SparkSession, src: str, dst: str, overwrite: bool) -> None:
    """``FileContext.rename``: atomic where the file system's rename is."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    a, b = hadoop.Path(src), hadoop.Path(dst)
    fs = b.getFileSystem(sc._jsc.hadoopConfiguration())
    rename = getattr(hadoop, "Options$Rename")
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE if overwrite else rename.NONE
    hadoop.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration()).rename(fs.makeQualified(a), fs.makeQualified(b), how)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if another writer was first.

    It is written aside and renamed without overwriting, so it is never seen cut
    off. Needs a store whose rename fails on an existing target (HDFS does so atomically).
    """
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    write_text(spark, aside, text)
    try:
        _move(spark, aside, path, overwrite=False)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            delete_path(spark, aside)
            return False
        raise


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old or the new content."""
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    write_text(spark, aside, text)
    _move(spark, aside, path, overwrite=True)
