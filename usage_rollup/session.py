"""Session settings and the shared scratch location.

``scratch_dir`` is derived from ``spark.checkpoint.dir`` (the shared folder the
cluster names); only when that is unset (local tests) do we set one.
"""

from __future__ import annotations

import io
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: zone-free date bucketing and runtime re-plan.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


# Starting points for a large cluster (100 TB of raw log, ~1000 executors).
# Scan splits of 256 MB give ~400k map tasks over 100 TB; the rollup's partial
# aggregate shrinks each split to its distinct groups before the only large
# shuffle, which starts wide (initialPartitionNum) and is coalesced by AQE to
# ~256 MB reducer partitions, so no reducer has to spill a whole day or project.
# Skewed partitions above 5x the median (and 512 MB) are split. Rebalanced
# writes aim at ~256 MB per output file.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.task.maxFailures": "8",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "usage_rollup",
                extra: dict | None = None, profile: str = "local") -> SparkSession:
    """Session with the settings the jobs rely on; ``profile="cluster"`` adds ``CLUSTER_CONF``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only if none is named."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="usage-rollup-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_root(spark: SparkSession) -> str:
    """The configured ``spark.checkpoint.dir`` itself (not the per-application
    subfolder Spark creates under it), so state written there outlives the
    application that wrote it; falls back to ``checkpoint_root``."""
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    # set by setCheckpointDir: that adds a folder named by a UUID for each application
    root = checkpoint_root(spark).rstrip("/")
    head, _, last = root.rpartition("/")
    return head if re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", last) else root


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in workers refer to it by name. Nothing is sent where the
    workers already find it on their ``PYTHONPATH``.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    if os.path.dirname(package) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    sc = spark.sparkContext
    if getattr(sc, "_usage_rollup_shipped", False):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark, 'package')}/usage_rollup.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(packed.getvalue()))
    finally:
        out.close()
    sc.addPyFile(path.toString())
    sc._usage_rollup_shipped = True


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique directory path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/usage_rollup/{name}-{uuid.uuid4().hex}"


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme (for local assertions only)."""
    return p[5:] if p.startswith("file:") else p


__all__ = ["get_session", "ship_package", "checkpoint_root", "shared_root", "scratch_dir", "local_path", "SESSION_CONF",
           "CLUSTER_CONF"]
