"""Log-shaped frames derived from the driver's tables.

The driver has no download log, so ``events`` and ``orders`` are mapped onto
the nested log layout (structs kept, so the rollup's nested projection is
exercised). Every mapping is a single projection over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usage_rollup.schema import DETAILS_TYPE, FILE_TYPE, FLAT_LOG_COLUMNS


def _null(t="string") -> Column:
    return F.lit(None).cast(t)


def _nested(ts: Column, project: Column, country: Column, version: Column,
            python: Column, sys_name: Column, sys_release: Column, cpu: Column) -> list[Column]:
    file_struct = F.struct(
        _null().alias("filename"), project.alias("project"), version.alias("version"), _null().alias("type")
    ).cast(FILE_TYPE)
    nv = "struct<name:string,version:string>"
    details = F.struct(
        _null(nv).alias("installer"),
        python.alias("python"),
        _null(nv).alias("implementation"),
        _null(nv).alias("distro"),
        F.struct(sys_name.alias("name"), sys_release.alias("release")).alias("system"),
        cpu.alias("cpu"),
        _null().alias("openssl_version"),
        _null().alias("setuptools_version"),
        _null().alias("rustc_version"),
    ).cast(DETAILS_TYPE)
    return [
        ts.alias("timestamp"),
        country.alias("country_code"),
        _null().alias("url"),
        project.alias("project"),
        file_struct.alias("file"),
        details.alias("details"),
        _null().alias("tls_protocol"),
        _null().alias("tls_cipher"),
    ]


def events_as_log(events: DataFrame) -> DataFrame:
    """``events`` -> nested log rows (mapping fixed in the blueprint, §7.3)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    eid, uid = F.col("event_id"), F.col("user_id")
    project = F.when(F.col("event_type").isin("click", "view"), F.lit("alpha")).otherwise(F.lit("beta"))
    country = F.when(uid % 3 == 1, F.lit("US")).when(uid % 3 == 2, F.lit("DE")).otherwise(_null())
    version = F.when(k % 23 == 0, _null()).otherwise(
        F.concat(F.lit("1."), (k % 5).cast("string"), F.lit("."), (eid % 3).cast("string"),
                 F.when(eid % 10 == 0, F.lit(".dev1")).otherwise(F.lit("")))
    )
    python = (
        F.when(k % 11 == 0, _null())
        .when(k % 13 == 0, F.lit("3"))
        .otherwise(F.concat(F.lit("3."), (k % 2 + 8).cast("string"), F.lit("."), (eid % 4).cast("string")))
    )
    sys_name = F.when(uid % 3 == 0, _null()).otherwise(F.lit("Linux"))
    sys_release = F.when(uid % 3 == 1, _null()).otherwise(F.lit("r1"))
    cpu = F.when(k % 2 == 0, F.lit("x86_64")).otherwise(_null())
    return events.select(*_nested(F.col("ts"), project, country, version, python, sys_name, sys_release, cpu))


def orders_as_log(orders: DataFrame) -> DataFrame:
    """``orders`` -> nested log rows of a third project spanning 1995-2001.

    Gives the monthly reports a long history (``events`` covers one month).
    """
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    version = F.concat(F.lit("1."), (cust % 7).cast("string"), F.lit(".0"))
    python = F.concat(F.lit("3."), (key % 6 + 7).cast("string"), F.lit(".1"))
    sys_name = F.when(F.col("o_orderpriority").startswith("1"), F.lit("Darwin")).otherwise(F.lit("Linux"))
    return orders.select(
        *_nested(F.col("o_orderdate"), F.lit("gamma"), F.col("o_orderstatus"), version, python,
                 sys_name, _null(), _null())
    )


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def download_log(spark: SparkSession, sf_dir: str, with_orders: bool = True) -> DataFrame:
    """The driver's download log: events (and orders) as nested log rows."""
    log = events_as_log(_read(spark, sf_dir, "events"))
    if with_orders:
        log = log.unionByName(orders_as_log(_read(spark, sf_dir, "orders")))
    return log


def flat_log(log: DataFrame) -> DataFrame:
    """Nested log -> flat leaves (for results leaving the library)."""
    out = log.select(
        F.col("timestamp"),
        F.col("project"),
        F.col("country_code"),
        F.col("file.version").alias("version"),
        F.col("details.python").alias("python"),
        F.col("details.system.name").alias("system_name"),
        F.col("details.system.release").alias("system_release"),
        F.col("details.cpu").alias("cpu"),
    )
    return out.select(*FLAT_LOG_COLUMNS)
