"""Explicit schemas for the raw download log and the daily rollup.

The raw log is nested (``file`` and ``details`` structs); the rollup is flat.
Nothing here is inferred: readers that accept a schema get these.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The nested layout (field names and order) of the raw
# download log, as the public download table defines it.
_NAME_VERSION = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("version", T.StringType())]
)

FILE_TYPE = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)

SYSTEM_TYPE = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("release", T.StringType())]
)

DETAILS_TYPE = T.StructType(
    [
        T.StructField("installer", _NAME_VERSION),
        T.StructField("python", T.StringType()),
        T.StructField("implementation", _NAME_VERSION),
        T.StructField("distro", _NAME_VERSION),
        T.StructField("system", SYSTEM_TYPE),
        T.StructField("cpu", T.StringType()),
        T.StructField("openssl_version", T.StringType()),
        T.StructField("setuptools_version", T.StringType()),
        T.StructField("rustc_version", T.StringType()),
    ]
)

# The column list of the raw download log, in source order.
LOG_COLUMNS = [
    "timestamp",
    "country_code",
    "url",
    "project",
    "file",
    "details",
    "tls_protocol",
    "tls_cipher",
]


def log_schema(ts_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Raw log schema; ``ts_type`` lets callers keep ``timestamp_ntz`` sources."""
    return T.StructType(
        [
            T.StructField("timestamp", ts_type),
            T.StructField("country_code", T.StringType()),
            T.StructField("url", T.StringType()),
            T.StructField("project", T.StringType()),
            T.StructField("file", FILE_TYPE),
            T.StructField("details", DETAILS_TYPE),
            T.StructField("tls_protocol", T.StringType()),
            T.StructField("tls_cipher", T.StringType()),
        ]
    )


LOG_SCHEMA = log_schema()

# Grouping dimensions of the daily rollup, in key order (the order the
# surrogate key concatenates them).
ROLLUP_DIMENSIONS = [
    "download_date",
    "system_name",
    "system_release",
    "version",
    "project",
    "country_code",
    "cpu",
    "python_version",
]

ROLLUP_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("download_date", T.DateType()),
        T.StructField("system_name", T.StringType()),
        T.StructField("system_release", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("project", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("cpu", T.StringType()),
        T.StructField("python_version", T.StringType()),
        T.StructField("daily_download_sum", T.LongType(), False),
    ]
)

ROLLUP_COLUMNS = [f.name for f in ROLLUP_SCHEMA.fields]

# Flat view of the raw log used when log rows leave the library (oracle
# comparison, reports over raw rows): one column per leaf the rollup reads.
FLAT_LOG_COLUMNS = [
    "timestamp",
    "project",
    "country_code",
    "version",
    "python",
    "system_name",
    "system_release",
    "cpu",
]
