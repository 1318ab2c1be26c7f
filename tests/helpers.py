"""Test helpers: nested log rows and subset comparison."""

import datetime as dt

from pyspark.sql import Row
from pyspark.testing import assertDataFrameEqual


def details(python=None, system=None, cpu=None, installer=None):
    return Row(installer=installer, python=python, implementation=None, distro=None,
               system=system, cpu=cpu, openssl_version=None, setuptools_version=None, rustc_version=None)


def log_row(ts, project="pkg", country="US", version=None, python=None, sys_name=None, sys_release=None,
            cpu=None, file_null=False, url="/p"):
    file = None if file_null else Row(filename=None, project=project, version=version, type=None)
    system = None if sys_name is None and sys_release is None else Row(name=sys_name, release=sys_release)
    if isinstance(ts, str):
        ts = dt.datetime.fromisoformat(ts)
    return (ts, country, url, project, file, details(python, system, cpu), "TLSv1.2", "cipher")


def assert_subset_equal(actual, expected_rows, cols):
    """Project ``actual`` to ``cols`` and compare order-insensitively."""
    spark = actual.sparkSession
    exp = spark.createDataFrame(expected_rows, actual.select(*cols).schema)
    assertDataFrameEqual(actual.select(*cols), exp)
