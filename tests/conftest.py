import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from usage_rollup.session import checkpoint_root, get_session

    import tempfile

    # a fresh warehouse per test session so managed test tables never collide
    s = get_session("local[4]", 8, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="usage-rollup-wh-")})
    checkpoint_root(s)  # reads spark.checkpoint.dir; sets a local one only if unset
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from usage_rollup.session import scratch_dir

    def make(name="t"):
        return scratch_dir(spark, name)

    return make
