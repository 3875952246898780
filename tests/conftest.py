import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session
    scratch = tempfile.mkdtemp(prefix="starloom-test-")
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                             "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from starloom.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
