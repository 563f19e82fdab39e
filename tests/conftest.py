import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wattspark.session import build_session

    scratch = tempfile.mkdtemp(prefix="wattspark-tests-")
    s = build_session("local[4]", app_name="wattspark-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g",
                             "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.local.dir": os.path.join(scratch, "local")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="wattspark-t-")
