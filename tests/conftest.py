from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from revmart.session import build_session

    scratch = tempfile.mkdtemp(prefix="revmart-tests-", dir="/tmp")
    s = build_session("local[4]", 4, app_name="revmart-tests", extra={
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        "spark.driver.memory": "4g",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from tools.check_oracle import duck_connect

    return duck_connect(SF_SMALL)
