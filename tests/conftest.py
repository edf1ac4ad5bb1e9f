import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    ckpt = tempfile.mkdtemp(prefix="ledgerline-test-ckpt-")
    s = build_session("local[*]", "ledgerline-tests", 8, extra={
        "spark.checkpoint.dir": ckpt,
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ledgerline-test-wh-"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tests.oracle import duck as make
    return make(SF_SMALL)


@pytest.fixture()
def tmp_base(spark):
    from ledgerline.session import scratch_path
    return scratch_path(spark, "test")
