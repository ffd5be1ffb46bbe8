import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradewind.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tradewind-test-")
    session = build_session("tradewind-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"{scratch}/checkpoints",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("input tables not present")
    return SF_DIR
