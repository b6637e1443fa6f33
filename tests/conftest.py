import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from meterline.session import checkpoint_dir, get_session

    s = get_session(
        "meterline-tests",
        master="local[4]",
        conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"},
    )
    checkpoint_dir(s)  # sets a local folder only when none is configured
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="meterline-test-")
