import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from churnwise.session import get_session
    scratch = tempfile.mkdtemp(prefix="churnwise-test-")
    s = get_session(master="local[4]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": scratch + "/ckpt", "spark.driver.memory": "4g",
                           "spark.sql.maxMetadataStringLength": "1000"})  # plans name scratch paths whole
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch_dir():
    return tempfile.mkdtemp(prefix="churnwise-scratch-")
