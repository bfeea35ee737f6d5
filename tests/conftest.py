import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pitwall.session import session
    s = session(app="pitwall-tests", master="local[4]", shuffle_partitions=8,
                conf={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
