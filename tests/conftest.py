import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session
    s = get_session("local[*]", shuffle_partitions=8,
                    extra={"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster: give the session its own checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-test-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from tidemark.session import scratch_path
    return scratch_path(spark, "test")
