import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskframe.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    # tests run in local mode: only set a checkpoint folder when none is configured
    if not (s.sparkContext.getCheckpointDir() or s.sparkContext.getConf().get("spark.checkpoint.dir", None)):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskframe-test-ckpt-"))
    yield s


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="riskframe-test-")
