import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from titlepulse.session import local_session

    s = local_session(4, shuffle_partitions=8, app="titlepulse-tests")
    # Tests only: no spark.checkpoint.dir is configured here, so name one.
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
