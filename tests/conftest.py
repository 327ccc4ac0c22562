import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sluice.config import shared_dir
    from sluice.session import local_session

    s = local_session("*", shuffle_partitions=8, app="sluice-tests")
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # sets a local folder only when spark.checkpoint.dir is unset
    yield s
    s.stop()


@pytest.fixture()
def lake(spark):
    from sluice.config import fresh_lake

    return fresh_lake(spark, "test")
