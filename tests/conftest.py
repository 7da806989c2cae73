import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fjord.session import get_spark

    ckpt = tmp_path_factory.mktemp("checkpoints")
    s = get_spark(master="local[4]", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": str(ckpt), "spark.driver.memory": "4g"})
    yield s
    s.stop()
