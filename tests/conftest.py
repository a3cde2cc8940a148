import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from packflow.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=8, driver_memory="8g",
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="packflow-test-ckpt-")})
    yield s
    s.stop()
