import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_session
    ckpt = tempfile.mkdtemp(prefix="quarry-test-ckpt-")
    s = get_session("local[4]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quarry-test-")
