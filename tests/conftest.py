import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aspectflow.session import get_spark  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="aspectflow-test-")
    s = get_spark("aspectflow-tests", cpus="*", shuffle_partitions=8, driver_memory="8g",
                  checkpoint_dir=ckpt)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="aspectflow-run-")


@pytest.fixture(scope="session")
def sf001():
    return f"{TESTDATA}/sf0.001"
