import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("FUNDLENS_DRIVER_MEMORY", "4g")

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fundlens.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=8, app="fundlens-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="fundlens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="fundlens-test-")
