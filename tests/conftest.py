import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from tarazi.session import local_session

    s = local_session(cores=4, partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def folder():
    path = DATA / "sf0.001"
    if not path.exists():
        pytest.skip("no test data here")
    return str(path)
