import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from roadlens.session import build_session, checkpoint_root  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    checkpoint_root(s)  # a scratch checkpoint folder only if the session names none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    if not os.path.exists(f"{SMOKE}/events.parquet"):
        pytest.skip("test data not present")
    return SMOKE
