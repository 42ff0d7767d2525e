import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tracelake.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("BENCH_CPUS", "8"), "tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
