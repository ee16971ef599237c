import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tramline import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app="tramline-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
