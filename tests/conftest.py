import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weekloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, app="weekloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
