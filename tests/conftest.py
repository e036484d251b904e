import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from offerloom.session import build_session, configure

    session = configure(build_session("tests", shuffle_partitions=4))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def base():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
