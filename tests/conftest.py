"""One small local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + os.pathsep + os.environ.get("PYTHONPATH", "")

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corvane.session import local_session
    from corvane.shipping import ship

    session = local_session(4, "4g", spark__sql__shuffle__partitions="4")
    ship(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    return DATA
