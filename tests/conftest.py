import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from zonaria.session import build_session

    session = build_session("local[4]", 4, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
