import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hazeline.session import build_session, clear_work

    session = build_session("tests", "8", shuffle_partitions="4", driver_memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_work(session)
    session.stop()
