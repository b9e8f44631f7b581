import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lendmart.session import local_session, tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = tune(local_session(8, spark__sql__shuffle__partitions="4"))
    yield session
    session.stop()
