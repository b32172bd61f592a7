import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]

from curveloom.session import local_session  # noqa: E402
from curveloom.sources.store import scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", "8g")
    with scratch(session):
        yield session
    session.stop()
