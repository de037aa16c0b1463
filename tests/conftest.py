import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = os.environ.get("LEDGERLOOM_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session, ship

    session = local_session(cores=2, partitions=4, name="tests")
    ship(session)
    yield session


@pytest.fixture(scope="session")
def data():
    return DATA


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
