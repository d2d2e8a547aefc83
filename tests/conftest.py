import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from tablebridge.session import local_session  # noqa: E402

# Started on import: test modules build Columns at module level.
SESSION = local_session(cores=8, partitions=4, app="tests")
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
