import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stargauge.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.chdir(tempfile.mkdtemp(prefix="run-"))  # warehouse and metastore of this run
    session = local_session(4, "tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
