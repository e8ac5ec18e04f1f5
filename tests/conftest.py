import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from casebeacon.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture
def run_dir(tmp_path):
    return str(tmp_path)
