import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from caudal.session import build_session

    session = build_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g", spark__driver__host="localhost",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no benchmark tables here")
    return SF
