import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scorewatch.session import clear_scratch, get_spark  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = get_spark(
        "tests", "local[8]",
        spark__sql__shuffle__partitions="4", spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=f"file://{shared}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
