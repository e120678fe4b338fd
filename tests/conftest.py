import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lapwise.session import build_session  # noqa: E402

TESTDATA = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "lapwise-tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
