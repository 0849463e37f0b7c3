import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shoptrail.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shoptrail-tests",
        master="local[8]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__warehouse__dir=tmp_path_factory.mktemp("warehouse"),
        spark__checkpoint__dir=tmp_path_factory.mktemp("shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
