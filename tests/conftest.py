import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wardflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def clinic(spark):
    from clinic import frames

    return frames(spark)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")
