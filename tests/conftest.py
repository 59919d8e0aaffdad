import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from telemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "8",
        "tests",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="8g",
    )
    yield session
    session.stop()
