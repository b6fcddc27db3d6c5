import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from affinia.session import build_session, clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__checkpoint__dir=f"file://{shared}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


def rows(df, *columns):
    """Sorted tuples of a small result."""
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
