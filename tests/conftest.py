import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rosterflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
        spark__sql__shuffle__partitions="3",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, nulls first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        key = lambda row: [(v is not None, str(type(v)), v) for v in row]
        return sorted((tuple(r) for r in picked.collect()), key=key)

    return collect
