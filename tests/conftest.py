from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from monthline.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def now():
    return datetime(2024, 6, 15, 12, 0)


@pytest.fixture
def folder(tmp_path):
    def path(name: str) -> str:
        return str(tmp_path / name)

    return path


def rows_of(df, *columns):
    """Rows as a list of tuples, in the order they come."""
    return [tuple(row) for row in df.select(*(columns or df.columns)).collect()]


def ordered(df, *columns):
    return sorted(rows_of(df, *columns), key=lambda row: tuple((v is None, str(v)) for v in row))
