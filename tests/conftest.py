from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from wardflow.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        os.environ.get("TEST_CPUS", "8"),
        shuffle_partitions=4,
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA


def rows_of(df, *order):
    """Rows as tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)


@pytest.fixture
def same_rows():
    def check(left, right):
        assert sorted(left.columns) == sorted(right.columns)
        names = sorted(left.columns)
        assert rows_of(left, *names) == rows_of(right, *names)

    return check
