"""The registered corpus queries: their SQL, and that nothing else in the library needs them."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import check
from wardflow.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, name):
    status, rows = check.compare(QUERIES[name](spark, folder), check.connect(folder), ORACLES[name])
    assert status == "ok" and rows > 0


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_nothing_else_imports_this_subpackage():
    root = Path(entry.__file__).parent
    for path in (root / "wardflow").rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "wardflow.llm" not in path.read_text()
