"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
import check
from wardflow.catalogue.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def database(folder):
    return check.connect(folder)


UNWANTED = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")
MODELS = {"gbt_score", "gbt_score_checks", "gbt_grid", "attribution", "three_class_forest"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, folder, name):
    frame = QUERIES[name](spark, folder)
    if name not in MODELS:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not [node for node in UNWANTED if node in plan]
        assert not re.search(r"Window \[.*\n.*Sort .*\n.*Exchange SinglePartition", plan)
    status, rows = check.compare(frame, database, entry.oracle_sql().get(name))
    assert status in ("ok", "rows only"), status
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # Only corpus operators may have results that SQL cannot state.
    assert set(QUERIES) == set(ORACLES)
