"""Features over catalog tables hashed by patient: the same rows, and nothing is shuffled but the rates."""

from __future__ import annotations

import re
import uuid

import pytest

from test_incremental import frames, made, whole
from wardflow.plans import stored
from wardflow.schemas import TABLES


@pytest.fixture
def settings(spark):
    before = {k: spark.conf.get(k, None) for k in (stored.CO_PARTITION, "spark.sql.autoBroadcastJoinThreshold")}
    yield spark.conf
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.fixture
def saved(spark, tmp_path):
    batches = made(11, 120)
    rows = {n: [row for batch in batches for row in batch[n]] for n in TABLES}
    name = f"t{uuid.uuid4().hex}_"
    stored.store(frames(spark, rows), name, str(tmp_path / "tables"), buckets=4)
    yield name, rows
    for table in TABLES:
        spark.sql(f"DROP TABLE {name}{table}")


def exchanges(df):
    """Partitionings of the shuffles, and the joins, of the plan before it is run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (\w+partitioning\([^)]*\)|Single\w+)", plan), re.findall(r"\w+Join", plan)


def test_nothing_is_shuffled(spark, saved, settings, same_rows):
    name, rows = saved
    settings.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    settings.set(stored.CO_PARTITION, "false")
    found = stored.stored_features(spark, name)
    moved, joins = exchanges(found)
    assert moved == [] and joins.count("SortMergeJoin") == 3
    same_rows(found, whole(spark, [rows]))


@pytest.mark.parametrize("hot_rows", [1, 8, 10**6])
def test_equal_to_the_whole_build(spark, saved, same_rows, hot_rows):
    """With Spark's defaults, and with all, some or no patients taken out of their buckets."""
    name, rows = saved
    same_rows(stored.stored_features(spark, name, hot_rows), whole(spark, [rows]))


def test_rows_without_an_encounter_are_not_stored(spark, tmp_path):
    rows = {n: [row for batch in made(12, 10) for row in batch[n]] for n in TABLES}
    count = len(rows["diagnoses"])
    rows["diagnoses"].append((10**6, 10**6, "x", "Other"))
    stored.store(frames(spark, rows), "stray_", str(tmp_path / "tables"), buckets=2)
    assert spark.table("stray_diagnoses").count() == count
    assert stored.stored_features(spark, "stray_").count() > 0
