"""What the physical plans must look like at scale, with broadcasts by size switched off."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from wardflow.catalogue import views
from wardflow.operators import rates, visits
from wardflow.operators.skew import HotKeys, hot_keys
from wardflow.plans.features import build_features


@pytest.fixture
def no_small_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    """The four tables as files, so that plans show the engine's work and not the views'."""
    base = str(tmp_path_factory.mktemp("stored"))
    for name, df in views.tables(spark, folder).items():
        df.write.parquet(f"{base}/{name}")
    return {n: spark.read.parquet(f"{base}/{n}") for n in ("patients", "encounters", "diagnoses", "medications")}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_strategy_moves_each_table_once(no_small_joins, stored):
    plan = plan_of(build_features(stored, "window"))
    assert plan.count("Exchange hashpartitioning(patient_id") == 2  # encounters and patients
    assert plan.count("Exchange hashpartitioning(encounter_id") == 3  # their join, diagnoses, medication flags
    assert plan.count("Window [") == 1
    assert plan.count("BroadcastHashJoin") == 1  # the rates, checked to be small
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_hot_patients_have_no_row_window(no_small_joins, stored):
    hot = HotKeys("patient_id", (1, 2))
    plan = plan_of(build_features(stored, "join", hot_patients=hot))
    window = plan[plan.index("Window [") :].splitlines()[0]
    assert "lag(encounter_date" in window and "encounter_id" not in window  # over days, not over visits
    assert "keys=[patient_id" in plan and "partial_min(encounter_id" in plan  # combined before the shuffle


def test_rows_of_hot_encounters_come_from_their_patients_only(no_small_joins, stored):
    hot = HotKeys("encounter_id", (3, 5))
    owners = [str(r["patient_id"]) for r in hot.keep(stored["encounters"]).select("patient_id").collect()]
    plan = plan_of(build_features(stored, hot_patients=HotKeys("patient_id"), hot_encounters=hot))
    windows = plan.split("Window [")[1:]
    assert len(windows) == 2  # all patients once, the owners of hot encounters once more
    found = re.findall(r"Filter .*patient_id#\d+L IN \(([\d,]+)\)", windows[1] + windows[0])
    assert any(sorted(ids.split(",")) == sorted(owners) for ids in found)


def test_scans_read_only_what_they_need(no_small_joins, stored):
    plan = plan_of(rates.diagnosis_rates(stored["encounters"], stored["diagnoses"], HotKeys("encounter_id")))
    assert "ReadSchema: struct<encounter_id:bigint,readmitted:boolean>" in plan
    assert "ReadSchema: struct<encounter_id:bigint,diagnosis_group:string>" in plan


def test_point_lookup_is_pushed_to_the_scan(stored):
    found = visits.previous_visit(stored["encounters"], hot=HotKeys("patient_id")).where("patient_id = 7")
    assert "EqualTo(patient_id,7)" in plan_of(found)


def test_hot_keys_are_filtered_at_the_scan(no_small_joins, stored):
    plain = plan_of(rates.with_history(stored["encounters"], hot=HotKeys("patient_id")))
    assert plain.count("Exchange") == 1 and plain.count("FileScan") == 1
    plan = plan_of(rates.with_history(stored["encounters"], hot=HotKeys("patient_id", (3, 5))))
    assert "PushedFilters: [In(patient_id, [3,5])" in plan
    assert "PushedFilters: [Or(Not(In(patient_id, [3,5])),IsNull(patient_id))" in plan


@pytest.mark.parametrize("name", ["surrogate_keys", "ingest_diagnoses", "ingest_medications"])
def test_dense_ids_come_from_stored_ranges(spark, folder, name):
    """After the one shuffle into ranges, ids need neither a window nor a sort."""
    plan = plan_of(entry.queries()[name](spark, folder))
    assert "Window [" not in plan and "Sort " not in plan and "Exchange hashpartitioning" not in plan
    assert "row_index" in plan


def test_hot_keys_are_counted_without_a_single_reducer(stored, monkeypatch, spark):
    seen = []
    kind = type(stored["encounters"])
    monkeypatch.setattr(kind, "toArrow", lambda df, f=kind.toArrow: (seen.append(plan_of(df)), f(df))[1])
    found = hot_keys(stored["encounters"], "patient_id", min_rows=2)
    counts = {r["patient_id"]: r["count"] for r in stored["encounters"].groupBy("patient_id").count().collect()}
    assert set(found.values) == {k for k, n in counts.items() if n >= 2}
    assert seen and all("SinglePartition" not in plan and "partial_count" in plan for plan in seen)


@pytest.mark.parametrize("name", ["pr_curve", "roc_auc"])
def test_positions_in_a_whole_table_are_found_range_by_range(spark, folder, name):
    plan = plan_of(entry.queries()[name](spark, folder))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__range" in line for line in windows)


def test_trend_counts_per_patient_and_month_before_the_join(no_small_joins, stored):
    plan = plan_of(rates.admission_trend(stored["encounters"], stored["patients"]))
    assert plan.index("SortMergeJoin") < plan.index("partial_count(1)")
