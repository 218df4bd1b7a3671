"""Medians, categories, melt, alignment, profiles, constraints."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from wardflow.operators import quality, shaping, visits
from wardflow.plans.prepare import Encoding, fit_encoding, scoring_inputs
from wardflow.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TABLES


def test_median_of_an_even_count_is_the_middle(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "v int")
    assert shaping.medians(df, ["v"]) == {"v": 2.5}
    assert sorted(r["v"] for r in shaping.fill_medians(df, ["v"]).collect()) == [1, 2, 2.5, 3, 10]


ODD = [
    0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
    float("inf"), float("-inf"), 0.1, -0.1, 3.0, 8.0, 7.999999999999999, 8.000000000000002, 2.0**1023, 2.0**-1022, 1e300, 1e-300,
]


def test_ordered_bits_of_odd_numbers():
    """Every power of two and its neighbours, and the ends of the range."""
    rng = random.Random(4)
    values = [*ODD]
    for e in range(-1074, 1024):
        power = 2.0**e
        values += [power, float(np.nextafter(power, 0)), float(np.nextafter(power, np.inf)), -power]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-320, 308) for _ in range(2000)]
    bits = shaping.ordered_bits(np.array(values))
    assert [shaping.from_bits(b) for b in bits.tolist()] == values
    order = np.argsort(bits, kind="stable")
    assert [values[i] for i in order] == sorted(values)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 21, 22])
def test_medians_of_odd_numbers(spark, n):
    rng = random.Random(n)
    for _ in range(3):
        values = rng.sample(ODD, n)
        rows = [(v, float("nan")) for v in values] + [(None, float("nan")), (float("nan"), None)]
        found = shaping.medians(spark.createDataFrame(rows, "v double, w double"), ["v", "w"])
        low, high = sorted(values)[(n - 1) // 2], sorted(values)[n // 2]
        assert found["w"] is None
        assert found["v"] == (low + high) / 2 or np.isnan((low + high) / 2) and np.isnan(found["v"])


def test_medians_sort_nothing(spark, monkeypatch):
    """Only counts move: no exchange by range and no sort in any pass."""
    plans, arrow = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or arrow(self))
    rng = random.Random(9)
    values = [rng.random() for _ in range(1001)]
    found = shaping.medians(spark.createDataFrame([(v,) for v in values], "v double").repartition(3), ["v"])
    assert found["v"] == sorted(values)[500]
    assert 1 < len(plans) <= len(shaping.DIGITS)
    assert not any("rangepartitioning" in p or "Sort " in p for p in plans)


def test_medians_by_brute_force(spark):
    """A column with a hot value, one of distinct doubles, one with many nulls, one empty, one constant."""
    random.seed(2)
    rows = [
        (7 if i % 3 == 0 else random.randrange(20), random.random() - 0.5, None if i % 4 else i, None, 5)
        for i in range(1000)
    ]
    df = spark.createDataFrame(rows, "hot int, noise double, gaps bigint, none double, same int")
    wanted = {}
    for i, name in enumerate(df.columns):
        values = [r[i] for r in rows if r[i] is not None]
        wanted[name] = float(np.median(values)) if values else None
    assert shaping.medians(df, df.columns) == wanted
    assert shaping.medians(df.limit(999), ["hot"])["hot"] == float(np.median([r[0] for r in rows[:999]]))


def test_melt_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "No", None), (2, "Up", "Steady")], "id int, a string, b string")
    got = shaping.active_drugs(df, ["id"], ["a", "b"]).collect()
    assert sorted(map(tuple, got)) == [(1, "b", False), (2, "a", True), (2, "b", False)]


def test_a_boolean_is_not_a_number(spark):
    df = spark.createDataFrame([(1, 1.0, True, "x")], "i int, d double, readmitted boolean, s string")
    assert shaping.numeric_columns(df) == ["i", "d"]
    assert shaping.other_columns(df) == ["readmitted", "s"]
    assert shaping.other_columns(df, exclude=["readmitted"]) == ["s"]


def test_unseen_categories_get_zero(spark):
    train = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "race string, n int")
    encoding = fit_encoding(train, numeric=["n"], categorical=["race"])
    assert encoding.feature_names == ["n", "race_a", "race_b"]  # 'Unknown' sorts first and is dropped
    new = spark.createDataFrame([("Other", None), ("b", 9)], "race string, n int")
    assert [tuple(r) for r in encoding.encode(new).collect()] == [(2.0, 0.0, 0.0), (9.0, 0.0, 1.0)]


def test_category_text_is_quoted(spark):
    odd = ["a", "it's", "back\\slash", "[10-20)", 'q"q']
    df = spark.createDataFrame([(v,) for v in odd], "age string")
    encoding = Encoding({}, shaping.categories(df, ["age"]))
    total = sum(sum(r) for r in encoding.encode(df).collect())
    assert total == len(odd) - 1


def test_too_many_categories_raise(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="categories"):
        shaping.categories(df, ["c"], max_categories=20)


def test_scoring_inputs_get_defaults(spark):
    df = spark.createDataFrame([(1, 3, "Male")], "encounter_id bigint, length_of_stay int, gender string")
    got = scoring_inputs(df, ["encounter_id"])
    assert got.columns == ["encounter_id", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    row = got.first()
    assert row["length_of_stay"] == 3 and row["gender"] == "Male"
    assert row["days_since_last_visit"] == 999 and row["diag_readmission_rate"] == 0.0 and row["race"] == "Unknown"
    assert row["num_diagnoses"] == 0


def test_profile_and_shares(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    got = {r["column_name"]: (r["n_missing"], r["missing_pct"]) for r in shaping.missing_profile(df).collect()}
    assert got == {"a": (1, 33.33), "b": (2, 66.67)}
    shares = {r["a"]: r["share"] for r in shaping.value_shares(df, "a").collect()}
    assert shares == {1: 0.5, 2: 0.5}
    labels = spark.createDataFrame([(True,), (False,), (False,)], "y boolean")
    assert shaping.class_ratio(labels, "y").first()[0] == 2.0
    assert shaping.class_ratio(labels.where("not y"), "y").first()[0] is None


def test_constraints(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert sorted(map(repr, map(tuple, quality.primary_key_violations(df, "k").collect()))) == ["(1, 2)", "(None, 1)"]
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    assert [tuple(r) for r in quality.foreign_key_violations(child, "k", df, "k").collect()] == [(9, 2)]
    texts = spark.createDataFrame([(1, "abcdef", "ok"), (2, "é" * 3, None)], "id int, t string, u string")
    assert [tuple(r) for r in quality.length_violations(texts, "id", {"t": 3, "u": 1}).collect()] == [
        (1, "t", 6), (1, "u", 2),
    ]


def test_check_tables_counts_every_constraint(spark):
    tables = {
        "patients": spark.createDataFrame([(1, "[0-10)", "x" * 11, "y")], "patient_id long, age string, gender string, race string"),
        "encounters": spark.createDataFrame([(1, 1), (1, 5)], "encounter_id long, patient_id long"),
        "diagnoses": spark.createDataFrame([(1, 1, "250", "Diabetes")], "diagnosis_id long, encounter_id long, icd9_code string, diagnosis_group string"),
        "medications": spark.createDataFrame([(1, 3, "insulin")], "medication_id long, encounter_id long, drug_name string"),
    }
    got = {(r["table_name"], r["constraint_name"]): r["violations"] for r in quality.check_tables(tables, TABLES).collect()}
    bad = {k: v for k, v in got.items() if v}
    assert bad == {
        ("patients", "length of gender"): 1,
        ("encounters", "primary key encounter_id"): 1,
        ("encounters", "foreign key patient_id"): 1,
        ("medications", "foreign key encounter_id"): 1,
    }
    assert len(got) == 13


def test_failed_rules(spark):
    good = {
        "age": "[70-80)", "gender": "Male", "race": "Asian", "admission_type": 1, "discharge_id": 1,
        "length_of_stay": 3, "num_lab_procedures": 40, "num_medications": 15, "num_diagnoses": 5,
        "total_prior_visits": 0, "days_since_last_visit": 0, "avg_stay_days": 0.0, "avg_medications": 0.0,
        "max_lab_procedures": 0, "diag_readmission_rate": 100.0, "medication_change_flag": 1,
    }
    bad = good | {"age": "75", "race": None, "length_of_stay": 0, "diag_readmission_rate": 100.5, "medication_change_flag": 2}
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'int'}" for k, v in good.items())
    df = spark.createDataFrame([tuple(good.values()), tuple(bad.values())], schema)
    assert [r[0] for r in quality.failed_rules(df).select("failed_rules").collect()] == [
        [], ["age", "diag_readmission_rate", "length_of_stay", "medication_change_flag", "race"],
    ]


def test_gap_limits(spark):
    df = spark.createDataFrame([(30,), (31,), (None,)], "gap int")
    assert [r[0] for r in df.select(visits.within_30_days(F.col("gap"))).collect()] == [True, False, False]


def test_keep_first_follows_the_given_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, None), (2, 5, "x")], "k int, o int, v string").repartition(3)
    got = visits.keep_first(df, "k", ["o"], ["v"])
    assert sorted(map(tuple, got.collect())) == [(1, None), (2, "x")]
