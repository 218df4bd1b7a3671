"""Value semantics: missing tokens, groups, flags, rounding, bands."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from wardflow.functions import numbers, values


def column(spark, kind, items, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_missing_tokens_become_null(spark):
    given = ["?", "NA", "None", "", "nan", "NULL", "ok", " NA", "no", None]
    assert column(spark, "string", given, values.null_if_missing) == [None] * 6 + ["ok", " NA", "no", None]


def test_missing_tokens_reach_every_text_column(spark):
    df = spark.createDataFrame([("?", 1, "a"), ("b", 2, "N/A")], "x string, n int, y string")
    assert [tuple(r) for r in values.normalise_missing(df).collect()] == [(None, 1, "a"), ("b", 2, None)]


def test_gender_and_width(spark):
    given = ["Unknown/Invalid", "Female", "ABCDEFGHIJKLM", None]
    assert column(spark, "string", given, values.clean_gender) == ["Unknown", "Female", "ABCDEFGHIJ", None]


@pytest.mark.parametrize(
    ("code", "group"),
    [
        ("47", "Respiratory"),
        ("470", "Respiratory"),
        ("41", "Circulatory"),
        ("V45", "Other"),
        ("E909", "Other"),
        ("25", "Other"),
        ("2500", "Diabetes"),
        ("250.83", "Diabetes"),
        ("4", "Other"),
        ("", "Other"),
        ("?", "Unknown"),
        (None, "Unknown"),
    ],
)
def test_diagnosis_group_goes_by_prefix(spark, code, group):
    assert column(spark, "string", [code], values.diagnosis_group) == [group]


def test_status_flags(spark):
    given = ["No", "Steady", "Up", "Down", None]
    assert column(spark, "string", given, values.drug_active) == [False, True, True, True, True]
    assert column(spark, "string", given, values.dose_changed) == [False, False, True, True, False]
    given = ["<30", ">30", "NO", None]
    assert column(spark, "string", given, values.readmitted_early) == [True, False, False, False]
    assert column(spark, "string", given, values.three_class_label) == [2, 1, 0, 0]


def test_safe_name():
    assert values.safe_name("age_[10-20)") == "age__10-20)"
    assert values.safe_name("a<b>[c]") == "a_b__c_"


def exact(num, den, factor, digits):
    step = Decimal(1).scaleb(-digits)
    return float((Decimal(num * factor) / Decimal(den)).quantize(step, ROUND_HALF_UP))


def test_rounding_is_exact_half_away_from_zero(spark):
    random.seed(3)
    pairs = [(1249495, 10_000_000, 100), (201, 200, 1), (0, 7, 1), (-201, 200, 1), (-1, 3, 100), (2**40, 3, 1)]
    pairs += [(random.randrange(-(10**6), 10**6), random.randrange(1, 2000), random.choice([1, 100])) for _ in range(3000)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, s bigint, n bigint, f int")
    got = {
        r["i"]: r["v"]
        for f in (1, 100)
        for r in df.where(F.col("f") == f)
        .select("i", numbers.ratio_half_up(F.col("s"), F.col("n"), factor=f).alias("v"))
        .collect()
    }
    assert got == {i: exact(s, n, f, 2) for i, (s, n, f) in enumerate(pairs)}
    assert got[0] == 12.49 and got[1] == 1.01 and got[3] == -1.01


def test_rounding_without_rows_is_null(spark):
    df = spark.createDataFrame([(0, 0)], "s bigint, n bigint")
    assert df.select(numbers.rate_percent(F.col("s"), F.col("n"))).first()[0] is None


def test_risk_bands_are_strict(spark):
    given = [90.0, 50.000001, 50.0, 20.5, 20.0, 0.0, None]
    assert column(spark, "double", given, numbers.risk_band) == [
        "HIGH", "HIGH", "MODERATE", "MODERATE", "LOW", "LOW", None,
    ]


def test_percent_text_rounds_the_binary_value(spark):
    random.seed(5)
    given = [0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 12.35, 12.25, 12.75, 99.95, 99.949999999999, 100.0, 1e-9]
    given += [k / 20 for k in range(0, 2001)] + [random.random() * 100 for _ in range(5000)]
    assert column(spark, "double", given, numbers.percent_text) == [f"{v:.1f}%" for v in given]
