"""Hot keys: the skew-aware paths must give the rows of the plain ones."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.operators import rates, visits
from wardflow.operators.running import dense_ids, running, unique_ids
from wardflow.operators.skew import HotKeys, hot_keys, lookup_join, skew_join, small_table
from wardflow.plans.features import build_features


@pytest.fixture(scope="module")
def hospital(spark):
    """One patient and one encounter hold a third of their tables; dates repeat; some keys are null."""
    random.seed(11)
    encounters = []
    for n in range(3000):
        patient = 7 if n % 3 == 0 else None if n % 50 == 1 else random.randrange(100, 900)
        day = None if n % 97 == 0 else dt.date(2021, 1, 1) + dt.timedelta(days=random.randrange(60))
        encounters.append((n, patient, day, n % 9 + 1, n % 31, n % 17, n % 5, n % 4 == 0))
    patients = [(p, f"[{p % 10}0-)", "Female", None if p % 6 == 0 else "Asian", p % 3, p % 5) for p in [7, *range(100, 850)]]
    diagnoses, medications = [], []
    for n in range(6000):
        encounter = 42 if n % 3 == 0 else random.randrange(0, 2900)
        diagnoses.append((n, encounter, "x", random.choice(["Diabetes", "Other", "Circulatory"])))
        medications.append((n, encounter if n % 2 else 43, "insulin", n % 11 == 0))
    return {
        "encounters": spark.createDataFrame(
            encounters,
            "encounter_id bigint, patient_id bigint, encounter_date date, length_of_stay int, "
            "num_lab_procedures int, num_medications int, num_diagnoses int, readmitted boolean",
        ),
        "patients": spark.createDataFrame(
            patients,
            "patient_id bigint, age string, gender string, race string, admission_type int, discharge_id int",
        ),
        "diagnoses": spark.createDataFrame(
            diagnoses, "diagnosis_id bigint, encounter_id bigint, icd9_code string, diagnosis_group string"
        ),
        "medications": spark.createDataFrame(
            medications, "medication_id bigint, encounter_id bigint, drug_name string, dosage_change boolean"
        ),
    }


def test_hot_keys_are_found(spark, hospital):
    assert hot_keys(hospital["encounters"], "patient_id", min_rows=500) == HotKeys("patient_id", (7,))
    assert not hot_keys(hospital["encounters"], "patient_id")
    nulls = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    assert hot_keys(nulls, "k", min_rows=500) == HotKeys("k", (), True)
    texts = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("hot").alias("k"))
    assert hot_keys(texts, "k", min_rows=500).values == ("hot",)


def test_keep_and_drop_share_out_all_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k bigint")
    for hot, kept in [
        (HotKeys("k", (1,)), [1]),
        (HotKeys("k", (1,), True), [1, None]),
        (HotKeys("k", (), True), [None]),
        (HotKeys("k"), []),
    ]:
        assert [r[0] for r in hot.keep(df).collect()] == kept
        assert [r[0] for r in hot.drop(df).collect()] == [k for k in (1, 2, None) if k not in kept]


@pytest.mark.parametrize("how", ["inner", "left", "right"])
@pytest.mark.parametrize("hot", [HotKeys("k"), HotKeys("k", (1,)), HotKeys("k", (1,), True), HotKeys("k", (1, 3))])
def test_skew_join_equals_join(spark, same_rows, how, hot):
    many = spark.createDataFrame(
        [(1 if n % 3 == 0 else None if n % 7 == 1 else n % 20, n) for n in range(300)], "k bigint, v int"
    )
    one = spark.createDataFrame([(k, f"r{k}") for k in [1, 3, 4, 5, 30, 31, None]], "k bigint, w string")
    same_rows(skew_join(many, one, "k", how, hot), many.join(one, "k", how))


def test_small_table_checks_the_size(spark, same_rows):
    df = spark.range(50).select("id", (F.col("id") * 2).alias("twice"))
    assert small_table(df, 49) is None
    same_rows(small_table(df, 50), df)
    facts = spark.range(200).select((F.col("id") % 60).alias("id"))
    for limit in (10, 1000):
        same_rows(lookup_join(facts, df, "id", limit), facts.join(df, "id", "left"))


def hot_of(hospital):
    return {
        "hot_patients": hot_keys(hospital["encounters"], "patient_id", 500),
        "hot_encounters": hot_keys(hospital["diagnoses"], "encounter_id", 500),
    }


@pytest.mark.parametrize("strategy", ["auto", "join"])
def test_features_with_hot_keys_equal_the_plain_plan(hospital, same_rows, strategy):
    hot = hot_of(hospital)
    assert hot["hot_patients"].values == (7,) and hot["hot_encounters"].values == (42,)
    plain = build_features(
        hospital, "window", hot_patients=HotKeys("patient_id"), hot_encounters=HotKeys("encounter_id")
    )
    same_rows(build_features(hospital, strategy, **hot), plain)


def test_features_by_brute_force(hospital):
    """The whole feature table recomputed in plain Python."""
    enc = [r.asDict() for r in hospital["encounters"].collect()]
    patients = {r["patient_id"]: r.asDict() for r in hospital["patients"].collect()}
    by_id = {e["encounter_id"]: e for e in enc}
    groups, of_encounter, flags = {}, {}, {}
    for d in hospital["diagnoses"].collect():
        of_encounter.setdefault(d["encounter_id"], []).append(d["diagnosis_group"])
        if d["encounter_id"] in by_id:
            groups.setdefault(d["diagnosis_group"], []).append(by_id[d["encounter_id"]]["readmitted"])
    for m in hospital["medications"].collect():
        flags[m["encounter_id"]] = max(flags.get(m["encounter_id"], 0), int(m["dosage_change"]))
    visits_of = {}
    for e in enc:
        visits_of.setdefault(e["patient_id"], []).append(e)
    expected = []
    for patient, rows in visits_of.items():
        if patient not in patients:
            continue
        rows.sort(key=lambda e: (e["encounter_date"] is None, e["encounter_date"] or dt.date.min, e["encounter_id"]))
        before = None
        for e in rows:
            day = e["encounter_date"]
            gap = (day - before).days if day and before else 999
            before = day
            n = len(rows)
            for group in of_encounter.get(e["encounter_id"], [None]):
                hits = groups.get(group)
                rate = int((20000 * sum(hits) + len(hits)) // (2 * len(hits))) / 100 if hits else 0.0
                stay, meds = (sum(r[c] for r in rows) for c in ("length_of_stay", "num_medications"))
                expected.append(
                    (e["encounter_id"], patients[patient]["race"], n, (200 * stay + n) // (2 * n) / 100,
                     (200 * meds + n) // (2 * n) / 100, max(r["num_lab_procedures"] for r in rows), gap, rate,
                     flags.get(e["encounter_id"], 0))
                )
    got = build_features(hospital, "auto", **hot_of(hospital)).select(
        "encounter_id", "race", "total_prior_visits", "avg_stay_days", "avg_medications", "max_lab_procedures",
        "days_since_last_visit", "diag_readmission_rate", "medication_change_flag",
    )
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, expected))


def test_previous_visit_of_hot_patients(hospital, same_rows):
    encounters = hospital["encounters"]
    plain = visits.previous_visit(encounters, hot=HotKeys("patient_id"))
    for hot in (HotKeys("patient_id", (7,)), HotKeys("patient_id", (7, 200), True)):
        same_rows(visits.previous_visit(encounters, hot=hot), plain)


def test_visit_number_of_hot_patients(hospital, same_rows):
    rows = hospital["encounters"].select("patient_id", "encounter_id")
    plain = visits.visit_number(rows, "patient_id", "encounter_id", hot=HotKeys("patient_id"))
    hot = HotKeys("patient_id", (7, 101, 102, 103))
    same_rows(visits.visit_number(rows, "patient_id", "encounter_id", hot=hot), plain)


def test_rates_and_history_with_hot_keys(hospital, same_rows):
    e, d = hospital["encounters"], hospital["diagnoses"]
    same_rows(
        rates.diagnosis_rates(e, d, HotKeys("encounter_id", (42,))), rates.diagnosis_rates(e, d, HotKeys("encounter_id"))
    )
    same_rows(
        rates.with_history(e, hot=HotKeys("patient_id", (7,))), rates.with_history(e, hot=HotKeys("patient_id"))
    )
    for rounded in (True, False):
        joined = e.join(rates.patient_history(e, rounded), "patient_id", "left")
        for hot in (HotKeys("patient_id"), HotKeys("patient_id", (7,), True)):
            same_rows(rates.with_history(e, rounded, hot), joined)


@pytest.mark.parametrize("partitions", [1, 3, 16, None])
def test_running_equals_a_window(spark, hospital, same_rows, partitions):
    """Hot and null groups cross range borders; other groups are far smaller than a range."""
    df = hospital["encounters"].select("patient_id", "encounter_id", "length_of_stay")
    got = running(
        df, [F.col("encounter_id").desc()], group=["patient_id"], sums=["length_of_stay"], partitions=partitions
    )
    window = Window.partitionBy("patient_id").orderBy(F.col("encounter_id").desc())
    wanted = df.select(
        "*",
        F.row_number().over(window).cast("bigint").alias("position"),
        F.sum("length_of_stay").over(window).alias("cum_length_of_stay"),
    )
    same_rows(got, wanted)


def test_dense_and_unique_ids(hospital):
    rows = hospital["diagnoses"].select("encounter_id", "icd9_code", F.col("diagnosis_id").alias("d"))
    got = dense_ids(rows, "id", [F.col("encounter_id"), F.col("d")]).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, len(got) + 1))
    assert [(r["encounter_id"], r["d"]) for r in got] == sorted((r["encounter_id"], r["d"]) for r in got)
    ids = unique_ids(rows, "id")
    assert ids.select("id").distinct().count() == rows.count()


def test_empty_input(spark):
    empty = spark.createDataFrame([], "k bigint, v bigint")
    assert running(empty, [F.col("v")], group=["k"], sums=["v"]).count() == 0
    assert running(empty, [F.col("v")]).count() == 0
