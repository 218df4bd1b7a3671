"""A three-row extract carried through ingest, features and encoding; expected rows derived by hand."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests_support import write_extract
from wardflow.plans.features import build_features, save_features
from wardflow.plans.ingest import ingest
from wardflow.plans.prepare import preprocess
from wardflow.schemas import FEATURES
from wardflow.sources.tables import read_features, read_tables


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("golden")
    rows = ingest(spark, write_extract(base / "raw.csv"), str(base / "tables"))
    assert rows == {"patients": 2, "encounters": 3, "diagnoses": 3, "medications": 3}
    return read_tables(spark, str(base / "tables"))


def test_patients_come_from_the_first_row_in_file_order(loaded):
    got = loaded["patients"].drop("created_at").orderBy("patient_id").collect()
    assert [tuple(r) for r in got] == [
        (1, "[10-20)", "Female", "Caucasian", 1, 1),
        (2, "[0-10)", "Unknown", "Asian", 3, 1),
    ]


def test_load_time_is_set(loaded):
    for name in ("patients", "encounters"):
        assert loaded[name].where(F.col("created_at").isNull()).count() == 0


def test_encounters(loaded):
    got = loaded["encounters"].orderBy("encounter_id").select("encounter_id", "patient_id", "encounter_date", "readmitted")
    assert [tuple(r) for r in got.collect()] == [
        (100, 1, dt.date(2020, 1, 1), True),
        (200, 1, dt.date(2020, 2, 15), False),
        (300, 2, dt.date(2020, 1, 1), False),
    ]


def test_diagnoses_are_numbered_by_patient_and_encounter(loaded):
    got = loaded["diagnoses"].orderBy("diagnosis_id").collect()
    assert [tuple(r) for r in got] == [
        (1, 100, "41", "Circulatory"),
        (2, 200, "250.83", "Diabetes"),
        (3, 300, None, "Unknown"),
    ]


def test_medications_keep_the_missing_status(loaded):
    got = loaded["medications"].orderBy("medication_id").collect()
    assert [tuple(r) for r in got] == [
        (1, 100, "metformin", False),
        (2, 200, "insulin", True),
        (3, 300, "insulin", False),
    ]


EXPECTED = [
    (100, "[10-20)", "Female", "Caucasian", 1, 1, 5, 40, 9, 7, 2, 3.5, 6.5, 40, 999, 100.0, 0, True),
    (200, "[10-20)", "Female", "Caucasian", 1, 1, 2, 10, 4, 3, 2, 3.5, 6.5, 40, 45, 0.0, 1, False),
    (300, "[0-10)", "Unknown", "Asian", 3, 1, 1, 5, 2, 1, 1, 1.0, 2.0, 5, 999, 0.0, 0, False),
]


@pytest.mark.parametrize("strategy", ["auto", "window", "join"])
def test_features(loaded, strategy):
    got = build_features(loaded, strategy).orderBy("encounter_id")
    assert got.columns == FEATURES.fieldNames()
    assert [f.dataType for f in got.schema] == [f.dataType for f in FEATURES]
    assert [tuple(r) for r in got.collect()] == EXPECTED


def test_rates_fitted_elsewhere(spark, loaded):
    rates = spark.createDataFrame([("Circulatory", 12.5)], "diagnosis_group string, readmission_rate_pct double")
    got = build_features(loaded, rates=rates).orderBy("encounter_id").select("diag_readmission_rate")
    assert [r[0] for r in got.collect()] == [12.5, 0.0, 0.0]


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_features_survive_a_round_trip(spark, loaded, tmp_path, file_format):
    path = str(tmp_path / "not" / "there" / "yet")
    assert save_features(loaded, path, file_format) == 3
    got = read_features(spark, path, file_format).orderBy("encounter_id")
    assert [tuple(r) for r in got.collect()] == EXPECTED


def test_encoding(loaded):
    matrix, encoding = preprocess(build_features(loaded))
    assert encoding.feature_names[-3:] == ["age__10-20)", "gender_Unknown", "race_Caucasian"]
    assert len(encoding.feature_names) == 16
    got = matrix.orderBy("num_lab_procedures").select(
        "readmitted", "`age__10-20)`", "gender_Unknown", "race_Caucasian"
    )
    assert [tuple(r) for r in got.collect()] == [(0, 0, 1, 0), (0, 1, 0, 1), (1, 1, 0, 1)]


def test_append_adds_rows_and_overwrite_replaces_them(spark, tmp_path):
    source, out = write_extract(tmp_path / "raw.csv"), str(tmp_path / "tables")
    ingest(spark, source, out)
    ingest(spark, source, out)
    assert read_tables(spark, out)["encounters"].count() == 3
    with pytest.raises(ValueError, match="stored already"):
        ingest(spark, source, out, mode="append")
    assert read_tables(spark, out)["encounters"].count() == 3


def test_file_order_across_many_blocks(spark, tmp_path):
    """The first row of a patient is found although the scan is cut into many blocks."""
    rows = [
        (n, n % 50, f"[{n % 10 * 10}-{n % 10 * 10 + 10})", "Female", "Asian", n % 9 + 1, 1, 1, 1, 1, 1, "NO", "41", {})
        for n in range(3000, 0, -1)
    ]
    path = write_extract(tmp_path / "raw.csv", rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 10_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        ingest(spark, path, str(tmp_path / "tables"), ids=False)
        patients = read_tables(spark, str(tmp_path / "tables"))["patients"]
        got = {r["patient_id"]: r["admission_type"] for r in patients.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    first = {}
    for row in rows:
        first.setdefault(row[1], row[5])
    assert got == first
