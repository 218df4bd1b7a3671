"""Several extract files, appending, quotes, and the work folder."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests_support import GIVEN, write_extract
from wardflow.operators.quality import check_tables
from wardflow.plans.explorer import execute
from wardflow.plans.features import build_features
from wardflow.plans.ingest import ingest
from wardflow.schemas import ENCOUNTERS, RAW_TYPES, TABLES, ForeignKey, TableDefinition
from wardflow.session import _is_single_machine, work_folder
from wardflow.sources.tables import read_jdbc, read_raw_csv, read_tables, save_bucketed


def write_rows(path, header, rows):
    path.write_text("\n".join([",".join(header), *[",".join(r) for r in rows]]) + "\n")


def fields(encounter, patient, **other):
    row = dict.fromkeys(RAW_TYPES, "1") | {"encounter_id": str(encounter), "patient_nbr": str(patient), "readmitted": "NO"}
    return row | {k: str(v) for k, v in other.items()}


def test_each_file_by_its_own_header(spark, tmp_path):
    names = list(RAW_TYPES)
    swapped = ["extra", *reversed(names)]
    one, two = fields(100, 7), fields(200, 8) | {"extra": "e"}
    write_rows(tmp_path / "a.csv", names, [[one[n] for n in names]])
    write_rows(tmp_path / "b.csv", swapped, [[two[n] for n in swapped]])
    (tmp_path / "c.csv").write_text("")
    raw = read_raw_csv(spark, str(tmp_path / "*.csv"))
    assert sorted((r["encounter_id"], r["patient_nbr"]) for r in raw.collect()) == [(100, 7), (200, 8)]
    write_rows(tmp_path / "d.csv", names[1:], [[one[n] for n in names[1:]]])
    with pytest.raises(ValueError, match="encounter_id"):
        read_raw_csv(spark, str(tmp_path / "*.csv"))


def test_quotes_and_whole_numbers(spark, tmp_path):
    names = list(RAW_TYPES)
    row = fields(100, "7.0", diag_1='"A ""b"", c"', time_in_hospital="3.00")
    write_rows(tmp_path / "a.csv", names, [[row[n] for n in names]])
    got = read_raw_csv(spark, str(tmp_path / "a.csv")).first()
    assert (got["patient_nbr"], got["diag_1"], got["time_in_hospital"], got["readmitted"]) == (7, 'A "b", c', 3, "NO")
    write_rows(tmp_path / "b.csv", names, [[fields(1, "7.5")[n] for n in names]])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|7.5"):
        read_raw_csv(spark, str(tmp_path / "b.csv")).collect()


def test_append_goes_on(spark, tmp_path):
    names, out = list(RAW_TYPES), str(tmp_path / "tables")
    for k, rows in enumerate([[fields(100, 7, age="[10-20)"), fields(110, 8)], [fields(200, 7, age="[90-100)"), fields(210, 9)]]):
        write_rows(tmp_path / f"{k}.csv", names, [[r[n] for n in names] for r in rows])
        ingest(spark, str(tmp_path / f"{k}.csv"), out, mode="append")
    stored = read_tables(spark, out)
    assert sorted((r["patient_id"], r["age"]) for r in stored["patients"].collect()) == [(7, "[10-20)"), (8, "1"), (9, "1")]
    dates = {r["encounter_id"]: str(r["encounter_date"]) for r in stored["encounters"].collect()}
    assert (dates[100], dates[200], dates[210]) == ("2020-01-01", "2020-02-15", "2020-01-01")
    for table, column in (("diagnoses", "diagnosis_id"), ("medications", "medication_id")):
        ids = sorted(r[column] for r in stored[table].collect())
        assert ids == list(range(1, len(ids) + 1))
    assert build_features(stored).count() == 4
    assert check_tables(stored, TABLES).where("violations > 0").count() == 0


def test_ingest_leaves_no_work_tables(spark, tmp_path):
    folder = work_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    ingest(spark, write_extract(tmp_path / "raw.csv", GIVEN), str(tmp_path / "tables"))
    assert set(os.listdir(folder)) == before


def test_masters_on_one_machine():
    assert [_is_single_machine(m) for m in ("local", "local[4]", "local[*]", "local-cluster[2,1,1024]", "spark://x")] == [True] * 3 + [False] * 2


def test_missing_key_column_is_a_violation(spark):
    names = ("patients", "encounters", "diagnoses", "medications")
    empty = {n: spark.createDataFrame([], TABLES[n].schema) for n in names}
    rows = spark.createDataFrame([(1, "E1", "Other"), (None, "x" * 11, "Other")], "encounter_id long, icd9_code string, diagnosis_group string")
    found = {(r["table_name"], r["constraint_name"]): r["violations"] for r in check_tables({**empty, "diagnoses": rows}, TABLES).collect()}
    assert len(found) == 13
    assert found["diagnoses", "primary key diagnosis_id"] == 2
    assert found["diagnoses", "foreign key encounter_id"] == 1
    assert found["diagnoses", "length of icd9_code"] == 1


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_keys_are_counted_in_their_own_type(spark):
    """Counts per key and task are all that moves, and no key becomes text. Both details of an encounter point to it,
    so its keys move once more."""
    tables = {n: spark.createDataFrame([], d.schema) for n, d in TABLES.items()}
    plan = plan_of(check_tables(tables, TABLES))
    assert "as string" not in plan
    n_keys = len(TABLES) + sum(len(d.foreign_keys) for d in TABLES.values())
    assert plan.count("Exchange hashpartitioning") <= n_keys + 1


def test_tables_stored_by_key_are_checked_in_place(spark, tmp_path):
    extra = TableDefinition("extra", ENCOUNTERS, "encounter_id", (ForeignKey("encounter_id", "encounters", "encounter_id"),))
    stays = TableDefinition("encounters", ENCOUNTERS, "encounter_id")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS checks LOCATION '{tmp_path}'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        save_bucketed(spark.range(1000).select(F.col("id").alias("encounter_id")), "checks.encounters", "encounter_id", 4)
        some = spark.range(995, 1005).select(F.col("id").alias("encounter_id"))
        save_bucketed(some.union(some.limit(1)), "checks.extra", "encounter_id", 4)
        found = check_tables({n: spark.table(f"checks.{n}") for n in ("encounters", "extra")}, {"encounters": stays, "extra": extra})
        assert "hashpartitioning" not in plan_of(found)
        assert {tuple(r) for r in found.collect()} == {
            ("encounters", "primary key encounter_id", 0), ("extra", "primary key encounter_id", 1), ("extra", "foreign key encounter_id", 5),
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE checks CASCADE")


def test_keys_of_different_types_meet(spark):
    parent = TableDefinition("encounters", ENCOUNTERS, "encounter_id")
    child = TableDefinition("extra", ENCOUNTERS, "patient_id", (ForeignKey("encounter_id", "encounters", "encounter_id"),))
    tables = {
        "encounters": spark.createDataFrame([(1,), (2,), (2,), (None,)], "encounter_id long"),
        "extra": spark.createDataFrame([(1, "1"), (2, "x"), (3, None)], "patient_id long, encounter_id string"),
    }
    found = {(r[0], r[1]): r[2] for r in check_tables(tables, {"encounters": parent, "extra": child}).collect()}
    assert found == {("encounters", "primary key encounter_id"): 2, ("extra", "primary key patient_id"): 0, ("extra", "foreign key encounter_id"): 1}


def test_explorer_reports_errors_at_run_time(spark, tmp_path):
    bad = execute(spark, "SELECT 1 / (id - 3) AS x FROM range(5)", str(tmp_path / "bad"))
    assert bad.frame is None and "DIVIDE_BY_ZERO" in bad.error
    good = execute(spark, "SELECT id FROM range(5);", str(tmp_path / "good"))
    assert good.error is None and good.row_count == 5 and good.frame.count() == 5


def test_jdbc_needs_ranges(spark):
    settings = {"DB_NAME": "d", "DB_USER": "u", "DB_PASS": "p"}
    with pytest.raises(ValueError, match="partitionColumn"):
        read_jdbc(spark, settings, "encounters")
