"""Extracts with rows that cannot be read: set aside with their place and reason, all others load."""

from __future__ import annotations

import pytest

from tests_support import GIVEN, write_extract
from wardflow.plans import ingest
from wardflow.schemas import RAW_TYPES
from wardflow.session import table_exists
from wardflow.sources.quarantine import TooManyBadRows, read_checked_csv
from wardflow.sources.tables import read_raw_csv, read_tables

PLACES = {name: i + 1 for i, name in enumerate(RAW_TYPES)}  # after the unused first column


def spoiled(tmp_path, name="bad.csv"):
    """The three good rows, and between them one row for each fault."""
    good = (tmp_path / "good.csv", GIVEN)
    header, *lines = open(write_extract(*good)).read().splitlines()

    def with_cell(line, **cells):
        fields = line.split(",")
        for column, text in cells.items():
            fields[PLACES[column]] = text
        return ",".join(fields)

    bad = [
        with_cell(lines[0], num_medications="many"),
        with_cell(lines[0], time_in_hospital="99999999999", number_diagnoses="2.5"),
        ",".join(lines[1].split(",")[:5]),
        lines[1] + ",more",
        with_cell(lines[2], patient_nbr="99999999999999999999"),
    ]
    path = tmp_path / name
    path.write_text("\n".join([header, lines[0], *bad[:2], "", lines[1], *bad[2:], lines[2]]) + "\n")
    return str(path), str(good[0]), bad


def entries(df):
    rows = [(r["file"].rsplit("/", 1)[1], r["record"], r["column_name"], r["text"], r["reason"]) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0], r[1], r[2] or ""))


def test_each_fault_is_set_aside_with_its_place(spark, tmp_path):
    path, _, bad = spoiled(tmp_path)
    checked = read_checked_csv(spark, path)
    assert (checked.n_rows, checked.n_bad) == (8, 5) and checked.bad_share == 5 / 8
    assert entries(checked.bad) == [
        ("bad.csv", 2, "num_medications", "many", "number"),
        ("bad.csv", 3, "number_diagnoses", "2.5", "number"),
        ("bad.csv", 3, "time_in_hospital", "99999999999", "range"),
        ("bad.csv", 5, None, bad[2], "fields"),
        ("bad.csv", 6, None, bad[3], "fields"),
        ("bad.csv", 7, "patient_nbr", "99999999999999999999", "range"),
    ]


def test_good_rows_are_those_of_a_clean_extract(spark, tmp_path, same_rows):
    path, good, _ = spoiled(tmp_path)
    checked = read_checked_csv(spark, path)
    same_rows(checked.good.drop("file_order"), read_raw_csv(spark, good).drop("file_order"))
    assert checked.good.dtypes == read_raw_csv(spark, good).dtypes
    clean = read_checked_csv(spark, good)
    assert clean.n_bad == 0 and clean.bad.count() == 0


def test_missing_tokens_and_decimal_points_are_not_bad(spark, tmp_path):
    row = [*GIVEN[0]]
    row[7], row[8], row[9] = "?", "3.0", ""
    checked = read_checked_csv(spark, write_extract(tmp_path / "a.csv", [tuple(row)]))
    found = checked.good.select("time_in_hospital", "num_lab_procedures", "num_medications").first()
    assert tuple(found) == (None, 3, None) and checked.n_bad == 0


def test_records_are_numbered_through_the_blocks_of_a_file(spark, tmp_path):
    rows = [(k, k % 7, *GIVEN[0][2:]) for k in range(400)]
    path = write_extract(tmp_path / "long.csv", [(*r[:9], "x" if r[0] % 37 == 5 else 4, *r[10:]) for r in rows])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        checked = read_checked_csv(spark, [path, write_extract(tmp_path / "other.csv", GIVEN)])
        blocks = checked.good.select("file_order.file", "file_order.block").distinct().count()
        found = entries(checked.bad)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert blocks > 4
    assert [r[:2] for r in found] == [("long.csv", k + 1) for k in range(400) if k % 37 == 5]


def test_load_sets_bad_rows_aside_or_stops(spark, tmp_path):
    path, good, _ = spoiled(tmp_path)
    out, bad = str(tmp_path / "tables"), str(tmp_path / "set-aside")
    with pytest.raises(TooManyBadRows, match="5 of 8"):
        ingest.ingest(spark, path, out, quarantine=bad)
    assert spark.read.parquet(bad).count() == 6 and not table_exists(spark, f"{out}/encounters")
    with pytest.raises(Exception):
        ingest.ingest(spark, path, out)
    written = ingest.ingest(spark, path, out, quarantine=bad, max_bad_share=0.7)
    assert written == ingest.ingest(spark, good, str(tmp_path / "plain"))
    ids = lambda folder: sorted(r[0] for r in read_tables(spark, folder)["encounters"].select("encounter_id").collect())
    assert ids(out) == ids(str(tmp_path / "plain")) == [100, 200, 300]


def test_published_loads_set_bad_rows_aside(spark, tmp_path):
    """The batch is named by its good rows: the same rows without the bad ones are the same batch."""
    path, good, _ = spoiled(tmp_path)
    folder = str(tmp_path / "tables")
    state = ingest.ingest_batch(spark, path, folder, quarantine=str(tmp_path / "bad"), max_bad_share=0.7)
    assert ingest.ingest_batch(spark, good, folder) == state
