"""Raw extract -> patients, encounters, diagnoses, medications."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.values import (
    clean_gender,
    clip_text,
    diagnosis_group,
    readmitted_early,
)
from wardflow.operators.running import dense_ids
from wardflow.operators.shaping import active_drugs
from wardflow.operators.skew import HotKeys, skew_join
from wardflow.operators.visits import keep_first, synthetic_date, visit_number
from wardflow.schemas import DRUGS, RAW_TYPES
from wardflow.session import durable, table_exists, work_tables
from wardflow.sources.quarantine import TooManyBadRows, read_checked_csv
from wardflow.sources.snapshots import Snapshot, commit, read_snapshot, snapshot
from wardflow.sources.tables import FILE_ORDER, read_raw_csv, read_tables, write_table, write_tables

_SNAPSHOT = {
    "age": "age",
    "gender": "gender",
    "race": "race",
    "admission_type_id": "admission_type",
    "discharge_disposition_id": "discharge_id",
}


def patients_table(raw: DataFrame, order: str = FILE_ORDER) -> DataFrame:
    """One row per patient, taken from the patient's first row in file order."""
    cleaned = raw.withColumns({"gender": clean_gender(F.col("gender")), "age": clip_text(F.col("age"), 10)})
    first = keep_first(cleaned, "patient_nbr", [order], list(_SNAPSHOT))
    return first.withColumnsRenamed({"patient_nbr": "patient_id", **_SNAPSHOT})


def encounters_table(raw: DataFrame, hot: HotKeys | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """One row per encounter, dated by the patient's visit number in id order.

    ``earlier`` holds encounters that are stored already: a patient's visits go on after them.
    """
    numbered = visit_number(raw, "patient_nbr", "encounter_id", hot=hot)
    if earlier is not None:
        before = earlier.groupBy(F.col("patient_id").alias("patient_nbr")).agg(F.count(F.lit(1)).alias("visits_before"))
        numbered = skew_join(numbered, before, "patient_nbr", "left", hot)
        numbered = numbered.withColumn("visit_number", F.col("visit_number") + F.coalesce("visits_before", F.lit(0)))
    return numbered.select(
        "encounter_id",
        F.col("patient_nbr").alias("patient_id"),
        synthetic_date(F.col("visit_number")).alias("encounter_date"),
        F.col("time_in_hospital").alias("length_of_stay"),
        "num_lab_procedures",
        "num_medications",
        F.col("number_diagnoses").alias("num_diagnoses"),
        readmitted_early(F.col("readmitted")).alias("readmitted"),
    )


def diagnoses_table(raw: DataFrame, ids: bool = True, start: int = 0) -> DataFrame:
    """The primary diagnosis of every encounter with its group."""
    rows = raw.select(
        "patient_nbr",
        "encounter_id",
        F.col("diag_1").alias("icd9_code"),
        diagnosis_group(F.col("diag_1")).alias("diagnosis_group"),
    )
    if ids:
        rows = dense_ids(rows, "diagnosis_id", [F.col("patient_nbr"), F.col("encounter_id")], start)
    return rows.drop("patient_nbr")


def medications_table(raw: DataFrame, ids: bool = True, start: int = 0) -> DataFrame:
    """One row per drug given in an encounter, numbered drug by drug."""
    rows = active_drugs(raw, ["patient_nbr", "encounter_id"], DRUGS)
    if ids:
        drug_place = F.array_position(F.array(*[F.lit(d) for d in DRUGS]), F.col("drug_name"))
        rows = dense_ids(
            rows.withColumn("drug_place", drug_place),
            "medication_id",
            [F.col("drug_place"), F.col("patient_nbr"), F.col("encounter_id")],
            start,
        ).drop("drug_place")
    return rows.drop("patient_nbr")


def normalise(raw: DataFrame, ids: bool = True, order: str = FILE_ORDER) -> dict[str, DataFrame]:
    """The four tables of a typed raw extract, without load timestamps."""
    return {
        "patients": patients_table(raw, order),
        "encounters": encounters_table(raw),
        "diagnoses": diagnoses_table(raw, ids),
        "medications": medications_table(raw, ids),
    }


def after_stored(raw: DataFrame, stored: Mapping[str, DataFrame], ids: bool = True) -> dict[str, DataFrame]:
    """The rows that appending ``raw`` adds to the stored tables.

    A patient who is stored keeps the stored row. Visit numbers and ids go on after the
    stored ones. An encounter that is stored already raises, as a primary key would.
    """
    known = stored["encounters"].select("encounter_id")
    repeated = raw.select("encounter_id").join(known, "encounter_id", "left_semi").limit(3).collect()
    if repeated:
        raise ValueError(f"encounters are stored already, such as {[r['encounter_id'] for r in repeated]}")

    def last(table: str, column: str) -> int:
        return (stored[table].agg(F.max(column)).first()[0] or 0) if ids else 0

    known_patients = stored["patients"].select("patient_id")
    return {
        "patients": patients_table(raw).join(known_patients, "patient_id", "left_anti"),
        "encounters": encounters_table(raw, earlier=stored["encounters"]),
        "diagnoses": diagnoses_table(raw, ids, last("diagnoses", "diagnosis_id")),
        "medications": medications_table(raw, ids, last("medications", "medication_id")),
    }


def _loaded(spark: SparkSession, csv_path: str | Sequence[str], quarantine: str | None, max_bad_share: float) -> DataFrame:
    """The typed extract, stored; with ``quarantine``, its bad rows are written there."""
    if quarantine is None:
        return durable(read_raw_csv(spark, csv_path), "raw")
    checked = read_checked_csv(spark, csv_path)
    write_table(checked.bad, quarantine)
    if checked.bad_share > max_bad_share:
        raise TooManyBadRows(f"{checked.n_bad} of {checked.n_rows} rows cannot be read; see {quarantine}")
    return checked.good


def ingest(
    spark: SparkSession,
    csv_path: str | Sequence[str],
    out_dir: str,
    mode: str = "overwrite",
    ids: bool = True,
    quarantine: str | None = None,
    max_bad_share: float = 0.01,
) -> dict[str, int]:
    """Load a raw CSV extract, write the four tables as parquet folders, return the rows written.

    The cleaned scan is written once: it fixes the file order, and each of the four
    writes then reads only its own columns. ``append`` adds to tables that are there
    (see ``after_stored``) and to empty ones where there are none.

    An unreadable cell raises. With ``quarantine``, a path, rows that cannot be read are written there
    instead (see ``sources.quarantine``) and all others load; above ``max_bad_share`` the load raises
    ``TooManyBadRows`` after that and before any table is written.
    """
    with work_tables(spark):
        raw = _loaded(spark, csv_path, quarantine, max_bad_share)
        if mode == "append" and table_exists(spark, f"{out_dir}/encounters"):
            # The new rows are stored before any is appended: the tables they are derived from then change.
            tables = {n: durable(df, n) for n, df in after_stored(raw, read_tables(spark, out_dir), ids).items()}
        else:
            tables = normalise(raw, ids)
        for name in ("patients", "encounters"):
            tables[name] = tables[name].withColumn("created_at", F.current_timestamp())
        return write_tables(tables, out_dir, mode)


def batch_name(raw: DataFrame) -> str:
    """Names an extract by its rows: the same rows in other files or another order have the same name."""
    row = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in sorted(RAW_TYPES)])
    n, total = raw.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)"))).first()
    return f"rows-{n}-{total or 0}"


def ingest_batch(
    spark: SparkSession,
    csv_path: str | Sequence[str],
    folder: str,
    batch: str | None = None,
    ids: bool = True,
    quarantine: str | None = None,
    max_bad_share: float = 0.01,
) -> Snapshot:
    """Add a raw extract to the tables of ``folder`` as one published load (see ``sources.snapshots``).

    The four tables appear together or not at all. A batch that is loaded already changes nothing, so a job
    may simply be run again; without a name the batch is named by its rows. The rules are those
    of an append: a stored patient's row stays, visit numbers and ids go on, and an encounter of
    another batch raises. ``quarantine`` and ``max_bad_share`` are those of ``ingest``.
    """
    with work_tables(spark):
        raw = _loaded(spark, csv_path, quarantine, max_bad_share)
        batch = batch_name(raw) if batch is None else batch
        base = snapshot(spark, folder)
        if batch in base.batches:
            return base
        tables = after_stored(raw, read_snapshot(spark, folder, base.version), ids) if base.version else normalise(raw, ids)
        for name in ("patients", "encounters"):
            tables[name] = tables[name].withColumn("created_at", F.current_timestamp())
        return commit(spark, folder, batch, tables, base)
