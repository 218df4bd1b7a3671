"""One 18-column feature row per encounter and diagnosis."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.operators.rates import (
    HISTORY_COLUMNS,
    diagnosis_rates,
    history_over,
    medication_flags,
    patient_history,
)
from wardflow.operators.skew import HotKeys, hot_keys, lookup_join, skew_join
from wardflow.operators.visits import (
    NO_PREVIOUS_VISIT,
    gap_days,
    previous_by_day,
    visit_window,
)
from wardflow.schemas import FEATURES
from wardflow.sources.tables import write_counted

PREVIOUS = "prev_encounter_date"


def _by_window(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Snapshot, history and previous visit over one exchange on patient_id.

    The whole-patient frame uses the ordered window of the previous visit, so both
    share one sort and one window operator, and the join reuses that partitioning.
    """
    visits = visit_window()
    patient = visits.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    previous = {PREVIOUS: F.lag("encounter_date").over(visits)}
    return history_over(encounters, patient, **previous).join(patients, "patient_id")


def _by_aggregate(encounters: DataFrame, patients: DataFrame, hot: HotKeys) -> DataFrame:
    """The same columns without any window over a patient's rows; safe for hot patients."""
    per_patient = patients.join(patient_history(encounters), "patient_id")
    dated = previous_by_day(encounters, PREVIOUS)
    return skew_join(dated, per_patient, "patient_id", hot=hot)


def with_patient(
    encounters: DataFrame, patients: DataFrame, strategy: str, hot: HotKeys | None
) -> DataFrame:
    encounters = encounters.where(F.col("patient_id").isNotNull())  # the inner join drops these
    if strategy == "window":
        return _by_window(encounters, patients)
    if strategy == "join":
        return _by_aggregate(encounters, patients, hot)
    if not hot:
        return _by_window(encounters, patients)
    ordinary = _by_window(hot.drop(encounters), hot.drop(patients))
    heavy = _by_aggregate(hot.keep(encounters), hot.keep(patients), hot)
    return ordinary.unionByName(heavy)


def finished(rows: DataFrame) -> DataFrame:
    """The feature columns of joined rows, with their defaults and types."""
    gap = gap_days(F.col("encounter_date"), F.col(PREVIOUS))
    derived = {
        **{name: F.coalesce(F.col(name), F.lit(0)) for name in HISTORY_COLUMNS},
        "days_since_last_visit": F.coalesce(gap, F.lit(NO_PREVIOUS_VISIT)),
        "diag_readmission_rate": F.coalesce(F.col("readmission_rate_pct"), F.lit(0.0)),
        "medication_change_flag": F.coalesce(F.col("med_change_flag"), F.lit(0)),
    }
    return rows.select(
        *[derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in FEATURES.fields]
    )


def build_features(
    tables: Mapping[str, DataFrame],
    strategy: str = "auto",
    rates: DataFrame | None = None,
    hot_patients: HotKeys | None = None,
    hot_encounters: HotKeys | None = None,
) -> DataFrame:
    """The feature table from patients, encounters, diagnoses and medications.

    ``strategy`` says how patient history and the previous visit are found:
    ``window`` in one pass over each patient's rows, ``join`` by aggregates, and
    ``auto`` (default) by aggregates for hot patients and by window for the rest.
    ``rates`` takes diagnosis rates fitted elsewhere, such as on a training split.

    ``total_prior_visits`` counts all visits of the patient, and the rate uses the
    label of every encounter; both keep the established meaning of these columns.
    """
    if strategy not in ("auto", "window", "join"):
        raise ValueError(f"unknown strategy {strategy!r}")
    encounters = tables["encounters"].drop("created_at")
    patients = tables["patients"].drop("created_at")
    diagnoses = tables["diagnoses"].select("encounter_id", "diagnosis_group")
    if hot_encounters is None:
        hot_encounters = hot_keys(diagnoses, "encounter_id")
    if rates is None:
        rates = diagnosis_rates(encounters, diagnoses, hot_encounters)

    if hot_patients is None and strategy != "window":
        hot_patients = hot_keys(encounters, "patient_id")
    flags = medication_flags(tables["medications"])

    def one_row_each(some: DataFrame) -> DataFrame:
        return with_patient(some, patients, strategy, hot_patients).join(flags, "encounter_id", "left")

    hot_rows = None
    if hot_encounters:
        # Their patients, no more than hot encounters, are enough to compute their rows.
        owners = hot_encounters.keep(encounters).select("patient_id").collect()
        owners = [row["patient_id"] for row in owners if row["patient_id"] is not None]
        hot_rows = one_row_each(encounters.where(F.col("patient_id").isin(owners)))
    rows = skew_join(
        diagnoses, one_row_each(encounters), "encounter_id", "right", hot_encounters, hot_rows
    )
    rows = lookup_join(rows, rates.select("diagnosis_group", "readmission_rate_pct"), "diagnosis_group")
    return finished(rows)


def save_features(
    tables: Mapping[str, DataFrame], path: str, file_format: str = "parquet", **options
) -> int:
    """Build the feature table, write it as parquet, or as CSV for export; returns the rows written."""
    return write_counted(build_features(tables, **options), path, file_format=file_format)
