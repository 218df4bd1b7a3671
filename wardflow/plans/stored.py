"""The feature table over catalog tables that lie hashed by patient: no table moves again.

``store`` hashes all four tables by patient. Diagnoses and medications take the patient from their encounter,
and a diagnosis also the encounter's label, so rates need no join. After that the windows of the history, the snapshot,
the flags and the diagnoses of a patient all meet in the patient's bucket.

A patient who fills a bucket is found by count, and takes the plan of ``build_features`` for hot patients, over that
patient's rows alone. All others are read bucket by bucket.

The joins on patient and encounter are local to a bucket only if Spark may join tables that are hashed
by a part of the keys: set ``CO_PARTITION`` to false in the session that runs the build. With Spark's default
the result is the same, and the rows of these joins are shuffled.

Defined results: those of ``build_features``. Diagnoses and medications without an encounter are not stored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.functions.numbers import rate_percent
from wardflow.operators.rates import medication_flags
from wardflow.operators.skew import HOT_ROWS, HotKeys, hot_keys, lookup_join, skew_join
from wardflow.plans.features import build_features, finished, with_patient
from wardflow.schemas import TABLES
from wardflow.sources.tables import save_bucketed

CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
BUCKETS = 1024


def store(tables: Mapping[str, DataFrame], prefix: str, folder: str | None = None, buckets: int = BUCKETS) -> None:
    """Save the four tables as ``<prefix>patients`` and so on, hashed by patient."""
    owners = tables["encounters"].select("encounter_id", "patient_id", "readmitted")
    kept = {
        "patients": tables["patients"],
        "encounters": tables["encounters"],
        "diagnoses": skew_join(tables["diagnoses"], owners, "encounter_id"),
        "medications": skew_join(tables["medications"], owners.drop("readmitted"), "encounter_id"),
    }
    for name, df in kept.items():
        save_bucketed(df, f"{prefix}{name}", "patient_id", buckets, path=f"{folder}/{name}" if folder else None)


def stored_tables(spark: SparkSession, prefix: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"{prefix}{name}") for name in TABLES}


def _hot_patients(tables: Mapping[str, DataFrame], min_rows: int) -> HotKeys:
    """Patients with very many visits, diagnoses or medications; one column of each table is read."""
    found = [hot_keys(tables[n], "patient_id", min_rows) for n in ("encounters", "diagnoses", "medications")]
    return HotKeys("patient_id", tuple(sorted({v for hot in found for v in hot.values})))


def stored_features(spark: SparkSession, prefix: str, min_hot_rows: int = HOT_ROWS) -> DataFrame:
    """The feature table of stored tables."""
    tables = stored_tables(spark, prefix)
    rates = tables["diagnoses"].groupBy("diagnosis_group").agg(
        rate_percent(F.count(F.when(F.col("readmitted"), 1)), F.count(F.lit(1))).alias("readmission_rate_pct")
    )
    hot = _hot_patients(tables, min_hot_rows)
    some = {name: hot.drop(df) if hot else df for name, df in tables.items()}

    keys = ["patient_id", "encounter_id"]
    rows = with_patient(some["encounters"].drop("created_at"), some["patients"].drop("created_at"), "window", None)
    rows = rows.join(medication_flags(some["medications"], keys), keys, "left")
    rows = rows.join(some["diagnoses"].select(*keys, "diagnosis_group"), keys, "left")
    found = finished(lookup_join(rows, rates, "diagnosis_group"))
    if not hot:
        return found
    heavy = {name: hot.keep(df) for name, df in tables.items()}
    heavy["diagnoses"] = heavy["diagnoses"].drop("patient_id", "readmitted")
    heavy["medications"] = heavy["medications"].drop("patient_id")
    return found.unionByName(build_features(heavy, rates=rates, hot_patients=hot))
