"""Readmission rates by diagnosis group, patient history, medication flags, trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from wardflow.functions.numbers import rate_percent, ratio_half_up
from wardflow.operators.skew import HotKeys, hot_keys, skew_join

HISTORY_COLUMNS = ("total_prior_visits", "avg_stay_days", "avg_medications", "max_lab_procedures")


def diagnosis_rates(
    encounters: DataFrame, diagnoses: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Per diagnosis group: encounters, readmissions and the exact rate in percent."""
    codes = diagnoses.select("encounter_id", "diagnosis_group")
    joined = skew_join(codes, encounters.select("encounter_id", "readmitted"), "encounter_id", hot=hot)
    return (
        joined.groupBy("diagnosis_group")
        .agg(
            F.count(F.lit(1)).alias("total_encounters"),
            F.count(F.when(F.col("readmitted"), 1)).alias("readmissions"),
        )
        .withColumn("readmission_rate_pct", rate_percent(F.col("readmissions"), F.col("total_encounters")))
    )


def patient_history(encounters: DataFrame, rounded: bool = True) -> DataFrame:
    """Per patient: visits, mean stay, mean medications, most lab procedures."""

    def mean(column: str):
        if rounded:
            return ratio_half_up(F.sum(column), F.count(column))
        return F.try_divide(F.sum(column).cast("double"), F.count(column))

    return encounters.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_prior_visits"),
        mean("length_of_stay").alias("avg_stay_days"),
        mean("num_medications").alias("avg_medications"),
        F.max("num_lab_procedures").alias("max_lab_procedures"),
    )


def history_over(encounters: DataFrame, window: WindowSpec, rounded: bool = True, **extra: Column) -> DataFrame:
    """Add the history columns, and ``extra`` ones, with a window over whole patients.

    Sums and counts are window columns of their own, so that a mean does not evaluate
    the same window function twice.
    """
    measured = encounters.select(
        "*",
        F.count(F.lit(1)).over(window).alias("total_prior_visits"),
        F.sum("length_of_stay").over(window).alias("__stay"),
        F.count("length_of_stay").over(window).alias("__stays"),
        F.sum("num_medications").over(window).alias("__drugs"),
        F.count("num_medications").over(window).alias("__drug_counts"),
        F.max("num_lab_procedures").over(window).alias("max_lab_procedures"),
        *[column.alias(name) for name, column in extra.items()],
    )

    def mean(total: str, count: str) -> Column:
        if rounded:
            return ratio_half_up(F.col(total), F.col(count))
        return F.try_divide(F.col(total).cast("double"), F.col(count))

    return measured.select(
        *encounters.columns,
        "total_prior_visits",
        mean("__stay", "__stays").alias("avg_stay_days"),
        mean("__drugs", "__drug_counts").alias("avg_medications"),
        "max_lab_procedures",
        *extra,
    )


def with_history(encounters: DataFrame, rounded: bool = False, hot: HotKeys | None = None) -> DataFrame:
    """Every encounter with its patient's history; without a patient there is none.

    Ordinary patients take one pass and one exchange. Hot patients are aggregated
    before the shuffle, and their few history rows are broadcast back.
    """
    hot = hot_keys(encounters, "patient_id") if hot is None else hot
    whole = history_over(hot.drop(encounters), Window.partitionBy("patient_id"), rounded)
    known = F.col("patient_id").isNotNull()
    joined = whole.withColumns({c: F.when(known, F.col(c)) for c in HISTORY_COLUMNS})
    if not hot:
        return joined
    rows = hot.keep(encounters)
    heavy = skew_join(rows, patient_history(rows, rounded), "patient_id", "left", hot)
    return joined.unionByName(heavy)


def medication_flags(medications: DataFrame, keys: Sequence[str] = ("encounter_id",)) -> DataFrame:
    """Per encounter: 1 if any dose changed. ``keys`` may add columns that an encounter determines."""
    changed = F.when(F.col("dosage_change"), 1).otherwise(0)
    return medications.groupBy(*keys).agg(F.max(changed).alias("med_change_flag"))


def admission_trend(encounters: DataFrame, patients: DataFrame) -> DataFrame:
    """Readmissions per month and admission type.

    Encounters are counted per patient and month first, so a busy patient brings
    one row per month into the join.
    """
    monthly = encounters.groupBy("patient_id", F.trunc("encounter_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("readmitted"), 1)).alias("r")
    )
    return (
        monthly.join(patients.select("patient_id", "admission_type"), "patient_id")
        .groupBy("month", "admission_type")
        .agg(F.sum("n").alias("total_encounters"), F.sum("r").alias("readmissions"))
        .withColumn("readmission_rate_pct", rate_percent(F.col("readmissions"), F.col("total_encounters")))
    )
