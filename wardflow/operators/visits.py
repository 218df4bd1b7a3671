"""Order of a patient's visits: previous visit, gap, visit number, first row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.operators.running import running
from wardflow.operators.skew import HotKeys, hot_keys

# The synthetic calendar of the extract and the default for "no earlier visit".
FIRST_DAY = "2020-01-01"
DAYS_BETWEEN_VISITS = 45
NO_PREVIOUS_VISIT = 999
EARLY_DAYS = 30


def visit_window():
    """A patient's visits by date; the id breaks ties of the date."""
    return Window.partitionBy("patient_id").orderBy(
        F.col("encounter_date").asc_nulls_last(), F.col("encounter_id")
    )


def previous_by_day(encounters: DataFrame, name: str) -> DataFrame:
    """``previous_visit`` without a window over a patient's rows.

    Only the first visit of a day can have an earlier date before it; every other
    visit of that day follows a visit of the same day. So the window runs over a
    patient's distinct days, few however many rows the patient has, and its answer
    goes back to the first visit of each day, found by its unique id.
    """
    days = encounters.groupBy("patient_id", "encounter_date").agg(F.min("encounter_id").alias("encounter_id"))
    by_day = Window.partitionBy("patient_id").orderBy(F.col("encounter_date").asc_nulls_last())
    firsts = days.select(
        "encounter_id", F.lag("encounter_date").over(by_day).alias("__before"), F.lit(True).alias("__first")
    )
    joined = encounters.join(firsts, "encounter_id", "left")
    before = F.when(F.col("__first"), F.col("__before")).otherwise(F.col("encounter_date"))
    return joined.select(*encounters.columns, before.alias(name))


def previous_visit(
    encounters: DataFrame, name: str = "prev_encounter_date", hot: HotKeys | None = None
) -> DataFrame:
    """Add the date of the patient's visit before this one."""
    hot = hot_keys(encounters, "patient_id") if hot is None else hot

    def by_row(rows: DataFrame) -> DataFrame:
        return rows.select("*", F.lag("encounter_date").over(visit_window()).alias(name))

    if not hot:
        return by_row(encounters)
    return by_row(hot.drop(encounters)).unionByName(previous_by_day(hot.keep(encounters), name))


def gap_days(date: Column, previous: Column) -> Column:
    return F.datediff(date, previous)


def within_30_days(gap: Column) -> Column:
    """True for a gap of at most 30 days; no earlier visit gives False."""
    return F.coalesce(gap <= EARLY_DAYS, F.lit(False))


def visit_number(
    df: DataFrame, patient: str, order: str, name: str = "visit_number", hot: HotKeys | None = None
) -> DataFrame:
    """Add the 0-based number of the visit within its patient, by ``order``."""
    hot = hot_keys(df, patient) if hot is None else hot

    def by_row(rows: DataFrame) -> DataFrame:
        window = Window.partitionBy(patient).orderBy(order)
        return rows.select("*", (F.row_number().over(window) - 1).cast("bigint").alias(name))

    if not hot:
        return by_row(df)
    ranked = running(hot.keep(df), [F.col(order)], group=[patient], position=name)
    ranked = ranked.withColumn(name, F.col(name) - 1)
    return by_row(hot.drop(df)).unionByName(ranked)


def synthetic_date(number: Column) -> Column:
    return F.date_add(F.to_date(F.lit(FIRST_DAY)), (number * DAYS_BETWEEN_VISITS).cast("int"))


def keep_first(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: the one that is first by ``order``.

    Each task combines its own rows before the shuffle. The combined value is a struct, so Spark
    sorts a task's rows by key to do so.
    """
    first = F.min_by(F.struct(*columns), F.struct(*order)).alias("__first")
    return df.groupBy(key).agg(first).select(key, *[F.col(f"__first.{c}").alias(c) for c in columns])
