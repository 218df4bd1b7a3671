"""Table constraints as checks: each returns the violations, none means the table is clean."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.schemas import TableDefinition

# The choices and limits of the scoring form.
AGE_BANDS = tuple(f"[{low}-{low + 10})" for low in range(0, 100, 10))
GENDERS = ("Male", "Female", "Unknown")
RACES = ("Caucasian", "AfricanAmerican", "Hispanic", "Asian", "Other", "Unknown")
AT_LEAST_ONE = (
    "admission_type",
    "discharge_id",
    "length_of_stay",
    "num_lab_procedures",
    "num_medications",
    "num_diagnoses",
)
AT_LEAST_ZERO = (
    "total_prior_visits",
    "days_since_last_visit",
    "avg_stay_days",
    "avg_medications",
    "max_lab_procedures",
)


def primary_key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that repeat or are null, with their row counts."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where((F.col("n_rows") > 1) | F.col(key).isNull())
    )


def foreign_key_violations(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child keys without a parent, with their row counts.

    Child rows are counted per key before the join, so a frequent key is one row in it.
    """
    counted = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    keys = parent.select(F.col(parent_column).alias(column))
    return counted.join(keys, column, "left_anti")


def length_violations(df: DataFrame, key: str, limits: dict[str, int]) -> DataFrame:
    """One row per value longer than its column allows."""
    checks = F.array(
        *[
            F.when(
                F.char_length(name) > width,
                F.struct(F.lit(name).alias("column_name"), F.char_length(name).alias("n_chars")),
            )
            for name, width in limits.items()
        ]
    )
    found = df.select(key, F.explode(F.filter(checks, lambda c: c.isNotNull())).alias("bad"))
    return found.select(key, "bad.column_name", "bad.n_chars")


def _comparable(frames: list[DataFrame]) -> list[DataFrame]:
    """Frames whose ``key`` columns can meet: text only where one is text and another is not."""
    kinds = {f.schema["key"].dataType for f in frames}
    if len(kinds) > 1 and any(isinstance(k, T.StringType) for k in kinds):
        return [f.withColumn("key", F.col("key").cast("string")) for f in frames]
    return frames


def check_tables(tables: dict[str, DataFrame], definitions: dict[str, TableDefinition]) -> DataFrame:
    """Number of violations per declared constraint of all given tables.

    A table's rows are counted per key, in the key's own type, before tables meet; values that are too
    long are counted on the way. The counts of a table and of the foreign keys that point to it are then
    joined on the key they are already dealt by, so nothing moves but one row per key and task (joined keys once
    more for each foreign key after the first that points to a table). Two tables that are stored hashed by the key
    (``save_bucketed``) need no exchange, as each bucket holds all that is known of its keys. A table without its key column breaks the primary key with every row.
    """
    found: list[DataFrame] = []
    for name, definition in definitions.items():
        df, key = tables[name], definition.primary_key
        rows, results = F.count(F.lit(1)), []
        lengths = [
            (f"length of {c}", f"too_long_{n}", F.count_if(F.char_length(c) > width))
            for n, (c, width) in enumerate(definition.max_lengths or ())
        ]
        own = [count.alias(column) for _, column, count in lengths]
        if key in df.columns:
            counts = df.groupBy(F.col(key).alias("key")).agg(rows.alias("n"), *own)
            broken = F.count_if((F.col("n") > 1) | (F.col("key").isNull() & F.col("n").isNotNull()))
        else:
            counts = df.agg(rows.alias("n"), *own).withColumn("key", F.lit(None).cast("long"))
            broken = F.sum("n")
        results.append((name, f"primary key {key}", broken))
        sides = []
        for child, other in definitions.items():
            for fk in other.foreign_keys:
                if fk.parent != name:
                    continue
                used = tables[child].where(F.col(fk.column).isNotNull()).groupBy(F.col(fk.column).alias("key"))
                mark = f"used_{len(sides)}"
                sides.append(used.agg(F.lit(True).alias(mark)))
                results.append((child, f"foreign key {fk.column}", F.count_if(F.col(mark) & F.col("n").isNull())))
        results += [(name, constraint, F.sum(column)) for constraint, column, _ in lengths]
        counts, *sides = _comparable([counts, *sides])
        for side in sides:
            counts = counts.join(side, "key", "full")
        totals = counts.agg(*[F.coalesce(v, F.lit(0)).cast("long").alias(f"v_{n}") for n, (_, _, v) in enumerate(results)])
        lines = [
            F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("constraint_name"), F.col(f"v_{n}").alias("violations"))
            for n, (t, c, _) in enumerate(results)
        ]
        found.append(totals.select(F.inline(F.array(*lines))))
    return reduce(DataFrame.unionByName, found)


def scoring_rules() -> dict[str, Column]:
    """Rule name -> condition that must hold for a scoring input; a missing value fails."""
    rules = {
        "age": F.col("age").isin(*AGE_BANDS),
        "gender": F.col("gender").isin(*GENDERS),
        "race": F.col("race").isin(*RACES),
        "diag_readmission_rate": F.col("diag_readmission_rate").between(0, 100),
        "medication_change_flag": F.col("medication_change_flag").isin(0, 1),
    }
    rules |= {name: F.col(name) >= 1 for name in AT_LEAST_ONE}
    rules |= {name: F.col(name) >= 0 for name in AT_LEAST_ZERO}
    return rules


def failed_rules(df: DataFrame, rules: dict[str, Column] | None = None, name: str = "failed_rules") -> DataFrame:
    """Add the sorted names of the rules each row breaks."""
    rules = scoring_rules() if rules is None else rules
    marks = [
        F.when(~F.coalesce(rules[rule], F.lit(False)), F.lit(rule)) for rule in sorted(rules)
    ]
    return df.withColumn(name, F.filter(F.array(*marks), lambda m: m.isNotNull()))
