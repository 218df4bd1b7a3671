"""Column functions for cleaning and classifying raw values. All run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The extract's own missing marker, then the words pandas reads as missing.
MISSING_MARKER = "?"
NULL_TOKENS = (
    MISSING_MARKER,
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# ICD-9 code prefixes of the diagnosis groups.
DIABETES_PREFIX = "250"
CIRCULATORY_PREFIXES = ("39", "40", "41", "42", "43", "44", "45")
RESPIRATORY_PREFIXES = ("46", "47", "48", "49", "50", "51")
DIAGNOSIS_GROUPS = ("Diabetes", "Circulatory", "Respiratory", "Other", "Unknown")

# Statuses in the extract.
DRUG_NOT_GIVEN = "No"
DOSE_CHANGED = ("Up", "Down")
READMITTED_EARLY = "<30"


def null_if_missing(col: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Null where the whole text is a missing-value token."""
    return F.when(~col.isin(list(tokens)), col)


def normalise_missing(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Apply ``null_if_missing`` to every string column."""
    tokens = list(tokens)
    return df.select(
        *[
            null_if_missing(F.col(f.name), tokens).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def clean_gender(col: Column) -> Column:
    return clip_text(F.when(col == "Unknown/Invalid", "Unknown").otherwise(col), 10)


def clip_text(col: Column, width: int) -> Column:
    return F.substring(col, 1, width)


def diagnosis_group(code: Column) -> Column:
    """Broad group of an ICD-9 code, decided by text prefix, not by numeric range."""
    text = code.cast("string")
    lead = F.substring(text, 1, 2)
    return (
        F.when(text.isNull() | (text == MISSING_MARKER), "Unknown")
        .when(text.startswith(DIABETES_PREFIX), "Diabetes")
        .when(lead.isin(*CIRCULATORY_PREFIXES), "Circulatory")
        .when(lead.isin(*RESPIRATORY_PREFIXES), "Respiratory")
        .otherwise("Other")
    )


def drug_active(status: Column) -> Column:
    """True unless the status says the drug was not given; a missing status counts as active."""
    return ~status.eqNullSafe(F.lit(DRUG_NOT_GIVEN))


def dose_changed(status: Column) -> Column:
    return F.coalesce(status.isin(*DOSE_CHANGED), F.lit(False))


def readmitted_early(status: Column) -> Column:
    return status.eqNullSafe(F.lit(READMITTED_EARLY))


def three_class_label(status: Column) -> Column:
    """0 = not readmitted, 1 = later than 30 days, 2 = within 30 days."""
    return F.when(status == READMITTED_EARLY, 2).when(status == ">30", 1).otherwise(0)


def safe_name(name: str) -> str:
    """Column name without the brackets a tree learner may reject."""
    return re.sub(r"[\[\]<>]", "_", name)


def safe_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[safe_name(name) for name in df.columns])
