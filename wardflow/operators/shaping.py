"""Reshaping: melt, columns by type, alignment, fills, one-hot codes, profiles."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.numbers import rate_percent, ratio_half_up
from wardflow.functions.values import dose_changed, drug_active


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str) -> DataFrame:
    """One row per id and value column; null values are kept."""
    return df.unpivot(list(ids), list(values), variable, value)


def active_drugs(df: DataFrame, ids: Sequence[str], drugs: Sequence[str]) -> DataFrame:
    """Drug rows of each encounter that were given, with the dose-change flag."""
    status = F.col("status")
    return (
        melt(df, ids, drugs, "drug_name", "status")
        .where(drug_active(status))
        .select(*ids, "drug_name", dose_changed(status).alias("dosage_change"))
    )


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def other_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns that are not numbers; a boolean is not a number here."""
    return [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def align(df: DataFrame, columns: Sequence[str], fill: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly ``columns`` in that order; absent ones get their fill value, or 0."""
    fill = fill or {}
    present = set(df.columns)
    return df.select(
        *[F.col(f"`{c}`") if c in present else F.lit(fill.get(c, 0)).alias(c) for c in columns]
    )


#: Bits of a number that each pass of ``medians`` looks at, from its first.
DIGITS = (13, 13, 13, 13, 12)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Doubles as longs of the same order: their bits, negated below zero. Both zeros are 0."""
    bits = values.view(np.int64)
    return np.where(bits < 0, -(bits & np.int64(2**63 - 1)), bits)


def from_bits(bits: int) -> float:
    """The double behind ``ordered_bits``."""
    size = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -size if bits < 0 else size


COUNTS = "column_no int, first long, n long, low long, high long"


def _first_bits(batches: Iterator[pa.RecordBatch], shift: int, before: int, wanted: dict[int, list[int]]) -> Iterator[pa.RecordBatch]:
    """Counts, smallest and largest of a task's numbers by their bits from ``shift`` on."""
    held: dict[int, list[np.ndarray]] = {i: [] for i in wanted}  # rows of (first, n, low, high)

    def merged(rows: np.ndarray) -> np.ndarray:
        rows = rows[:, np.argsort(rows[0], kind="stable")]
        starts = np.flatnonzero(np.concatenate(([True], rows[0, 1:] != rows[0, :-1])))
        return np.stack([
            rows[0, starts], np.add.reduceat(rows[1], starts), np.minimum.reduceat(rows[2], starts), np.maximum.reduceat(rows[3], starts),
        ])

    for batch in batches:
        for i, column in zip(wanted, batch.columns):
            values = column.drop_null().to_numpy(zero_copy_only=False)
            bits = ordered_bits(values[~np.isnan(values)])
            if before < 64:
                bits = bits[np.isin(bits >> before, wanted[i])]
            if len(bits):
                held[i].append(merged(np.stack([bits >> shift, np.ones_like(bits), bits, bits])))
            if len(held[i]) >= 64:
                held[i] = [merged(np.concatenate(held[i], axis=1))]
    for i, parts in held.items():
        if parts:
            rows = merged(np.concatenate(parts, axis=1))
            number = np.full(rows.shape[1], i, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(number), *map(pa.array, rows)], ["column_no", "first", "n", "low", "high"])


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians, the mean of the two middle values for an even count; nulls and NaN are left out.

    A radix selection: each pass counts the values of all columns by the next bits of the number, tells from
    the counts which numbers the middle ones start with, and leaves the others out from then on. A
    task sends 8,192 counts per column and middle value at most, no value is moved or sorted between tasks, and a
    value that many rows hold is one count. There are five passes at most, fewer where few values
    differ; ``df`` is read once for each, so pass a stored table.
    """
    found: dict[str, float | None] = dict.fromkeys(columns)
    # For each column that is not settled, two of: place among the values left, first bits, the number if settled.
    middle: dict[int, list[list]] = {i: [] for i in range(len(columns))}
    shift = 64
    for width in DIGITS:
        if not middle:
            break
        shift, before = shift - width, shift
        wanted = {i: sorted({first for _, first, _ in targets}) for i, targets in middle.items()}
        left = df.select(*[F.col(f"`{columns[i]}`").cast("double").alias(f"c{i}") for i in wanted])
        parts = left.mapInArrow(lambda batches, s=shift, b=before, w=wanted: _first_bits(batches, s, b, w), COUNTS)
        counts = parts.groupBy("column_no", "first").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        by_column: dict[int, list[tuple]] = {}
        for row in counts.toArrow().to_pylist():  # 2 x 8,192 rows per column at most
            by_column.setdefault(row["column_no"], []).append((row["first"], row["n"], row["low"], row["high"]))
        for i in list(middle):
            rows = sorted(by_column.get(i, []))
            if not middle[i]:
                total = sum(n for _, n, _, _ in rows)
                if not total:
                    del middle[i]
                    continue
                middle[i] = [[(total - 1) // 2, None, None], [total // 2, None, None]]
            for target in middle[i]:
                inside = [r for r in rows if target[1] is None or r[0] >> (before - shift) == target[1]]
                for first, n, low, high in inside:
                    if target[0] < n:
                        target[1:] = first, low if low == high else None
                        break
                    target[0] -= n
            if all(value is not None for _, _, value in middle[i]):
                found[columns[i]] = sum(from_bits(value) for _, _, value in middle.pop(i)) / 2
    return found


def fill_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls of numeric columns with the column's median, as doubles."""
    middle = medians(df, columns)
    filled = {
        c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(middle[c]).cast("double")) for c in columns
    }
    return df.withColumns(filled)


#: A dummy column per value: what one encoder can hold unless a caller allows more.
MAX_CATEGORIES = 1000


def categories(df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct values per column, null counted as 'Unknown'. Too many values raise an error."""
    found = {}
    for c in columns:
        value = F.coalesce(F.col(f"`{c}`"), F.lit("Unknown")).alias("value")
        rows = df.select(value).distinct().limit(max_categories + 1).collect()
        if len(rows) > max_categories:
            raise ValueError(f"column {c} has more than {max_categories} categories")
        found[c] = sorted(row["value"] for row in rows)
    return found


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, missing rows and their share in percent. One pass, one row per column."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(f"`{c}`").alias(f"__n{i}") for i, c in enumerate(columns)]
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), (F.col("__rows") - F.col(f"__n{i}")).alias("n_missing"))
            for i, c in enumerate(columns)
        ]
    )
    return counted.select(F.col("__rows").alias("n_rows"), F.explode(cells).alias("cell")).select(
        "cell.column_name",
        "n_rows",
        "cell.n_missing",
        rate_percent(F.col("cell.n_missing"), F.col("n_rows")).alias("missing_pct"),
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share (3 decimals) per value of a class column."""

    filled = df.where(F.col(column).isNotNull())
    counted = filled.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("share", ratio_half_up(F.col("n_rows"), F.lit(filled.count()), digits=3))


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives divided by positives."""
    y = F.col(label).cast("int")
    negatives, positives = F.count(F.when(y == 0, 1)), F.count(F.when(y == 1, 1))
    return df.agg(F.try_divide(negatives.cast("double"), positives).alias("ratio"))
