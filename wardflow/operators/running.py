"""Positions and running totals in a total order, computed in parallel.

A window without a partition, or over one hot group, runs in a single task. Here
the rows are range-partitioned on (group, order), each range is numbered on its
own, and the totals of the ranges before it are added.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardflow.session import durable

_RANGE = "__range"
_FIRST = "__first_group"
_LAST = "__last_group"


def _offsets(firsts: list, lasts: list, tails: list[list[int]]) -> list[list[int]]:
    """Per range, in order: what the ranges before it already counted for its first group.

    ``tails`` holds the totals of each range's last group.
    """
    offsets, open_group, carried = [], None, [0] * len(tails[0]) if tails else []
    for first, last, tail in zip(firsts, lasts, tails):
        offset = carried if first == open_group else [0] * len(tail)
        offsets.append(offset)
        carried = [o + t for o, t in zip(offset, tail)] if first == last else tail
        open_group = last
    return offsets


def running(
    df: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    sums: Sequence[str] = (),
    position: str = "position",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``position`` (from 1) and ``cum_<name>`` for each whole-number column in ``sums``.

    ``order`` must be a total order within a group: equal rows cannot be shared out
    among ranges, so count repeated values first. Only one small row per range
    reaches the driver. The ranges are written once, so that numbering and offsets
    see the same boundaries even when tasks are run again.
    """
    spark = df.sparkSession
    keys = [*[F.col(g) for g in group], *order]
    # Without a given number, Spark starts from its shuffle partitions and merges small ones.
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged = durable(ranged.withColumn(_RANGE, F.spark_partition_id()), "ranges")

    # Fixed-width columns can be combined in a hash table; a struct or text would be sorted first.
    key = F.struct(*[F.col(g) for g in group], F.lit(0).alias("__all"))
    names = ["__rows", *[f"__sum_{s}" for s in sums]]
    totals = [F.count(F.lit(1)), *[F.coalesce(F.sum(s).cast("bigint"), F.lit(0).cast("bigint")) for s in sums]]
    totals = [t.alias(n) for t, n in zip(totals, names)]
    if not group:
        first, last = key, key
    elif len(group) == 1:
        null_first, null_last = F.max(F.col(group[0]).isNull()), F.min(F.col(group[0]).isNull())
        edge = lambda value, null: F.struct(F.when(~null, value).alias(group[0]), F.lit(0).alias("__all"))
        first, last = edge(F.min(group[0]), null_first), edge(F.max(group[0]), null_last)
    else:
        first, last = F.min(key), F.max(key)
    ends = ranged.groupBy(_RANGE).agg(
        first.alias(_FIRST), last.alias(_LAST), *([] if group else totals)
    )
    stats = ends.toArrow().sort_by(_RANGE)  # one row per range
    if group:
        last = spark.createDataFrame(stats.select([_RANGE, _LAST]), ends.select(_RANGE, _LAST).schema)
        of_last = ranged.join(F.broadcast(last), _RANGE).where(key.eqNullSafe(F.col(_LAST)))
        tails = of_last.groupBy(_RANGE).agg(*totals).toArrow().sort_by(_RANGE)
    else:
        tails = stats
    tail_rows = [list(t) for t in zip(*[tails[n].to_pylist() for n in names])]
    carried_rows = _offsets(stats[_FIRST].to_pylist(), stats[_LAST].to_pylist(), tail_rows)
    table = stats.select([_RANGE, _FIRST])
    for i, name in enumerate(names):
        table = table.append_column(name, pa.array([row[i] for row in carried_rows], pa.int64()))
    schema = ends.select(_RANGE, _FIRST).schema
    for name in names:
        schema = schema.add(name, T.LongType())
    offsets = spark.createDataFrame(table, schema)

    window = Window.partitionBy(_RANGE, *group).orderBy(*order)
    frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    continues = key.eqNullSafe(F.col(_FIRST))

    def carried(name: str) -> Column:
        return F.when(continues, F.col(name)).otherwise(F.lit(0).cast("bigint"))

    placed = ranged.join(F.broadcast(offsets), _RANGE)  # one row per range
    added = [(F.row_number().over(window).cast("bigint") + carried("__rows")).alias(position)]
    added += [(F.sum(s).over(frame).cast("bigint") + carried(f"__sum_{s}")).alias(f"cum_{s}") for s in sums]
    return placed.select(*df.columns, *added)


def dense_ids(df: DataFrame, name: str, order: Sequence[Column], start: int = 0) -> DataFrame:
    """Consecutive ids from ``start`` + 1 in the given order, first column of the result.

    The sorted ranges are stored, and a row's place is its row number in its file plus the
    rows of the files before it: one shuffle, and no second sort.
    """
    if name in df.columns:
        raise ValueError(f"the table already has a column {name}")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = durable(ranged.withColumn(_RANGE, F.spark_partition_id()), "ranges")
    place, file = F.col("_metadata.row_index"), F.col("_metadata.file_path")
    # A range may be written as several files, in order; their names sort as they were written.
    ends = stored.groupBy(F.col(_RANGE), file.alias("__file")).agg(F.count(F.lit(1)).alias("__rows"))
    sizes = ends.toArrow().sort_by([(_RANGE, "ascending"), ("__file", "ascending")])  # one row per file
    before, total = [], start
    for rows in sizes["__rows"].to_pylist():
        before.append(total)
        total += rows
    offsets = df.sparkSession.createDataFrame(
        sizes.select(["__file"]).append_column("__before", pa.array(before, pa.int64())), "__file string, __before long"
    )
    numbered = stored.withColumns({"__place": place, "__file": file}).join(F.broadcast(offsets), "__file")
    return numbered.select((F.col("__before") + F.col("__place") + 1).alias(name), *df.columns)


def unique_ids(df: DataFrame, name: str) -> DataFrame:
    """Unique ids with gaps; needs no shuffle."""
    return df.select(F.monotonically_increasing_id().alias(name), *df.columns)
