"""Joins and splits that stay parallel when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it has at least this many rows and this share of its table.
HOT_ROWS = 1_000_000
HOT_SHARE = 4096
# Rows are first counted in so many buckets of keys; only full buckets are looked into.
BUCKETS = 65_536


@dataclass(frozen=True)
class HotKeys:
    """Heavy values of one column: at most ``HOT_SHARE`` of them, whatever the data size."""

    column: str
    values: tuple = ()
    has_null: bool = False

    def __bool__(self) -> bool:
        return bool(self.values) or self.has_null

    def keep(self, df: DataFrame) -> DataFrame:
        """The rows of hot keys. The filter reaches the scan."""
        col = F.col(self.column)
        hit = col.isin(list(self.values))
        return df.where((hit | col.isNull()) if self.has_null else hit)

    def drop(self, df: DataFrame) -> DataFrame:
        """All other rows."""
        col = F.col(self.column)
        miss = ~col.isin(list(self.values))
        return df.where((miss & col.isNotNull()) if self.has_null else (miss | col.isNull()))


def hot_keys(df: DataFrame, column: str, min_rows: int = HOT_ROWS) -> HotKeys:
    """Find the hot keys of ``column`` exactly, without a shuffle of the keys.

    One pass counts rows per hash bucket; each task sends at most one row per bucket. Only buckets
    that could hold a hot key, no more than ``HOT_SHARE``, are then counted by key, and
    most tables have none. The answer decides where rows are processed, never which are in a result.
    """
    bucket = F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int").alias("bucket")
    counts = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most BUCKETS rows
    sizes = dict(zip(counts["bucket"].to_pylist(), counts["n"].to_pylist()))
    floor = max(min_rows, sum(sizes.values()) // HOT_SHARE)
    full = [b for b, n in sizes.items() if n >= floor]
    if not full:
        return HotKeys(column)
    inside = df.select(column, bucket).where(F.col("bucket").isin(full))
    counted = inside.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= floor)
    found = [row[column] for row in counted.collect()]  # at most HOT_SHARE + 1 rows
    return HotKeys(column, tuple(sorted(k for k in found if k is not None)), None in found)


def skew_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    hot: HotKeys | None = None,
    hot_one: DataFrame | None = None,
) -> DataFrame:
    """Join ``many`` to ``one``, which is unique on ``key``.

    ``how`` is ``inner``, ``left`` (keep all of ``many``) or ``right`` (keep all
    of ``one``). Rows of hot keys stay where they are and meet a broadcast of the
    matching ``one`` rows: no more rows than hot keys, because ``one`` is unique.
    All other rows take an ordinary shuffle join. With no hot key the plan is the
    ordinary join alone. ``hot_one`` may give a cheaper plan for the hot rows of ``one``.
    """
    hot = hot_keys(many, key) if hot is None else hot
    if how != "left":  # a null key never matches
        many = many.where(F.col(key).isNotNull())
        hot = HotKeys(key, hot.values)
    if not hot:
        return many.join(one, key, how)
    cold = hot.drop(many).join(hot.drop(one), key, how)
    # The hot keys come from ``many``, so each of their ``one`` rows has a partner.
    heavy_how = "inner" if how == "right" else how
    heavy_one = hot.keep(one if hot_one is None else hot_one)
    heavy = hot.keep(many).join(F.broadcast(heavy_one), key, heavy_how)
    return cold.unionByName(heavy)


def small_table(df: DataFrame, max_rows: int = 10_000) -> DataFrame | None:
    """``df`` as a local table if it has at most ``max_rows`` rows, else None.

    The check reads at most ``max_rows + 1`` rows, so the result is safe to broadcast.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def lookup_join(many: DataFrame, small: DataFrame, key: str, max_rows: int = 10_000) -> DataFrame:
    """Left join to a summary table: broadcast when it is checked to be small, else skew-aware."""
    local = small_table(small, max_rows)
    if local is not None:
        return many.join(F.broadcast(local), key, "left")
    return skew_join(many, small, key, "left")
