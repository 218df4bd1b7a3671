"""Raw extracts with unreadable rows: good rows go on, bad ones are set aside with a reason.

Rules, per row:

``fields``  the line has more or fewer fields than its file's header; the entry holds the line
``number``  a number column holds text that is no whole number
``range``   a whole number does not fit the column's type

A row that breaks a rule is not loaded; it has one entry for each bad cell, or one for its line. Missing
tokens are not bad: such a cell is null, as in any load. All rules are judged in the one scan of the
files, whose result is stored typed; rows set aside are read from there.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.functions.values import NULL_TOKENS, normalise_missing
from wardflow.schemas import RAW_TYPES
from wardflow.session import durable
from wardflow.sources.tables import FILE_ORDER, raw_text, whole_number

FIELDS, NUMBER, RANGE = "fields", "number", "range"
_LINE, _PROBLEMS = "__line", "__problems"


class TooManyBadRows(ValueError):
    """The share of rows set aside is above the limit of the load."""


@dataclass(frozen=True)
class Checked:
    """``good``: typed rows with ``file_order``. ``bad``: file, record, column_name, text, reason."""

    good: DataFrame
    bad: DataFrame
    n_rows: int
    n_bad: int

    @property
    def bad_share(self) -> float:
        return self.n_bad / self.n_rows if self.n_rows else 0.0


def _entry(column: str | None, text: Column, reason: Column) -> Column:
    return F.struct(F.lit(column).cast("string").alias("column_name"), text.alias("text"), reason.alias("reason"))


def _cell(name: str) -> Column:
    whole = whole_number(name)
    bad = F.col(_LINE).isNull() & F.col(name).isNotNull() & whole.try_cast(RAW_TYPES[name]).isNull()
    reason = F.when(whole.rlike(r"^\s*[+-]?\d+\s*$"), RANGE).otherwise(NUMBER)
    return F.when(bad, _entry(name, F.col(name), reason))


def read_checked_csv(
    spark: SparkSession, path: str | Sequence[str], null_tokens: Iterable[str] = NULL_TOKENS, multi_line: bool = False
) -> Checked:
    """Read an extract as ``read_raw_csv`` does, with the rows that it would not read set aside."""
    text = normalise_missing(raw_text(spark, path, multi_line, _LINE).withColumn(_LINE, F.struct(_LINE)), null_tokens)
    text = text.withColumn(_LINE, F.col(f"{_LINE}.{_LINE}"))  # in a struct, a line is never a missing token
    numbers = [name for name, kind in RAW_TYPES.items() if kind != "string"]
    line = F.when(F.col(_LINE).isNotNull(), _entry(None, F.col(_LINE), F.lit(FIELDS)))
    problems = F.array_compact(F.array(line, *map(_cell, numbers)))
    typed = [whole_number(n).try_cast(RAW_TYPES[n]).alias(n) if n in numbers else F.col(n) for n in RAW_TYPES]
    seen = Observation()
    rows = text.select(*typed, FILE_ORDER, problems.alias(_PROBLEMS))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count(F.when(F.size(_PROBLEMS) > 0, 1)).alias("bad"))
    stored = durable(rows, "checked")
    good = stored.where(F.size(_PROBLEMS) == 0).drop(_PROBLEMS)
    return Checked(good, _set_aside(stored), seen.get["n"], seen.get["bad"])


def _set_aside(stored: DataFrame) -> DataFrame:
    """The entries with the number of their record in the file, from 1; header and empty lines do not count.

    Records of a block have consecutive places in the scan, so one row per block is enough to number them.
    """
    file, block, place = (F.col(f"{FILE_ORDER}.{c}") for c in ("file", "block", "line"))
    blocks = stored.groupBy(file.alias("file"), block.alias("block")).agg(
        F.count(F.lit(1)).alias("records"), F.min(place).alias("first")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", (F.coalesce(F.sum("records").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    entries = stored.where(F.size(_PROBLEMS) > 0).select(
        file.alias("file"), block.alias("block"), place.alias("place"), F.explode(_PROBLEMS).alias("entry")
    )
    return entries.join(blocks, ["file", "block"]).select("file", (F.col("place") + F.col("shift")).alias("record"), "entry.*")
