"""Free SQL over the registered tables.

``execute`` stores a result with the place of each row, so that ``page`` reads any part of it in the
order of the query. It runs under a job tag: a time limit, or ``stop`` from another thread, ends its
jobs alone, and the session goes on.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardflow.session import _path

MAX_PAGE = 10_000
# Places number rows within their task; the task's number stands above so many bits.
_PLACE_BITS = 33


@dataclass
class Exploration:
    """Result of a query: a distributed frame, or the error text."""

    frame: DataFrame | None
    error: str | None = None
    observation: Observation | None = None
    path: str | None = None
    place: str | None = None

    @property
    def row_count(self) -> int | None:
        """Rows returned, known after the first action on ``frame`` and without a second run."""
        return self.observation.get["rows"] if self.observation else None


def explore(spark: SparkSession, text: str) -> Exploration:
    """Run one read query. As a subquery it cannot be a command that changes data."""
    query = text.strip().rstrip(";")
    try:
        frame = spark.sql(f"SELECT * FROM (\n{query}\n)")
    except PySparkException as error:
        return Exploration(None, str(error))
    observation = Observation()
    observed = frame.observe(observation, F.count(F.lit(1)).alias("rows"))
    return Exploration(observed, observation=observation)


@contextmanager
def _tagged(spark: SparkSession, tag: str, seconds: float | None) -> Iterator[threading.Event]:
    """Run jobs under ``tag`` and cancel them after ``seconds``; the event tells whether that happened."""
    context, ended = spark.sparkContext, threading.Event()

    def end() -> None:
        ended.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, end) if seconds is not None else None
    context.addJobTag(tag)
    try:
        if timer:
            timer.daemon = True
            timer.start()
        yield ended
    finally:
        if timer:
            timer.cancel()
        context.removeJobTag(tag)


def stop(spark: SparkSession, tag: str) -> None:
    """End the running query of that tag."""
    spark.sparkContext.cancelJobsWithTag(tag)


def execute(
    spark: SparkSession, text: str, path: str, seconds: float | None = None, tag: str | None = None
) -> Exploration:
    """Run one read query into a parquet folder; errors at run time become the error text as well.

    The frame of the result reads the folder, and the row count is known. A query that takes longer than
    ``seconds``, or that ``stop`` ends by its ``tag``, gives an error and leaves no folder.
    """
    found = explore(spark, text)
    if found.frame is None:
        return found
    place = "place"
    while place in found.frame.columns:
        place = f"_{place}"
    with _tagged(spark, tag or f"explore-{uuid.uuid4().hex}", seconds) as ended:
        try:
            found.frame.withColumn(place, F.monotonically_increasing_id()).write.parquet(path)
        except Exception as error:  # a cancelled job is no PySparkException
            if not isinstance(error, PySparkException) and "cancel" not in str(error).lower():
                raise
            target, system = _path(spark, path)
            if "PATH_ALREADY_EXISTS" not in str(error):
                system.delete(target, True)
            return Exploration(None, f"stopped after {seconds} seconds" if ended.is_set() else str(error))
    stored = spark.read.schema(found.frame.schema).parquet(path)
    return Exploration(stored, observation=found.observation, path=path, place=place)


def page(spark: SparkSession, result: Exploration, number: int, size: int = 100) -> DataFrame:
    """Page ``number``, from 1, of an executed query, in the order of the query; beyond the end it is empty.

    Rows per task are counted once (one row per task of the result), which gives the places of the page;
    the filter on them reaches the scan.
    """
    if result.path is None:
        raise ValueError("only executed queries have pages")
    if number < 1 or not 1 <= size <= MAX_PAGE:
        raise ValueError(f"pages start at 1 and have 1 to {MAX_PAGE} rows")
    place = F.col(f"`{result.place}`")
    rows = spark.read.parquet(result.path)
    counts = rows.groupBy(F.shiftright(place, _PLACE_BITS).alias("task")).count().orderBy("task").collect()
    skip, left, wanted = (number - 1) * size, size, F.lit(False)
    for task, count in counts:
        taken = min(max(count - skip, 0), left)
        if taken:
            first = (task << _PLACE_BITS) + skip
            wanted = wanted | place.between(first, first + taken - 1)
        skip, left = max(skip - count, 0), left - taken
    return rows.where(wanted).orderBy(place).drop(result.place)
