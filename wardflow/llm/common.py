"""What the corpus operators share: readers, word splitting, row caches, ordered neighbours."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.session import durable, work_folder

SPACE_CLASS = r"[\x20\x09-\x0D]+"
#: ASCII white space, the separators of ``[^\x20\x09-\x0D]+``; bytes.split() uses the same set.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of every row; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold_of(doc_id, folds: int):
    """The contract's fold: crc32 of the id as decimal text. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


_holder = None


def hold(owner) -> None:
    """``owner`` is about to grow: what another operator has kept in this worker process goes."""
    global _holder
    if _holder is not owner:
        if _holder is not None:
            _holder.clear()
        _holder = owner


class Cache(dict):
    """A dict that computes what it lacks, and starts anew beyond ``limit`` entries.

    Worker processes outlive tasks, and only one cache at a time is kept in each.
    """

    def __init__(self, compute: Callable, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        hold(self)
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def slices(batches: Iterable[pd.DataFrame], rows: int = 1_000) -> Iterator[pd.DataFrame]:
    """The batches in pieces of at most ``rows`` rows, so that what a piece gives is sent on before the next."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.iloc[at : at + rows]


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets where the words of ``data`` start and end."""
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = IS_SPACE[np.frombuffer(data, dtype=np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[0::2], edges[1::2]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an unsigned array."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def rolling(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = words[:n].copy()
    for i in range(1, width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mix(total)


def successors(keys: DataFrame, key: str = "k") -> DataFrame:
    """Each distinct key with ``next_<key>``, the next larger one; the last is followed by the first.

    ``keys`` holds distinct keys, in any order. They are range-partitioned and stored,
    so that the range borders survive a lost executor. Within a range the next key
    comes from a window; between ranges from one row per range.
    """
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = durable(keys.repartitionByRange(parts, key).withColumn("part", F.spark_partition_id()), "order")
    heads = stored.groupBy("part").agg(F.min(key).alias("head"))
    heads = heads.select(
        "part",
        F.coalesce(
            F.lead("head").over(Window.orderBy("part")),
            F.first("head").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)),
        ).alias("after"),
    )
    inside = F.lead(key).over(Window.partitionBy("part").orderBy(key))
    return (
        stored.withColumn("inside", inside)
        .join(F.broadcast(heads), "part")  # one row per range
        .withColumn(f"next_{key}", F.coalesce("inside", "after"))
        .drop("inside", "after", "part")
    )


def put_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a small file into the shared work folder, whatever store that is; its path."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{work_folder(spark)}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path.toString()
