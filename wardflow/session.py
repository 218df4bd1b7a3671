"""Session helpers: a configured session and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wardflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _is_single_machine(master: str) -> bool:
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def work_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a session on one machine may fall
    back to a temporary folder. A path that names its scheme is taken as it is, ``file:`` too,
    since a mounted shared disk is named so. A path without one belongs to the default store;
    if that is the local disk of a cluster's machines, it is taken where the executors' files
    are seen by the driver, and refused where each machine keeps its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    alone = _is_single_machine(context.master)
    if not folder:
        if not alone:
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wardflow-"))
        folder = context.getCheckpointDir()
    elif not alone and "://" not in folder and not folder.startswith("file:"):
        found, system = _path(spark, folder)
        folder = system.makeQualified(found).toString()
        if folder.startswith("file:") and not _is_shared(spark, folder):
            raise RuntimeError(f"{folder} has no scheme and is on each machine's own disk")
    return folder.rstrip("/")


#: Folders that ``_is_shared`` has found shared, by application.
_shared: set[tuple[str, str]] = set()


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether what a task on each core writes in ``folder`` can be read back whole; tried once per application.

    Without a shared disk the driver finds none of the other machines' files.
    """
    known = (spark.sparkContext.applicationId, folder)
    if known not in _shared:
        parts, probe = spark.sparkContext.defaultParallelism, f"{folder}/probe-{uuid.uuid4().hex}"
        try:
            spark.range(0, parts, 1, parts).write.parquet(probe)
            if spark.read.schema("id long").parquet(probe).count() == parts:
                _shared.add(known)
        finally:
            found, system = _path(spark, probe)
            system.delete(found, True)
    return known in _shared


def enable_checkpoints(spark: SparkSession) -> None:
    """Let the tree learners cut their lineage in the shared work folder."""
    folder = work_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def _path(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    found, system = _path(spark, path)
    return system.exists(found)


_owned: ContextVar[list[str] | None] = ContextVar("wardflow_work_tables", default=None)


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Own the tables that ``durable`` writes inside: they are deleted at the end.

    For jobs whose result is stored, or small, before the block ends. A frame that is
    returned lazily must not depend on them. Nested blocks delete their own.
    """
    mine: list[str] = []
    token = _owned.set(mine)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in mine:
            found, system = _path(spark, path)
            system.delete(found, True)


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back.

    Cuts the lineage: values that depend on one evaluation (partition numbers,
    scan positions) are fixed in the files, so a lost executor cannot change
    them, and readers take only the columns they need. Inside ``work_tables`` the copy is
    deleted with the block; else it stays until the cluster clears the folder.
    """
    path = f"{work_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if (mine := _owned.get()) is not None:
        mine.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
