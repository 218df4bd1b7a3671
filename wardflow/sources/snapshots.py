"""Several tables that change together: staged writes, and manifests that publish them.

A folder holds ``_data/<table>/<part>`` with the rows that one load added to a table, and
``_manifest/<version>.json``, which lists the parts of all tables and the batches they came from. A
load stages its parts first and then publishes one manifest, by a rename that fails if the version is there.
Readers go through the newest manifest, so they see all tables of a load or none: a load that stops half
way leaves the earlier snapshot whole, and parts that no manifest names (``unpublished``, ``vacuum``). A load
under a batch name that the manifest has already changes nothing. Two loads at once: the second
to publish raises ``Conflict``, and may run again on the new snapshot.

The manifest is small: a line for each load and table, whatever the size of the data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wardflow.schemas import TABLES
from wardflow.session import _path
from wardflow.sources.tables import write_counted


class Conflict(RuntimeError):
    """Another load has published the version that this one was to become."""


@dataclass(frozen=True)
class Snapshot:
    """A published state: the parts of each table, and rows added per batch and table."""

    version: int = 0
    parts: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, dict[str, int]] = field(default_factory=dict)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    found, system = _path(spark, f"{folder}/_manifest")
    if not system.exists(found):
        return []
    names = [status.getPath().getName() for status in system.listStatus(found)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(folder: str, version: int) -> str:
    return f"{folder}/_manifest/{version:012d}.json"


def snapshot(spark: SparkSession, folder: str, version: int | None = None) -> Snapshot:
    """The newest published state of a folder, or an earlier one by its version."""
    if version is None:
        version = max(_versions(spark, folder), default=0)
    if not version:
        return Snapshot()
    found, system = _path(spark, _manifest(folder, version))
    source = system.open(found)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
    return Snapshot(**json.loads(text))


def publish(spark: SparkSession, folder: str, state: Snapshot) -> None:
    """Write the manifest of ``state``; ``Conflict`` if its version is there."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    target, system = _path(spark, _manifest(folder, state.version))
    staged, _ = _path(spark, f"{folder}/_manifest/.{uuid.uuid4().hex}")
    out = system.create(staged, False)
    try:
        out.write(bytearray(json.dumps(vars(state)).encode()))
    finally:
        out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        if system.exists(target):
            raise Conflict(f"version {state.version} of {folder} is published already")
        context.rename(context.makeQualified(staged), context.makeQualified(target), gateway.new_array(kind, 0))
    except Conflict:
        system.delete(staged, False)
        raise
    except Exception as error:
        system.delete(staged, False)
        if "AlreadyExists" in str(error):
            raise Conflict(f"version {state.version} of {folder} is published already") from error
        raise


def commit(spark: SparkSession, folder: str, batch: str, tables: Mapping[str, DataFrame], base: Snapshot) -> Snapshot:
    """Add the rows of ``tables`` to the snapshot ``base`` as one batch, all or none."""
    if batch in base.batches:
        return base
    unique = uuid.uuid4().hex
    parts, rows = {n: list(p) for n, p in base.parts.items()}, {}
    for name, df in tables.items():
        part = f"_data/{name}/{unique}"
        rows[name] = write_counted(df, f"{folder}/{part}")
        parts.setdefault(name, []).append(part)
    state = Snapshot(base.version + 1, parts, {**base.batches, batch: rows})
    publish(spark, folder, state)
    return state


def read_snapshot(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a published state, by their declared schemas; a table without rows is empty."""
    state = snapshot(spark, folder, version)
    out = {}
    for name, definition in TABLES.items():
        paths = [f"{folder}/{part}" for part in state.parts.get(name, [])]
        out[name] = spark.read.schema(definition.schema).parquet(*paths) if paths else spark.createDataFrame([], definition.schema)
    return out


def read_batch(spark: SparkSession, folder: str, batch: str) -> dict[str, DataFrame]:
    """The rows that one batch added to each table: every load adds one part to every table."""
    state = snapshot(spark, folder)
    place = list(state.batches).index(batch)
    return {n: spark.read.schema(d.schema).parquet(f"{folder}/{state.parts[n][place]}") for n, d in TABLES.items()}


def unpublished(spark: SparkSession, folder: str) -> list[str]:
    """Parts that no manifest names: of loads that stopped, or that are still running."""
    known = {part for v in _versions(spark, folder) for own in snapshot(spark, folder, v).parts.values() for part in own}
    found = []
    for name in TABLES:
        root, system = _path(spark, f"{folder}/_data/{name}")
        if system.exists(root):
            found += [f"_data/{name}/{status.getPath().getName()}" for status in system.listStatus(root)]
    return sorted(set(found) - known)


def vacuum(spark: SparkSession, folder: str) -> list[str]:
    """Delete the unpublished parts; only while no load is running."""
    gone = unpublished(spark, folder)
    for part in gone:
        found, system = _path(spark, f"{folder}/{part}")
        system.delete(found, True)
    return gone
