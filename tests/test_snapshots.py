"""Published loads of the four tables: all or nothing, once, one after another."""

from __future__ import annotations

import pytest

from tests_support import GIVEN, write_extract
from wardflow.plans import ingest
from wardflow.schemas import TABLES
from wardflow.sources import snapshots
from wardflow.sources.tables import read_tables

LATER = [(400, 1, "[30-40)", "Male", "Asian", 1, 1, 2, 10, 4, 3, "NO", "401", {"insulin": "Down", "glipizide": "Up"})]


def rows(tables):
    return {
        name: sorted(tuple(r) for r in df.drop("created_at").collect()) for name, df in sorted(tables.items())
    }


@pytest.fixture
def extracts(tmp_path):
    return write_extract(tmp_path / "a.csv", GIVEN), write_extract(tmp_path / "b.csv", LATER), str(tmp_path / "tables")


def test_loads_equal_plain_appends(spark, extracts, tmp_path):
    first, second, folder = extracts
    for path in (first, second):
        state = ingest.ingest_batch(spark, path, folder)
        ingest.ingest(spark, path, str(tmp_path / "plain"), mode="append")
    assert state.version == 2 and len(state.batches) == 2
    assert rows(snapshots.read_snapshot(spark, folder)) == rows(read_tables(spark, str(tmp_path / "plain")))
    assert [sum(b.values()) for b in state.batches.values()] == [2 + 3 + 3 + 3, 1 + 1 + 2]


def test_a_repeated_extract_changes_nothing(spark, extracts, tmp_path):
    first, second, folder = extracts
    one = ingest.ingest_batch(spark, first, folder)
    assert ingest.ingest_batch(spark, write_extract(tmp_path / "c.csv", GIVEN[::-1]), folder) == one
    two = ingest.ingest_batch(spark, second, folder, batch="later")
    assert ingest.ingest_batch(spark, second, folder, batch="later") == two
    assert snapshots.snapshot(spark, folder) == two and not snapshots.unpublished(spark, folder)
    with pytest.raises(ValueError, match="stored already"):
        ingest.ingest_batch(spark, second, folder, batch="another name")


def test_a_load_that_stops_leaves_the_snapshot_whole(spark, extracts, monkeypatch):
    """It stops between the second and the third table; the next load of the same extract succeeds."""
    first, second, folder = extracts
    one = ingest.ingest_batch(spark, first, folder)
    before, write, written = rows(snapshots.read_snapshot(spark, folder)), snapshots.write_counted, []

    def stopping(df, path):
        if len(written) == 2:
            raise RuntimeError("lost")
        written.append(path)
        return write(df, path)

    monkeypatch.setattr(snapshots, "write_counted", stopping)
    with pytest.raises(RuntimeError, match="lost"):
        ingest.ingest_batch(spark, second, folder)
    monkeypatch.undo()
    assert snapshots.snapshot(spark, folder) == one
    assert rows(snapshots.read_snapshot(spark, folder)) == before
    assert [f"{folder}/{p}" for p in snapshots.unpublished(spark, folder)] == sorted(written)
    assert ingest.ingest_batch(spark, second, folder).version == 2
    assert len(snapshots.vacuum(spark, folder)) == 2 and not snapshots.unpublished(spark, folder)
    assert len(rows(snapshots.read_snapshot(spark, folder))["encounters"]) == 4


def test_two_loads_at_once(spark, extracts):
    """Both start from one snapshot: the second to publish is refused and leaves no manifest."""
    first, second, folder = extracts
    base = ingest.ingest_batch(spark, first, folder)
    empty = {n: spark.createDataFrame([], d.schema) for n, d in TABLES.items()}
    won = snapshots.commit(spark, folder, "x", empty, base)
    with pytest.raises(snapshots.Conflict):
        snapshots.commit(spark, folder, "y", empty, base)
    assert snapshots.snapshot(spark, folder) == won and won.batches["x"] == dict.fromkeys(TABLES, 0)


def test_earlier_versions_and_empty_folders(spark, extracts):
    first, second, folder = extracts
    assert snapshots.snapshot(spark, folder) == snapshots.Snapshot()
    assert all(df.count() == 0 for df in snapshots.read_snapshot(spark, folder).values())
    ingest.ingest_batch(spark, first, folder)
    ingest.ingest_batch(spark, second, folder)
    assert len(rows(snapshots.read_snapshot(spark, folder, 1))["encounters"]) == 3
