"""Features after appends: equal to the whole build, and only the touched buckets are read."""

from __future__ import annotations

import random
from datetime import date, timedelta
from functools import partial

import pytest

from tests_support import GIVEN, write_extract
from wardflow.operators import rates, skew, visits
from wardflow.plans import features, incremental, ingest
from wardflow.schemas import TABLES
from wardflow.session import table_exists
from wardflow.sources import snapshots

GROUPS = ["Diabetes", "Other", "Unknown", None]


def made(seed, encounters, n_patients=12):
    """Three batches; dates tie, lack and lie before stored ones, some patients come late or are missing."""
    rng = random.Random(seed)
    batches = [{n: [] for n in TABLES} for _ in range(3)]
    for p in range(n_patients):
        row = (p, rng.choice(["[0-10)", "[10-20)"]), "Male", rng.choice(["Asian", None]), p % 3, None, None)
        if p != 5:
            batches[rng.choice([0, 0, 1, 2])]["patients"].append(row)
    for e in range(encounters):
        batch = batches[rng.randrange(3)]
        patient = rng.choice([None, 5, 0, 0, 0, *range(n_patients)])
        day = rng.choice([None, *[date(2020, 1, 1) + timedelta(days=rng.randrange(60)) for _ in range(9)]])
        numbers = [rng.choice([None, 1, 2, 7]) for _ in range(4)]
        batch["encounters"].append((e, patient, day, *numbers, rng.random() < 0.4, None))
        for k in range(rng.choice([0, 1, 1, 2])):
            batch["diagnoses"].append((e * 2 + k, e, "x", rng.choice(GROUPS)))
        for k in range(rng.randrange(3)):
            batch["medications"].append((e * 3 + k, e, "insulin", rng.random() < 0.3))
    return batches


def frames(spark, batch):
    return {n: spark.createDataFrame(rows, TABLES[n].schema) for n, rows in batch.items()}


def whole(spark, batches):
    rows = {n: [row for batch in batches for row in batch[n]] for n in TABLES}
    return features.build_features(frames(spark, rows))


@pytest.mark.parametrize("hot", [False, True])
def test_equal_to_the_whole_build_after_each_batch(spark, tmp_path, same_rows, monkeypatch, hot):
    batches = made(3, 90)
    want = [whole(spark, batches[: k + 1]) for k in range(3)]
    if hot:  # two rows make a key hot
        few = partial(skew.hot_keys, min_rows=2)
        for module in (skew, visits, rates, incremental):
            monkeypatch.setattr(module, "hot_keys", few)
    folder = str(tmp_path / "state")
    for k, batch in enumerate(batches):
        incremental.update_features(spark, folder, frames(spark, batch), f"b{k}", buckets=4)
        same_rows(incremental.current_features(spark, folder), want[k])
    same_rows(incremental.current_features(spark, folder, 1), want[0])


def one_visit(spark, patient, encounter, day):
    visit = (encounter, patient, day, 3, 2, 1, 1, True, None)
    return frames(spark, {"patients": [], "encounters": [visit], "diagnoses": [(9000 + encounter, encounter, "x", "Other")], "medications": []})


@pytest.fixture
def stored(spark, tmp_path):
    batches = made(4, 60)
    folder = str(tmp_path / "state")
    rows = {n: [row for batch in batches for row in batch[n]] for n in TABLES}
    state = incremental.update_features(spark, folder, frames(spark, rows), "all", buckets=8)
    return folder, state, rows


def remove(spark, folder, part):
    found, system = snapshots._path(spark, f"{folder}/{part}")
    assert system.delete(found, True)


@pytest.mark.parametrize("day, reads_visits", [(date(2030, 1, 1), False), (date(2010, 1, 1), True)])
def test_only_touched_buckets_are_read(spark, stored, day, reads_visits):
    """All other buckets' files are gone, and the update still succeeds and keeps their parts."""
    folder, state, _ = stored
    patient = 7
    bucket = spark.range(1).selectExpr(f"pmod(xxhash64({patient}L), 8) AS b").first()["b"]
    for name, parts in state.parts.items():
        if name != "rates" and name.split("/")[1] != str(bucket) or (name.startswith("visits") and not reads_visits):
            for part in parts:
                remove(spark, folder, part)
    after = incremental.update_features(spark, folder, one_visit(spark, patient, 777, day), "one", buckets=8)
    changed = {n for n in after.parts if after.parts[n] != state.parts.get(n)}
    assert changed == {"rates", f"history/{bucket}", f"visits/{bucket}"}
    assert after.batches["one"] == {"buckets": 8, "touched": 1, "rewritten": int(reads_visits)}
    assert len(after.parts[f"visits/{bucket}"]) == (1 if reads_visits else 2)


def test_update_plan_names_no_other_file(spark, stored):
    folder, state, _ = stored
    own = incremental._read(spark, folder, state, "history", incremental.HISTORY, [3])
    assert {f.split("bucket=")[1].split("/")[0] for f in own.inputFiles()} == {"3"}


def test_many_parts_become_one(spark, stored, monkeypatch, same_rows):
    folder, _, rows = stored
    monkeypatch.setattr(incremental, "MERGE_PARTS", 3)
    for k in range(3):
        more = one_visit(spark, 7, 800 + k, date(2031, 1, 1) + timedelta(days=k))
        state = incremental.update_features(spark, folder, more, f"m{k}", buckets=8)
        for name in ("encounters", "diagnoses"):
            rows[name] += [tuple(r) for r in more[name].collect()]
    assert state.batches["m1"]["rewritten"] == 0 and state.batches["m2"]["rewritten"] == 1
    same_rows(incremental.current_features(spark, folder), whole(spark, [rows]))


def test_repeats_strays_and_buckets(spark, stored):
    folder, state, _ = stored
    assert incremental.update_features(spark, folder, one_visit(spark, 7, 900, None), "all", buckets=8) == state
    stray = one_visit(spark, 7, 901, None)
    stray["diagnoses"] = spark.createDataFrame([(1, 3, "x", "Other")], TABLES["diagnoses"].schema)
    with pytest.raises(ValueError, match="outside the batch"):
        incremental.update_features(spark, folder, stray, "stray", buckets=8)
    with pytest.raises(ValueError, match="buckets"):
        incremental.update_features(spark, folder, one_visit(spark, 7, 902, None), "more", buckets=4)
    assert snapshots.snapshot(spark, folder) == state


def test_empty_batches(spark, tmp_path):
    folder = str(tmp_path / "state")
    assert incremental.current_features(spark, folder).count() == 0
    state = incremental.update_features(spark, folder, frames(spark, {n: [] for n in TABLES}), "none", buckets=4)
    assert state.version == 1 and incremental.current_features(spark, folder).count() == 0


def test_features_follow_the_loads(spark, tmp_path, same_rows):
    """Two loads, then the features; a job that stopped after the first load goes on with the second."""
    later = [(400, 1, "[30-40)", "Male", "Asian", 1, 1, 2, 10, 4, 3, "NO", "401", {"insulin": "Down"})]
    loads, state = str(tmp_path / "tables"), str(tmp_path / "state")
    ingest.ingest_batch(spark, write_extract(tmp_path / "a.csv", GIVEN), loads)
    one = incremental.follow(spark, loads, state, buckets=4)
    ingest.ingest_batch(spark, write_extract(tmp_path / "b.csv", later), loads)
    two = incremental.follow(spark, loads, state, buckets=4)
    assert (one.version, two.version) == (1, 2) and incremental.follow(spark, loads, state, buckets=4) == two
    same_rows(incremental.current_features(spark, state), features.build_features(snapshots.read_snapshot(spark, loads)))
    assert two.batches[list(two.batches)[1]]["rewritten"] == 0 and table_exists(spark, state)


def test_the_extract_is_halved_without_a_count_of_every_key_in_one_task(spark, tmp_path, monkeypatch):
    """The aggregate function holds all distinct keys in one task, which ends an executor on large tables."""
    from wardflow.catalogue import queries

    def refused(column):
        raise AssertionError("median in one task")

    orders = [(key, (key or 1) % 2, date(2020, 1, 1), 100.0, "F") for key in (9, 2, 2, 40, 7, 31, None)]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice double, o_orderstatus string"),
        "lineitem": ([(2, 5, 1, "N", "F")], "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string"),
        "customer": ([(0, "BUILDING"), (1, "BUILDING")], "c_custkey long, c_mktsegment string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(queries.F, "median", refused)
    early, late = queries._halves(spark, str(tmp_path), str(tmp_path / "out"))
    keys = [sorted(int(r["encounter_id"]) for r in spark.read.csv(p, header=True).collect()) for p in (early, late)]
    assert keys == [[2, 2, 7], [9, 31, 40]]  # the middle of six keys is 8
