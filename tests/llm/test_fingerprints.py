"""Fingerprints: edited texts by hand, estimates against true shares, merging."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from wardflow.llm import fingerprints as fp


def shingles(text, width=5):
    words = (text or "").split()
    n = min(width, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, following):
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def test_small_table(spark, folder):
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    found = {r["doc_id"]: r for r in fp.op1_fingerprints(spark, folder).collect()}
    assert set(found) == {i for i, _ in rows} and len(found) == len(rows)
    by_text = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        changed, r = edited(text, following), found[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        # Five standard errors of a share estimated from 128 draws.
        assert abs(r["near_edited"] - jaccard(shingles(text), shingles(changed))) < 0.22
        assert abs(r["near_next"] - jaccard(shingles(text), shingles(following))) < 0.22
        assert len(r["fingerprint"]) == 16 * min(128, len(shingles(text)))
        assert abs(r["distinct_shingles"] / max(1, len(shingles(text))) - 1) < 0.45 or not text.split()
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert len(set(by_text.values())) == len({frozenset(shingles(t)) for t in by_text})


def test_no_python_in_the_plan(spark, folder):
    plan = fp.op1_fingerprints(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_parts_merge_to_the_whole(spark):
    """Sketches of overlapping parts give the sketch of the whole."""
    words = [f"w{i * 7 % 1000}" for i in range(900)]
    parts = [" ".join(words[:500]), " ".join(words[496:])]
    df = spark.createDataFrame([(*parts, " ".join(words))], "a string, b string, c string")
    for name in "abc":
        df = fp.with_sketch(df, name, f"{name}s")
    row = df.select(
        fp.merge(F.col("as"), F.col("bs")).alias("merged"), F.col("cs"), F.size("as").alias("n"),
        fp.containment(F.col("as"), F.col("cs")).alias("inside"), fp.containment(F.col("cs"), F.col("as")).alias("part"),
        fp.resemblance(F.col("as"), F.col("cs")).alias("near"), fp.distinct_shingles(F.col("cs")).alias("distinct"),
    ).first()
    assert row["merged"] == row["cs"] and row["n"] == 128
    assert row["inside"] == pytest.approx(1.0, abs=0.2) and row["part"] == pytest.approx(496 / 896, abs=0.2)
    assert row["near"] == pytest.approx(496 / 896, abs=0.2) and row["distinct"] == pytest.approx(896, rel=0.4)


def test_odd_rows(spark):
    rows = [(5, None, "x"), (None, "first of all", "x"), (9, "a b c d e f g h", "x"), (9, "a b c d e f g h", "x"), (9, "aa", "x"), (7, "é" * 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sketch string")
    found = fp.fingerprint_documents(docs).collect()
    texts = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited"]) for r in found)
    last = "a b c d e f g h"
    assert texts == [
        (False, 0, 12, "first of "), (True, 5, 0, ""), (True, 7, 9, "é" * 7 + "a "),
        (True, 9, 2, "aa"), (True, 9, 15, last[:12] + "fir"), (True, 9, 15, last[:12] + "fir"),
    ]
    single = fp.fingerprint_documents(docs.where("doc_id = 7")).first()
    assert single["edited"] == "é" * 9 and single["next_sketch"] == single["sketch"]
    assert fp.fingerprint_documents(docs.limit(0)).count() == 0
