"""The pipeline against plain Python, and its stages on odd tables."""

from __future__ import annotations

import pytest

import corpus_pipeline
from test_near import slow_components, slow_simhash
from wardflow.llm import decontaminate, quality, secrets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string"


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """What each stage made of the small table."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, folder).write.parquet(path)
        out[name] = (docs, docs := spark.read.parquet(path))
    return out


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_stages_keep_columns(stages, spark, folder):
    columns = spark.read.parquet(f"{folder}/documents.parquet").dtypes
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "encode"]
    assert all(stages[name][1].dtypes == columns for name in list(stages)[:-1])


def test_quality_drops_low_scores(stages, spark, folder):
    before, after = map(by_id, stages["quality"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    known = [i for i in before if i in labels]
    right = sum((i in after) == (labels[i] == 1) for i in known)
    assert right >= 0.9 * len(known)
    assert all(after[i]["text"] == before[i]["text"] for i in after)


def test_one_of_each_group(stages):
    before, after = stages["near_duplicates"]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    fps = [slow_simhash(t) for _, t in rows]
    assert set(by_id(after)) == {rows[c][0] for c in slow_components(fps)}


def shingles(text):
    words = text.lower().split()
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def test_no_document_holds_an_item(stages, spark, folder):
    before, after = map(by_id, stages["decontaminate"])
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {i for i, r in before.items() if not any(len(x & shingles(r["text"])) >= 0.8 * len(x) for x in items if x)}
    assert set(after) == clean and len(clean) < len(before)


def test_secrets_are_gone(stages):
    before, after = map(by_id, stages["secrets"])
    assert set(before) == set(after)
    for i, row in after.items():
        own = secrets.pattern_spans(before[i]["text"].encode())
        assert row["n_chars"] == len(row["text"])
        assert ("[SECRET]" in row["text"]) >= bool(own)
        if not own and "[SECRET]" not in row["text"]:
            assert row["text"] == before[i]["text"]
        assert not [s for s in secrets.pattern_spans(row["text"].encode()) if s[1] > 0]


def test_encoded_rows(stages):
    before, after = stages["encode"]
    assert sorted(by_id(after)) == sorted(by_id(before))
    assert set(after.columns) == {"doc_id", "n_tokens", "ids", "decoded"}
    assert all(len(r["ids"].split()) == r["n_tokens"] for r in after.collect())


def test_odd_tables(spark, folder):
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1.0, "x"), (2, "plain words of a clean text", "en", "s", 27, 1.0, "x"), (2, "plain words of a clean text", "en", "s", 27, 1.0, "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            found = stage(spark, table, folder)
            assert name == "encode" or found.columns == docs.columns
            assert (found.count() > 0) == (table is docs) or name == "quality"
    assert {tuple(r) for r in secrets.redact_documents(docs, None).collect()} == {tuple(r) for r in rows}
