"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

1. quality: documents that the classifier scores below its threshold go. It learns from the labels
   of all folds but the one held out, and from at most ``TRAIN_ROWS`` of them.
2. near_duplicates: one document of each group of near copies stays, its smallest id: fingerprints of 3-word
   shingles link at 3 or fewer differing bits, and groups are the components of the links.
3. decontaminate: documents that contain a benchmark item go.
4. secrets: secrets are replaced in the texts, and ``n_chars`` is counted anew.
5. encode: token ids and the decoded text of each document that is left.

All stages but the last return the columns of ``documents`` as they came, extra ones included.
Each stage judges what its predecessor kept.

Defined results: null texts are empty; the operators' docstrings say what becomes of very long texts, ties and
repeated rows (one of them stays); an empty table passes through as an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import decontaminate, quality, secrets, simhash, word_bpe
from wardflow.llm.common import fold_of, table
from wardflow.session import work_folder, work_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SCORE = "__quality_score"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    usable = fold_of(F.col("doc_id"), quality.FOLDS) != quality.HELD_OUT
    model = quality.train(docs, table(spark, sf_dir, "labels"), usable)
    scored = quality.with_score(docs, model, SCORE)
    return scored.where(F.col(SCORE) >= quality.THRESHOLD).drop(SCORE)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, simhash.RADIUS, simhash.WIDTH)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_documents(docs, secrets.train(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return word_bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near),
    ("decontaminate", drop_benchmark),
    ("secrets", redact_secrets),
    ("encode", encode),
]

#: SQL can state neither a trained classifier nor tagged secrets: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the encoded rows of the documents kept.

    What a stage writes for itself is deleted once its result is stored.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{work_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for place, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{place}-{name}"
        with work_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
