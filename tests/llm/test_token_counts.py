"""Token counts against the tokenizers library, and merges against one at a time."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wardflow.llm.token_counts import Merges, TokenCounter, byte_symbols, count_tokens, op11_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n\n  x", "it's we'll I'D 'tis", "a" * 3000, "ab" * 1500, "  tail  ", "x<|endoftext|> y<|endoftext|>", "<|endoftext|>",
    "日本語 テキスト 123", "naïve café ÀÖ×÷", "e\u0301 \u00a0 \u2003 x", "\x00\x01\x7f", "🙂👍🏽 ok", "1234567 12a3", "\t\tif x:\r\n", "<|endoftext|", "ªº²",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as file:
        return TokenCounter(file.read())


def random_texts(seed, n):
    rng = random.Random(seed)
    marks = "aaaeettos  \n'.,1é\u00e0日\u0301<|"
    return ["".join(rng.choice(marks) for _ in range(rng.randrange(200))) for _ in range(n)]


def test_counts_equal_the_library(library, counter):
    rows = ODD + random_texts(3, 400)
    assert counter(rows) == [len(library.encode(t, add_special_tokens=False).ids) for t in rows]


def test_a_small_cache_changes_nothing(library, counter):
    rows = random_texts(4, 60)
    small = TokenCounter(library.to_str(), limit=20)
    assert [small([t])[0] for t in rows] == counter(rows)


def one_at_a_time(symbols, ranks, results):
    symbols = list(symbols)
    while True:
        found = min(((ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks), default=None)
        if found is None:
            return len(symbols)
        i = found[1]
        symbols[i : i + 2] = [results[symbols[i], symbols[i + 1]]]


def test_rounds_equal_merges_one_at_a_time():
    rng = random.Random(5)
    letters = byte_symbols()
    vocabulary = {c: i for i, c in enumerate(letters)}
    pairs, known = [], ["a", "b", "c"]
    while len(pairs) < 40:
        left, right = rng.choice(known), rng.choice(known)
        if left + right not in vocabulary:
            vocabulary[left + right] = len(vocabulary)
            pairs.append((left, right))
            known.append(left + right)
    merges = Merges(vocabulary, pairs)
    ranks = {(vocabulary[a], vocabulary[b]): r for r, (a, b) in enumerate(pairs)}
    results = {(vocabulary[a], vocabulary[b]): vocabulary[a + b] for a, b in pairs}
    rows = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 60))) for _ in range(300)] + ["a" * k for k in range(1, 20)]
    found = merges.counts("".join(rows).encode(), np.array([len(r) for r in rows]))
    assert found.tolist() == [one_at_a_time([vocabulary[c] for c in r], ranks, results) for r in rows]


def test_a_pair_of_later_parts_is_refused():
    letters = byte_symbols()
    vocabulary = {c: i for i, c in enumerate([*letters, "ab", "abc"])}
    with pytest.raises(ValueError):
        Merges(vocabulary, [("ab", "c"), ("a", "b")])


def test_nulls_repeats_and_extra_columns(spark, library):
    rows = [(1, None, "x"), (1, "same text", "x"), (1, "same text", "y"), (None, "<|endoftext|>", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = sorted(map(tuple, count_tokens(docs, PATH).collect()), key=str)
    assert found == sorted([(1, 0, 0), (1, 9, 2), (1, 9, 2), (None, 13, 1)], key=str)
    assert count_tokens(docs.limit(0), PATH).count() == 0


def test_query_equals_the_library(spark, folder, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = op11_token_counts(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        n = len(library.encode(texts[row["doc_id"]], add_special_tokens=False).ids)
        assert tuple(row) == (row["doc_id"], len(texts[row["doc_id"]].encode()), n, n > 512)
