"""Spelling variants against comparing all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from wardflow.llm.spelling import PositionIndex, buckets, op13_spelling, variants, vocabulary

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def near(x, y):
    """One inserted, deleted or replaced letter makes y of x."""
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    short, long = sorted((x, y), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted(rows):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def slowly(words):
    out = {}
    for word, n in words.items():
        others = sorted((-words[w], w) for w in words if near(word, w))
        form = others[0][1] if others and -others[0][0] >= 2 * n else None
        out[word] = (form, n, len(others), words[form] if form else None)
    rows = []
    for word, (form, n, n_near, form_n) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        rows.append((word, form, root, n, n_near, form_n))
    return sorted(rows)


def found(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


def random_words(seed, n, letters="abé", low=4, high=9):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(low, high))) for _ in range(n)}
    return {w: rng.choice([1, 1, 2, 3, 4, 8, 20, 300]) for w in words} | {"a" * k: k for k in range(2, 12)}


def test_index_finds_what_comparing_finds():
    words = sorted(random_words(1, 400, "ab", 1, 9))
    index = PositionIndex(words)
    for query in [*words, "", "a", "zzz", "b" * 20]:
        assert [words[i] for i in index.near(query)] == [w for w in words if near(query, w)]


@pytest.mark.parametrize("limit", [4096, 20, 2])
def test_variants_equal_comparing_all_pairs(spark, limit):
    """Also with buckets so small that most are halved down to one open letter."""
    words = random_words(2, 500)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(variants(frame, limit)) == slowly(words)


def test_a_hot_bucket_is_halved(spark):
    """Words that share their first letters do not stay in one bucket."""
    rng = random.Random(3)
    words = {"shared" + "".join(rng.choice("abcdefgh") for _ in range(6)): 1 for _ in range(600)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    sizes = buckets(frame, 50).groupBy("m", "a", "b", "below", "front", "end").count().where("m - 1 > a + b")
    assert sizes.agg({"count": "max"}).first()[0] <= 50
    assert found(variants(frame, 50)) == slowly(words)


def test_long_chains_of_forms(spark):
    words = {"x" * 6 + "abcdefgh"[:i] + "y" * (8 - i): 3 * 2**i for i in range(9)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = found(variants(frame))
    assert rows == slowly(words) and {r[2] for r in rows} == {"x" * 6 + "abcdefgh"}


def test_odd_rows(spark):
    text = "Ärger ärger ÄRGER colour color COLOR color×es naıve it's tea " * 40
    rows = [(None, text), (1, text), (1, text), (-5, None), (7, ""), (2, "colors " * 4), (None, "colours colours colours")]
    rows += [(i, "writing writen written") for i in range(400)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, word string")
    frame = vocabulary(docs)
    assert dict(map(tuple, frame.collect())) == counted(rows)
    assert found(variants(frame)) == slowly(counted(rows))
    assert found(variants(vocabulary(docs.limit(0)))) == []


def test_query_equals_comparing(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert found(op13_spelling(spark, folder)) == slowly(counted(rows))
