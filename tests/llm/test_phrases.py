"""Phrase mining against counting everything, with odd texts, failing samples and large numbers."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import phrases
from wardflow.llm.phrases import Members, collocations, phrase_hash, segments

SCHEMA = "doc_id long, text string, lang string, rank string"


def slowly(rows, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting all phrases."""
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= 10}
    found = []
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        holders = [f for (other, w), f in candidates.items() if other == lang and len(w) > len(words) and words in (w[:2], w[1:])]
        if not any(100 * f >= 50 * a for f in holders):
            score, _, left, right = min(cuts)
            found.append((lang, -score, -a, " ".join(words).encode(), left, right))
    out, place = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        place[lang] += 1
        if place[lang] <= top:
            out.append((lang, place[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return sorted(map(tuple, collocations(docs, **options).collect()))


def corpus(seed, n=900):
    rng = random.Random(seed)
    words = ["the", "The", "of", "New", "york", "city", "é", "É", "x y", "a", "b", "c"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "; ", "!?"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(30)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None, "und", ""])))
    return rows + [(None, None, "en"), (None, "", None), (1, "new york city " * 40, "en"), (1, "new york city " * 40, "en"), (2, " .;\n", "de")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_counting_everything(spark, seed):
    rows = corpus(seed)
    found = mined(spark, rows)
    assert found == sorted(slowly(rows)) and len(found) > 20


def test_first_rows_only(spark):
    rows = corpus(3)
    assert mined(spark, rows, top=5) == sorted(slowly(rows, top=5))


def test_empty_tables(spark):
    assert mined(spark, []) == [] == mined(spark, [(1, "only once here", "en")])


def test_a_failed_sample_costs_passes_not_results(spark, monkeypatch):
    """Phrases that the sample never saw come by way of the border, in further passes."""
    rows = [(i, "rare pair here", "en") for i in range(400)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    drawn = {r["doc_id"] for r in docs.withColumn("d", F.expr("pmod(xxhash64(doc_id, text), 4)")).where("d = 0").collect()}
    rows = [r for r in rows if r[0] not in drawn]
    passes, count = [], phrases._count
    monkeypatch.setattr(phrases, "_count", lambda *a: passes.append(1) or count(*a))
    found = mined(spark, rows)
    assert found == slowly(rows) and [r[2] for r in found] == ["rare pair here"]
    assert len(passes) == 3


def test_full_bits_change_nothing(spark, monkeypatch):
    """With every bit set all phrases are counted."""
    monkeypatch.setattr(phrases, "_set_bits", lambda hashes, n: np.full(n // 8, 255, dtype=np.uint8))
    rows = corpus(4, 100)
    assert mined(spark, rows) == sorted(slowly(rows))


def test_long_texts_in_segments(monkeypatch):
    """Phrases that cross the end of a segment count once."""
    rng = random.Random(6)
    words = [rng.choice("abcd") for _ in range(1000)]
    text = "".join(w + rng.choice([" ", " ", "\t ", ". "]) for w in words)

    def counted(size):
        monkeypatch.setattr(phrases, "SEGMENT", size)
        out = Counter()
        for part in segments([text, text[:99]], "en"):
            for width, places in ((2, part.second), (3, part.third)):
                ids, counts = part.counted(width, places)
                for row in zip(*(i.tolist() for i in ids), counts.tolist()):
                    out[tuple(part.words[i] for i in row[:-1])] += row[-1]
        return out

    assert counted(1 << 20) == counted(1) == counted(7) == counted(333)


def test_members_and_hashes():
    members = Members(np.zeros(1 << 17, dtype=np.uint8))
    (part,) = segments(["New York"], "en")
    hashes = [phrase_hash("new", "en"), phrase_hash("york", "en"), phrase_hash("new york", "en")]
    assert hashes == [*part.hashes.tolist(), *part.pairs.tolist()] and hashes[0] != phrase_hash("new", "fr")
    at = hashes[2] & int(members.mask)
    members.bits[at >> 3] |= 1 << (at & 7)
    assert hashes[2] in members and hashes[0] not in members


def test_scores_are_exact(spark):
    rng = random.Random(7)
    rows = [(a := rng.randrange(1, 10**e), a + rng.randrange(10**e), a + rng.randrange(10**e)) for e in (3, 9, 12, 15) for _ in range(50)]
    rows += [(10**15, 10**15, 10**15), (3, 3, 4), (10**15 - 1, 10**15, 10**15)]
    found = spark.createDataFrame(rows, "a long, l long, r long").selectExpr("a", "l", "r", f"{phrases.SCORE} AS score")
    for a, left, right, score in found.collect():
        assert score == 1000000 * a * a // (left * right)
