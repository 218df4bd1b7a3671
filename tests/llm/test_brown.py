"""Brown classes: the base score by hand, exchange against brute force, held-out perplexity."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wardflow.llm import brown


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def base_scores(rows):
    train = Counter()
    for i, text in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 10:
            train.update([*words(text), None])
    total, distinct = sum(train.values()), len(train)
    for i, text in rows:
        own = [*words(text), None]
        yield i, len(own), sum(train[t] > 0 for t in own), total, sum(math.log10((train[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)


def test_small_table(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    wanted = {i: own for i, *own in base_scores(rows)}
    found = {r["doc_id"]: r for r in brown.op4_brown_lm(spark, folder).collect()}
    assert set(found) == set(wanted)
    for i, (n, known, total, score) in wanted.items():
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_add_up(spark):
    """Over all seen words, the unseen one of each fixed class and the end, after any class."""
    texts = ["a b a b c", "a c dddd!", "b a 12 ééé"] * 3 + ["rare once"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, rest = brown.fit(docs, brown.F.lit(True), classes=2, clustered=0.1, shared=0.05)
    k = model.words.classes
    mass = np.zeros(k + brown.FIXED + 1)
    shared_class = [model.classes[p] if p < model.words.clustered else k + brown.fixed_class(w) for w, p in model.words.places.items()]
    for c, e in zip(shared_class, model.emit):
        mass[c] += 10**e
    for r in rest.collect():
        c = k + brown.fixed_class(bytes(r["word"]))
        mass[c] += 10 ** (math.log10(r["n"] + 0.1) - model.class_total[c])
    mass[k : k + brown.FIXED] += 0.1 / 10 ** model.class_total[k : k + brown.FIXED]
    used = [c for c in range(k) if c in shared_class] + list(range(k, k + brown.FIXED))
    assert mass[used] == pytest.approx(np.ones(len(used)))
    assert (10**model.move).sum(axis=1) == pytest.approx(np.ones(k + brown.FIXED + 1))


def test_units_of_a_text():
    """All words at once: shared ones by place, the others by the fixed class that each has alone."""
    own = brown.tokens_of("The cat, 12 7z \x00 é an-extraordinarily-long-word the 1 Ω9 {")
    words = brown.Vocabulary({b"the": 0, b"cat,": 1}, np.array([2.0, 1.0]), 2, 2, 1)
    places, units = words.units(own)
    assert places.tolist() == [0, 1] + [-1] * 5 + [0] + [-1] * 3
    fixed = [1 + brown.fixed_class(w) for w in own]
    assert units.tolist() == [words.end, 0, *fixed[1:7], 0, *fixed[8:], words.end]
    assert brown.fixed_classes(own).tolist() == [f - 1 for f in fixed]
    assert [x.tolist() for x in words.units([])] == [[], [words.end] * 2]


def likelihood(counts):
    return brown._xlogx(counts).sum() - brown._xlogx(counts.sum(axis=0)).sum() - brown._xlogx(counts.sum(axis=1)).sum()


def test_gain_of_a_move():
    rng = np.random.default_rng(4)
    pairs = rng.integers(0, 9, (9, 9)).astype(float)
    np.fill_diagonal(pairs, 0)  # the gain counts a word beside itself only when it leaves
    classes = np.arange(9) % 3

    def table(classes):
        out = np.zeros((3, 3))
        np.add.at(out, (classes[:, None].repeat(9, 1), classes[None].repeat(9, 0)), pairs)
        return out

    for w in range(9):
        after = np.array([pairs[w, classes == c].sum() for c in range(3)])
        before = np.array([pairs[classes == c, w].sum() for c in range(3)])
        best, gain = brown.best_class(table(classes), classes[w], after, before, 0.0, 3)
        tries = [likelihood(table(np.where(np.arange(9) == w, c, classes))) for c in range(3)]
        assert gain >= 0 and abs(gain - (tries[best] - tries[classes[w]])) < 3.0
        assert tries[best] >= max(tries) - 3.0


def test_exchange_finds_classes(spark):
    """Words of two kinds that always alternate end up in two classes."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{'nv'[k % 2]}{rng.integers(0, 12)}x" for k in range(30)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, _ = brown.fit(docs, brown.F.lit(True), classes=2, rounds=12)
    kinds = {kind: Counter(int(model.classes[p]) for w, p in model.words.places.items() if w[:1] == kind) for kind in (b"n", b"v")}
    assert kinds[b"n"].most_common(1)[0][0] != kinds[b"v"].most_common(1)[0][0]
    assert all(max(c.values()) >= 0.9 * sum(c.values()) for c in kinds.values())


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, 2), (None, "A b", 2), (None, "A b", 2), (3, "a b", 2), (3, "x" * 5000, 2), (4, "\x00 é", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = brown.op4_brown_lm(spark, str(tmp_path)).collect()
    wanted = sorted(((i, n, k) for i, n, k, _, _ in base_scores([r[:2] for r in rows])), key=repr)
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"]) for r in found), key=repr) == wanted
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert brown.op4_brown_lm(spark, f"{tmp_path}/none").count() == 0


def test_words_seen_twice_have_a_class(spark):
    """Words under ``clustered`` too, shared or not, by the words before them; a text's score by hand."""
    rng = np.random.default_rng(6)
    own = lambda k: f"{'nv'[k % 2]}{rng.integers(0, 6)}x"
    texts = [" ".join(own(k) for k in range(30)) for _ in range(200)]
    rare = {f"r{j}y": j % 2 for j in range(40)}  # after v like an n, or after n like a v
    texts += [f"{own(1 - kind)} {w} {own(kind + 1)}" for w, kind in rare.items() for _ in range(2)] + ["n1x once!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for shared in (1e-6, 0.01):
        model, rest = brown.fit(docs, brown.F.lit(True), classes=2, clustered=0.01, shared=shared)
        words = {w: (model.words.counts[p], int(model.classes[p]), model.emit[p]) for w, p in model.words.places.items()}
        for r in rest.collect():
            words[bytes(r["word"])] = (r["n"], r["class"], math.log10(r["n"] + 0.1) - model.class_total[r["class"]])
        kinds = {w[:1]: c for w, (_, c, _) in words.items() if w[:1] in b"nv"}
        assert {kinds[b"n"], kinds[b"v"]} == {0, 1}
        assert sum(words[w.encode()][1] == kinds[b"nv"[k : k + 1]] for w, k in rare.items()) >= 36
        assert words[b"once!"][:2] == (1, 2 + brown.fixed_class(b"once!"))
        scored = {r["doc_id"]: r["score"] for r in brown.score(docs, model, rest).collect()}
        end = 2 + brown.FIXED
        for i in (0, 205, len(texts) - 1):
            before, total = end, 0.0
            for w in texts[i].encode().split():
                total += model.move[before, words[w][1]] + words[w][2]
                before = words[w][1] if words[w][0] >= 60 else 2 + brown.fixed_class(w)
            assert scored[i] == pytest.approx(total + model.move[before, end])


def test_many_texts_at_once():
    """Words, their classes and the units of many texts as those of each alone, from a part of a batch too."""
    texts = ["left out", "", " a  B\x0bc ", "\x1ca\x1f\x85 a", "\t\r\n", "Ω9 {\x00 7z", "a " * 50, ""]
    column = brown.pa.array(texts).slice(1)
    own = [brown.tokens_of(t) for t in texts[1:]]
    tokens = brown.cut(column)
    listed = tokens.words.to_pylist()
    assert [[listed[c] for c in tokens.codes[tokens.of == k]] for k in range(len(own))] == own
    assert len(set(listed)) == len(listed) == len(set().union(*own))
    for k in range(len(listed)):
        assert brown.fixed_classes(tokens.words.slice(k)).tolist() == [brown.fixed_class(w) for w in listed[k:]]
    words = brown.Vocabulary({b"a": 0, b"7z": 1}, np.array([2.0, 1.0]), 2, 2, 1)
    wanted = np.concatenate([[words.end], *(words.units(o)[1][1:] for o in own)])
    assert words.line(tokens)[2].tolist() == wanted.tolist()


def test_pieces_hold_every_text():
    texts = ["x" * n for n in (0, 5, 3 * brown.PIECE // 2, 1, 0, brown.PIECE - 1, 2, 0)]
    batch = brown.pa.RecordBatch.from_pydict({"text": brown.pa.array(texts)})
    found = [p["text"].to_pylist() for p in brown.pieces(iter([batch, batch.slice(0, 0), batch.slice(3)]))]
    assert sum(found, []) == texts + texts[3:]
    assert all(len(p) == 1 or sum(map(len, p)) <= brown.PIECE for p in found)


def test_tally_over_pieces():
    rng = np.random.default_rng(7)
    for size, kinds in ((1, 40), (49, 40), (49, 3)):
        tally, wanted = brown.Tally(size), Counter()
        for _ in range(3):
            words = [b"w%d" % k for k in rng.permutation(60)[:kinds]]
            codes, second = rng.integers(0, kinds, 500), rng.integers(0, size, 500)
            tally.add(brown.pa.array(words, brown.pa.binary()), codes, second)
            wanted.update(zip([words[c] for c in codes], second.tolist()))
        found, second, n = tally.take()
        assert dict(zip(zip(found.to_pylist(), second.tolist()), n.tolist())) == wanted
        assert len(found) == len(wanted) and len(tally.take()[0]) == 0


def test_neighbours_of_each_word(spark):
    """One row for each exchanged word, with all its pairs, so that no round has to shuffle them."""
    words = brown.Vocabulary({b"a": 0, b"b": 1, b"c": 2}, np.ones(3), 3, 2, 3)
    size = words.end + 1
    pairs = {(0, 0): 4, (0, 1): 2, (1, 0): 3, (words.end, 1): 5, (1, 4): 7, (4, words.end): 6}
    bigrams = spark.createDataFrame([(a * size + b, n) for (a, b), n in pairs.items()], "pair long, n long")
    found = {r["unit"]: sorted(zip(r["others"], r["ns"])) for r in brown.neighbours(bigrams, words).collect()}
    own = lambda w: sorted([(b, n) for (a, b), n in pairs.items() if a == w] + [(a + size, n) for (a, b), n in pairs.items() if b == w])
    assert found == {0: own(0), 1: own(1)}


def test_places_of_frequent_words(spark):
    """Counts looked up and counts too large for that: the class that most raises the likelihood of the contexts."""
    rng = np.random.default_rng(8)
    moves = rng.integers(0, 90, (20, 20)).astype(float)
    rows = []
    for k in range(60):
        slots = rng.permutation(20)[: 1 + k % 9]
        totals = rng.integers(1, 9 if k % 2 else 400, len(slots))
        rows.append((b"w%d" % k, slots.tolist(), totals.tolist(), int(totals.sum())))
    docs = spark.createDataFrame(rows, "word binary, slots array<int>, totals array<long>, n long")
    found = {bytes(r["word"]): r["class"] for r in brown.place(docs, moves, 3).collect()}
    for word, slots, totals, n in rows:
        gain = [sum(brown._xlogx(moves[s, c] + t) - brown._xlogx(moves[s, c]) for s, t in zip(slots, totals)) for c in range(3)]
        gain -= brown._xlogx(moves[:, :3].sum(axis=0) + n) - brown._xlogx(moves[:, :3].sum(axis=0))
        assert found[word] == (gain.argmax() if n > 1 else 3 + brown.fixed_class(word))


def test_scores_without_sorting_words(spark):
    docs = spark.createDataFrame([(1, "a b a c"), (2, "b a d")], "doc_id long, text string")
    model, rest = brown.fit(docs, brown.F.lit(True), classes=2, clustered=0.2, shared=0.2)
    plan = brown.score(docs, model, rest)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
