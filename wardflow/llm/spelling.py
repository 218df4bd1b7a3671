"""Spelling variants: words that differ by one inserted, deleted or replaced letter.

The vocabulary is dealt into buckets, and each bucket is searched through a bit-sliced position index: for
every (position, letter) one bitset over the words of the bucket. A query walks its letters once, and carries
for all words together the set that agrees so far and three sets with one error so far: a letter
replaced (same position), a letter more in the word (bitsets one position later) and a letter less (one
position earlier). Python's whole numbers serve as the bitsets, so a step works on machine words.

Buckets. Let m be the length of the shorter word of a near pair, u what both have in common at
the front and v at the end, apart from the error. Then |u| + |v| >= m - 1. A bucket (m, a, b, front, end)
holds the words of m and m + 1 letters that start with the a letters ``front`` and end with the b
letters ``end``. It finds the pairs with |u| >= a and |v| >= b. Such a pair also has |u| >= a + h or
|v| >= b + f - h + 1, where f = m - 1 - a - b and 1 <= h <= f, so the two buckets with those
lengths find it too. All words start in the two halves of the empty bucket; buckets of more than
``BUCKET`` words are halved again, until they fit or until f = 0, where only one or two letters are
open and the alphabet bounds the words. A pair is reported once: on the side of ``end`` only if its
common front is shorter than the other side asks for (``below``).

Defined results: a null text has no words; a null doc_id counts as empty text in the hash; whole texts
count, however long; repeated rows count each time; ties take the smallest word in code-point order;
an empty table, or one without frequent words, gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import slices, table, texts
from wardflow.session import durable

MIN_LETTERS = 5
MIN_COUNT = 3
#: One occurrence in so many loses a letter.
SLIP = 97
#: A form occurs so many times as often as the word.
RATIO = 2
BUCKET = 4096
RUN = re.compile("[A-Za-zÀ-ÿ]+")
WORD = "word string, n long"


def words_of(doc_id: int | None, text: str) -> Counter:
    """Occurrences of each word of a text, slips included, without a limit of length."""
    low = text.encode().lower().decode()  # bytes: only A-Z change
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found = Counter(RUN.findall(low))
    for run in [r for r in found if zlib.crc32(r.encode(), start) % SLIP == 0]:
        at = zlib.crc32(run.encode(), start) % len(run)
        found[run[:at] + run[at + 1 :], "slip"] += found.pop(run)  # apart from a run of that spelling
    return found


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, 2_000):
            total: Counter = Counter()
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"]):
                for word, n in words_of(doc_id, text).items():
                    word = word if isinstance(word, str) else word[0]
                    if len(word) >= min_letters:
                        total[word] += n
            yield pd.DataFrame({"word": list(total), "n": list(total.values())})

    rows = texts(docs)
    # Pandas would turn ids into floats where one is null.
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counted = rows.mapInPandas(work, WORD).groupBy("word").agg(F.sum("n").alias("n"))
    return durable(counted.where(F.col("n") >= min_count), "words")


# Columns of a bucket's key, besides the letters: see the docstring.
KEY = ("m", "a", "b", "below", "front", "end")


def _halves(rows: DataFrame) -> DataFrame:
    """The rows in the two smaller buckets of their bucket."""
    free = F.col("m") - 1 - F.col("a") - F.col("b")
    h = F.expr("(m - a - b) div 2").cast("int")

    def bucket(a, b, below):
        front, end = F.substring("word", F.lit(1), a), F.substring("word", F.char_length("word") - b + 1, b)
        parts = (F.col("m"), a.cast("int"), b.cast("int"), below.cast("int"), front, end)
        return F.struct(*[p.alias(name) for name, p in zip(KEY, parts)])

    both = F.array(
        bucket(F.col("a") + h, F.col("b"), F.col("below")),
        bucket(F.col("a"), F.col("b") + free - h + 1, F.least(F.col("below"), F.col("a") + h)),
    )
    return rows.select("word", "n", F.explode(both).alias("k")).select("word", "n", "k.*").where("a < below")


def buckets(words: DataFrame, limit: int = BUCKET) -> DataFrame:
    """(word, n, key columns): every word in its buckets, none above ``limit`` that can be halved."""
    length = F.char_length("word")
    start = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m"))
    start = start.select("*", *[F.lit(v).alias(c) for c, v in zip(KEY[1:], (0, 0, 1 << 30, "", ""))])
    rows, done = durable(_halves(start.where("m >= 2")), "buckets"), None
    while True:
        sizes = rows.groupBy(*KEY).agg(F.count("*").alias("size")).where((F.col("size") > limit) & (F.col("m") - 1 > F.col("a") + F.col("b")))
        large = durable(sizes.drop("size"), "large")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = durable(rows.join(large, list(KEY), "left_anti"), "buckets")
        done = small if done is None else done.unionByName(small)
        rows = durable(_halves(rows.join(large, list(KEY), "left_semi")), "buckets")


class PositionIndex:
    """Bitsets over a list of words, one for each (position, letter) and one for each length."""

    def __init__(self, words: list[str]):
        self.words = words
        self.letters: list[dict[str, int]] = []
        self.lengths: dict[int, int] = {}
        bit = 1
        for word in words:
            while len(self.letters) < len(word):
                self.letters.append({})
            for at, letter in zip(self.letters, word):
                at[letter] = at.get(letter, 0) | bit
            self.lengths[len(word)] = self.lengths.get(len(word), 0) | bit
            bit <<= 1
        self.every = bit - 1

    def near(self, query: str) -> list[int]:
        """Places of the words that one insertion, deletion or replacement makes of the query."""
        letters, last = self.letters, len(self.letters)
        same = self.every
        replaced = more = less = 0
        for i, letter in enumerate(query):
            here = letters[i].get(letter, 0) if i < last else 0
            ahead = letters[i + 1].get(letter, 0) if i + 1 < last else 0
            behind = letters[i - 1].get(letter, 0) if 0 < i <= last else 0
            # A word that ends early drops out by its length below.
            more = (more | same) & ahead
            less = (less & behind) | same
            replaced = (replaced & here) | (same & ~here)
            same &= here
            if not (same or replaced or more or less):
                return []
        n = len(query)
        found = replaced & self.lengths.get(n, 0) | (more | same) & self.lengths.get(n + 1, 0) | less & self.lengths.get(n - 1, 0)
        out = []
        while found:
            low = found & -found
            out.append(low.bit_length() - 1)
            found ^= low
        return out


def search(words: list[str], counts: list[int], m: int, below: int) -> Iterator[tuple[str, int, str, int]]:
    """(word, n, near word, its n) both ways for the near pairs of a bucket whose shorter word has m letters."""
    index = PositionIndex(words)
    for i, word in enumerate(words):
        if len(word) != m:
            continue
        for j in index.near(word):
            other = words[j]
            if len(other) < m or (len(other) == m and j < i) or len(commonprefix((word, other))) >= below:
                continue
            yield word, counts[i], other, counts[j]
            yield other, counts[j], word, counts[i]


def near_words(words: DataFrame, limit: int = BUCKET) -> DataFrame:
    """(word, n_near, best): number of near words, and ``best`` (-n, word) of the most frequent."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(key: tuple, held: list[tuple[str, int]]) -> Iterator[pd.DataFrame]:
            if len(held) > 1:
                near: dict[str, list] = {}
                for word, _, other, n in search([w for w, _ in held], [n for _, n in held], key[0], key[3]):
                    own = near.setdefault(word, [0, (0, "")])
                    own[0] += 1
                    own[1] = min(own[1], (-n, other))
                for word, (n_near, (low, other)) in near.items():
                    out["word"].append(word)
                    out["n_near"].append(n_near)
                    out["low"].append(low)
                    out["other"].append(other)
            if len(out["word"]) >= 10_000:
                yield pd.DataFrame(out)
                for column in out.values():
                    column.clear()

        out: dict[str, list] = {"word": [], "n_near": [], "low": [], "other": []}
        last, held = None, []
        for batch in batches:
            for *key, word, n in zip(*(batch[c].tolist() for c in (*KEY, "word", "n"))):
                if key != last:
                    if held:
                        yield from found(last, held)
                    last, held = key, []
                held.append((word, n))
        if held:
            yield from found(last, held)
        yield pd.DataFrame(out)

    dealt = buckets(words, limit).select(*KEY, "word", "n").repartition(*KEY).sortWithinPartitions(*KEY, "word")
    found = dealt.mapInPandas(work, "word string, n_near long, low long, other string")
    best = F.min(F.struct("low", "other")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)


def _roots(words: DataFrame) -> DataFrame:
    """(word, root) of the words with a form. Each round doubles the steps taken along the forms.

    Forms are at least twice as frequent as their words, so a chain has at most 63 steps, 6 rounds.
    """
    now = durable(words.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = durable(now.join(further, "root", "left").select("word", "root", "further"), "roots")
        now = step.select("word", F.coalesce("further", "root").alias("root"))
        if step.where("further is not null").isEmpty():
            return now


def variants(words: DataFrame, limit: int = BUCKET) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words (word, n)."""
    found = words.join(near_words(words, limit), "word", "left")
    fits = -F.col("best.low") >= RATIO * F.col("n")
    named = durable(
        found.select(
            "word",
            F.when(fits, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, -F.col("best.low")).alias("form_n"),
        ),
        "forms",
    )
    out = named.join(_roots(named), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))
