"""LM scoring with Brown classes: word classes by exchange, class transitions, word emissions.

A text's words are followed by one end token, and an end precedes the first word. The model is
P(class | context before) * P(word | class), both with additive smoothing; the score of a text is
the log10 probability of its tokens, and perplexity follows from sums of scores and tokens.

Classes. Words that make up at least ``clustered`` of the training words (so no more than
1 / clustered of them) are put into ``classes`` classes by exchange: each word moves to the class that most
raises the likelihood of the class bigrams. All moves of a round are judged in parallel against the
same counts, even and odd words in turn, until the likelihood has settled. Every other word seen twice or more is
then placed once, by the contexts before it, in the one of these classes that most raises the likelihood. Words seen
once, like unseen ones, have one of 16 fixed classes by length and last character. The end is a class of its own.
As a context a clustered word counts by its class, every other word by its fixed class, so a text needs the classes
of its rarer words only one at a time, where the join finds them.

Counts cover all training texts. Counts of words above ``shared`` of the training words are broadcast
(no more than 1 / shared words); all other words of a text meet their counts in a join, in which by that bound
no key is hot. Texts are never shuffled. Tasks cut many texts into words at once, and look at each distinct word once a piece.

Defined results: a null text is empty and holds the end alone; a null doc_id counts as the empty
text in the fold; without training texts every count is zero; repeated rows are scored
each; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import fold_of, table, texts
from wardflow.session import durable

CLUSTERED = 1e-5
SHARED = 1e-6
CLASSES = 32
FIXED = 16
#: A bound; the exchange stops when a round of each half has raised the log10 likelihood per token by less than this.
#: Moves alone don't end: words judged against the same counts may go back and forth.
ROUNDS = 40
SETTLED = 0.0005
ADD = 0.1
ADD_MOVE = 0.5
FOLDS, HELD_OUT = 10, 0
#: Bytes of text that are cut into words at once, counts that a task holds before it sends them, and rows sent at once.
PIECE, HELD, SENT = 2_000_000, 1_000_000, 100_000


def tokens_of(text: str) -> list[bytes]:
    """Words without the end; A-Z count as lower case."""
    return text.encode().lower().split()


def fixed_class(word: bytes) -> int:
    last = word[-1]
    kind = 0 if 97 <= last < 123 else 1 if 48 <= last < 58 else 2 if last < 128 else 3
    return min(len(word) // 4, 3) * 4 + kind


def fixed_classes(words: pa.Array | list[bytes]) -> np.ndarray:
    """``fixed_class`` of many words."""
    if not len(words):
        return np.empty(0, dtype=np.int64)
    words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
    bounds = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    last = np.frombuffer(words.buffers()[2], dtype=np.uint8)[bounds[1:] - 1]
    kind = np.select([(last >= 97) & (last < 123), (last >= 48) & (last < 58), last < 128], [0, 1, 2], 3)
    return np.minimum(np.diff(bounds) // 4, 3) * 4 + kind


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows with about ``PIECE`` bytes of text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
            yield batch.slice(at, until - at)
            at = until
    pa.default_memory_pool().release_unused()  # worker processes outlive tasks


def sent(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    """The columns as batches of ``SENT`` rows."""
    batch = pa.RecordBatch.from_pydict(columns)
    for at in range(0, len(batch), SENT):
        yield batch.slice(at, SENT)


@dataclass
class Tokens:
    """The words of many texts: the distinct ones, and for each token its word's number in them and its text's number."""

    words: pa.Array
    codes: np.ndarray
    of: np.ndarray
    texts: int

    @property
    def places(self) -> np.ndarray:
        """Where the tokens stand when an end precedes the first text and one follows each."""
        return np.arange(len(self.codes)) + self.of + 1


def cut(texts: pa.Array) -> Tokens:
    """``tokens_of`` many texts at once."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # the white space of bytes.split(); empty words at both ends
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    words = coded.dictionary.cast(pa.binary())
    empty = pc.index(words, pa.scalar(b"", pa.binary())).as_py()
    if empty >= 0:
        real = codes != empty
        codes, of = codes[real], of[real]
        codes -= codes > empty
        words = pa.concat_arrays([words.slice(0, empty), words.slice(empty + 1)])
    return Tokens(words, codes, of, len(texts))


class Tally:
    """Counts by word and a second number under ``size``, added up over the pieces of a task."""

    def __init__(self, size: int = 1):
        self.size, self.words, self.keys, self.n, self.types, self.rows = size, [], [], [], 0, 0

    def add(self, words: pa.Array, codes: np.ndarray, second: np.ndarray | int = 0) -> None:
        """One for each of ``codes``, which number ``words``, and the second numbers beside them."""
        keys, n = np.unique(codes * self.size + second, return_counts=True)
        self.words.append(words)
        self.keys.append(keys + self.types * self.size)
        self.n.append(n)
        self.types += len(words)
        self.rows += len(keys)

    def take(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Words, second numbers and counts so far; the tally is empty then."""
        if not self.words:
            return pa.array([], pa.binary()), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        coded = pa.concat_arrays(self.words).dictionary_encode()
        keys, n, several = np.concatenate(self.keys), np.concatenate(self.n), len(self.words) > 1
        self.__init__(self.size)
        if several:
            keys, n = add_up(coded.indices.to_numpy()[keys // self.size].astype(np.int64) * self.size + keys % self.size, n)
        return coded.dictionary.take(pa.array(keys // self.size)), keys % self.size, n


def count_words(training: DataFrame) -> DataFrame:
    """(word, n) of all training texts, added up in each task before the shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def frame() -> Iterator[pa.RecordBatch]:
            words, _, n = tally.take()
            yield from sent({"word": words, "n": pa.array(n, pa.int64())})

        for piece in pieces(batches):
            tokens = cut(piece["text"])
            tally.add(tokens.words, tokens.codes)
            if tally.rows > HELD:
                yield from frame()
        yield from frame()

    return training.select("text").mapInArrow(work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Shared words by falling count: the first ``exchanged`` have classes by exchange, all of the first ``clustered`` one that is not fixed."""

    places: dict[bytes, int]
    counts: np.ndarray
    clustered: int
    classes: int
    exchanged: int

    @property
    def end(self) -> int:
        """The end's place among the units of bigrams: exchanged words, fixed classes, end."""
        return self.exchanged + FIXED

    @cached_property
    def listed(self) -> pa.Array:
        return pa.array(list(self.places), pa.binary())

    def units(self, words: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places of words (-1 where not shared), and their units between two ends."""
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        places = pc.fill_null(pc.index_in(words, value_set=self.listed), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        units = np.full(len(words) + 2, self.end, dtype=np.int64)
        units[1:-1] = np.where((places < 0) | (places >= self.exchanged), self.exchanged + fixed_classes(words), places)
        return places, units

    def line(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``units`` of the distinct words, without the ends, and the units of all texts, an end before the first and after each."""
        places, units = self.units(tokens.words)
        out = np.full(len(tokens.codes) + tokens.texts + 1, self.end, dtype=np.int64)
        out[tokens.places] = units[1:-1][tokens.codes]
        return places, units[1:-1], out

    def start_classes(self) -> np.ndarray:
        """Class of each unit: words dealt out by rank; fixed classes and the end after them."""
        own = np.arange(self.exchanged) % self.classes
        return np.concatenate([own, self.classes + np.arange(FIXED + 1)]).astype(np.int16)


def count_bigrams(training: DataFrame, vocabulary) -> DataFrame:
    """(pair, n): pairs of units as first * units + second."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        size = words.end + 1
        held, rows = [], 0

        def frame() -> Iterator[pa.RecordBatch]:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            yield from sent({"pair": pa.array(pairs), "n": pa.array(n)})

        for piece in pieces(batches):
            tokens = cut(piece["text"])
            units = words.line(tokens)[2]
            held.append(units[:-1] * size + units[1:])
            rows += len(units)
            if rows > HELD:
                yield from frame()
                held, rows = [], 0
        if held:
            yield from frame()

    return training.select("text").mapInArrow(work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def add_up(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) and keys.max() < 2 * len(keys):
        dense = np.bincount(keys, n)
        unique = np.flatnonzero(dense)
        return unique, dense[unique].astype(np.int64)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(n, starts) if len(n) else n


def class_counts(bigrams: DataFrame, size: int, classes: np.ndarray) -> np.ndarray:
    """Bigram counts of classes; each task sends at most one row per pair of classes."""
    shared = bigrams.sparkSession.sparkContext.broadcast(classes)
    k = int(classes.max()) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, out = shared.value.astype(np.int64), np.zeros(k * k)
        for batch in batches:
            pair = batch["pair"].to_numpy()
            first = pair // size
            out += np.bincount(own[first] * k + own[pair - first * size], batch["n"].to_numpy(), k * k)
        keys = np.flatnonzero(out)
        yield from sent({"key": pa.array(keys), "n": pa.array(out[keys].astype(np.int64))})

    found = bigrams.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(k * k)
    for row in found:  # k * k at most
        out[row["key"]] = row["n"]
    return out.reshape(k, k)


def _xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0.0)
    return x * np.log(np.where(x > 0, x, 1.0))


def best_class(counts: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, twice: float, classes: int) -> tuple[int, float]:
    """The class that a word should move to, and the gain in log likelihood.

    ``after`` and ``before`` count the classes of the word's neighbours, ``twice`` the word beside itself.
    """
    rest = counts.copy()
    rest[own] -= after
    rest[:, own] -= before
    rest[own, own] += twice
    rows, cols = rest[:classes], rest[:, :classes].T
    gain = (_xlogx(rows + after) - _xlogx(rows)).sum(axis=1) + (_xlogx(cols + before) - _xlogx(cols)).sum(axis=1)
    for sums, more in ((rest.sum(axis=1)[:classes], after.sum()), (rest.sum(axis=0)[:classes], before.sum())):
        gain -= _xlogx(sums + more) - _xlogx(sums)
    best = int(gain.argmax())
    return best, float(gain[best] - gain[own])


def neighbours(bigrams: DataFrame, words: Vocabulary) -> DataFrame:
    """(unit, others, ns) of the exchanged words: the units after one and, ``size`` higher, those before it, each at most ``size``."""
    size = words.end + 1
    first, second = F.expr(f"pair div {size}"), F.col("pair") % size
    sides = F.array(F.struct(first.alias("unit"), second.alias("other"), "n"), F.struct(second.alias("unit"), (first + size).alias("other"), "n"))
    rows = bigrams.select(F.inline(sides)).where(F.col("unit") < words.exchanged)
    rows = rows.groupBy("unit").agg(F.collect_list(F.struct(F.col("other").cast("int").alias("other"), "n")).alias("own"))
    return rows.select("unit", F.col("own.other").alias("others"), F.col("own.n").alias("ns"))


def exchange(bigrams: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units once they have settled, or after ``rounds`` rounds, and the bigram counts of classes."""
    spark, size, classes = bigrams.sparkSession, words.end + 1, words.start_classes()
    k, n_classes = words.classes + FIXED + 1, words.classes
    width, reached = 2 * k + 1, []
    beside = durable(neighbours(bigrams, words), "neighbours")
    for turn in range(rounds + 1):
        counts = class_counts(bigrams, size, classes)
        gained = _xlogx(counts).sum() - _xlogx(counts.sum(axis=0)).sum() - _xlogx(counts.sum(axis=1)).sum()
        reached.append(gained / max(counts.sum(), 1.0) / math.log(10))
        if turn == rounds or turn > 1 and reached[-1] - reached[-3] < SETTLED:
            break
        shared = spark.sparkContext.broadcast((classes, counts))

        def judge(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own, counts = shared.value
            slots = np.concatenate([own, own.astype(np.int64) + k])
            for batch in batches:
                moved = []
                for word, others, ns in zip(batch["unit"].to_pylist(), batch["others"], batch["ns"]):
                    others, ns = others.values.to_numpy(), ns.values.to_numpy()
                    row = np.bincount(slots[others], ns, width)
                    row[-1] = ns[others == word].sum()
                    best, gain = best_class(counts, int(own[word]), row[:k], row[k : 2 * k], row[-1], n_classes)
                    if gain > 1e-6 and best != own[word]:
                        moved.append((word, best))
                words, to = np.array(moved, dtype=np.int64).reshape(-1, 2).T
                yield from sent({"word": pa.array(words), "class": pa.array(to)})

        moves = beside.where(F.col("unit") % 2 == turn % 2).mapInArrow(judge, "word long, class long").collect()  # at most 1 / clustered words
        classes = classes.copy()
        for move in moves:
            classes[move["word"]] = move["class"]
    return classes, counts


def count_contexts(training: DataFrame, vocabulary, contexts: np.ndarray) -> DataFrame:
    """(word, slots, totals, n) of the words that are not exchanged: how often each context stands before them."""
    shared = training.sparkSession.sparkContext.broadcast(contexts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own = vocabulary.value, shared.value
        tally = Tally(int(own.max()) + 1)

        def frame() -> Iterator[pa.RecordBatch]:
            found, slots, n = tally.take()
            yield from sent({"word": found, "slot": pa.array(slots, pa.int32()), "n": pa.array(n, pa.int64())})

        for piece in pieces(batches):
            tokens = cut(piece["text"])
            _, units, line = words.line(tokens)
            rare = units >= words.exchanged
            at = np.flatnonzero(rare[tokens.codes])
            number = np.cumsum(rare) - 1
            tally.add(tokens.words.filter(pa.array(rare)), number[tokens.codes[at]], own[line[tokens.places[at] - 1]])
            if tally.rows > HELD:
                yield from frame()
        yield from frame()

    found = training.select("text").mapInArrow(work, "word binary, slot int, n long").groupBy("word", "slot").agg(F.sum("n").alias("n"))
    found = found.groupBy("word").agg(F.collect_list(F.struct("slot", "n")).alias("own"), F.sum("n").alias("n"))  # a slot for each context at most
    return found.select("word", F.col("own.slot").alias("slots"), F.col("own.n").alias("totals"), "n")


def place(words: DataFrame, moves: np.ndarray, classes: int) -> DataFrame:
    """``count_contexts`` with a class: by gain in likelihood for words seen twice or more, else fixed."""
    shared = words.sparkSession.sparkContext.broadcast(moves[:, :classes])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        logs, all_in = _xlogx(counts), counts.sum(axis=0)
        small = _xlogx(counts[:, None] + np.arange(64)[:, None]) - logs[:, None]  # of most words, so looked up
        for batch in batches:
            n, to = batch["n"].to_numpy(), classes + fixed_classes(batch["word"])
            seen = np.flatnonzero(n > 1)
            if len(seen):
                own = batch.take(pa.array(seen))
                slots, totals = (own[c].flatten().to_numpy() for c in ("slots", "totals"))
                starts = np.cumsum(pc.list_value_length(own["slots"]).to_numpy())
                starts = np.concatenate([[0], starts[:-1]])
                each, many = small[slots, np.minimum(totals, 63)], np.flatnonzero(totals > 63)
                each[many] = _xlogx(counts[slots[many]] + totals[many, None]) - logs[slots[many]]
                gain = np.add.reduceat(each, starts, axis=0)
                gain -= _xlogx(all_in + n[seen, None]) - _xlogx(all_in)
                to[seen] = gain.argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(to, pa.int32())], [*batch.schema.names, "class"])

    return words.mapInArrow(work, "word binary, slots array<int>, totals array<long>, n long, class int")


@dataclass
class Model:
    """Log10 tables of the shared words, the classes and the moves to them; ``contexts`` by unit, ``classes`` by place."""

    words: Vocabulary
    contexts: np.ndarray
    classes: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    base: np.ndarray
    end_base: float
    end_known: bool
    class_total: np.ndarray
    base_total: float
    train_tokens: int


def fit(docs: DataFrame, usable: Column, classes: int = CLASSES, rounds: int = ROUNDS, clustered: float = CLUSTERED, shared: float = SHARED) -> tuple[Model, DataFrame]:
    """A model of the ``usable`` rows, and (word, n, class) of the words that it does not hold."""
    spark = docs.sparkSession
    training = texts(docs).where(usable)
    counts = durable(count_words(training), "counts")
    n_words, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_texts = training.count()
    common = F.col("n") >= max(1.0, shared * n_words)
    top = [(bytes(r["word"]), r["n"]) for r in counts.where(common).collect()]  # at most 1 / shared
    top.sort(key=lambda item: (-item[1], item[0]))
    words = Vocabulary(
        {word: place for place, (word, _) in enumerate(top)},
        np.array([n for _, n in top], dtype=np.float64),
        sum(n >= clustered * n_words or n > 1 for _, n in top),
        classes,
        sum(n >= clustered * n_words for _, n in top),
    )
    sent = spark.sparkContext.broadcast(words)
    bigrams = durable(count_bigrams(training, sent), "bigrams")
    unit_classes, moves = exchange(bigrams, words, rounds)

    size = classes + FIXED + 1
    placed = durable(place(count_contexts(training, sent, unit_classes), moves, classes), "placed")
    of_shared = np.concatenate([unit_classes[: words.exchanged], np.zeros(len(top) - words.exchanged)]).astype(np.int64)
    for row in placed.where(common).select("word", "class").collect():  # at most 1 / shared
        of_shared[words.places[bytes(row["word"])]] = row["class"]
    moves[:, classes : classes + FIXED] = 0  # these words now count in the classes they have
    of_placed = placed.select("class", F.explode(F.arrays_zip("slots", "totals")).alias("own"))
    for row in of_placed.groupBy("own.slots", "class").agg(F.sum("own.totals").alias("n")).collect():  # size * size at most
        moves[row["slots"], row["class"]] += row["n"]
    totals, types = np.bincount(of_shared, words.counts, size), np.bincount(of_shared, minlength=size).astype(float)
    rest = placed.where(~common).select("word", "n", "class")
    for row in rest.groupBy("class").agg(F.sum("n"), F.count("*")).collect():
        totals[row[0]] += row[1]
        types[row[0]] += row[2]
    types[classes : classes + FIXED] += 1  # the unseen word
    train_tokens, distinct = n_words + n_texts, n_types + (n_texts > 0)
    base_total = math.log10(train_tokens + ADD * (distinct + 1))
    class_total = np.log10(np.maximum(totals + ADD * types, 1e-300))
    move = np.log10((moves + ADD_MOVE) / (moves.sum(axis=1, keepdims=True) + ADD_MOVE * size))
    model = Model(
        words, unit_classes.astype(np.int64), of_shared, move,
        np.log10(words.counts + ADD) - class_total[of_shared], np.log10(words.counts + ADD) - base_total,
        math.log10(n_texts + ADD) - base_total, n_texts > 0, class_total, base_total, train_tokens,
    )
    return model, rest


def score(docs: DataFrame, model: Model, rest: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row.

    A task scores all that its model holds, and sends one row for the text and one for each
    other distinct word. The text's row carries a key with a space, which no word has, so it
    passes the join with the counts like the others and spreads as evenly.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        words = m.words
        size = len(m.move)
        for piece in pieces(batches):
            tokens = cut(piece["text"])
            places, units, line = words.line(tokens)
            own = m.contexts[line]
            before, of, n_texts = own[tokens.places - 1], tokens.of, tokens.texts
            places_here = places[tokens.codes]
            at = np.flatnonzero(places_here >= 0)
            held = places_here[at]
            add = lambda x: np.bincount(of[at], x, n_texts)
            n_tokens = np.bincount(of, minlength=n_texts) + 1
            ends = np.cumsum(n_tokens)
            total = add(m.move[before[at], m.classes[held]] + m.emit[held]) + m.move[own[ends - 1], own[ends]]
            lead = [b" %d %d" % (name or 0, th) for name, th in zip(piece["doc_id"].to_pylist(), piece["th"].to_pylist())]
            none = pa.nulls(n_texts, pa.int32())
            known, base = np.bincount(of[at], minlength=n_texts) + int(m.end_known), add(m.base[held]) + m.end_base
            yield from sent(
                {
                    "doc_id": piece["doc_id"], "th": piece["th"], "word": pa.array(lead, pa.binary()), "at": none, "n_here": none,
                    "n_tokens": pa.array(n_tokens), "n_known": pa.array(known), "base": pa.array(base), "score": pa.array(total),
                }
            )
            at = np.flatnonzero(places_here < 0)
            keys, n = np.unique((tokens.codes[at] * n_texts + of[at]) * size + before[at], return_counts=True)
            text, word = pa.array(keys // size % n_texts), keys // size // n_texts
            alone = keys % size * size + units[word] - words.exchanged + words.classes
            longs, doubles = pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.float64())
            yield from sent(
                {
                    "doc_id": piece["doc_id"].take(text), "th": piece["th"].take(text), "word": tokens.words.take(pa.array(word)),
                    "at": pa.array(alone, pa.int32()), "n_here": pa.array(n, pa.int32()),
                    "n_tokens": longs, "n_known": longs, "base": doubles, "score": doubles,
                }
            )

    # Words outside the model have the class of the table, or a fixed one; its total and the move to it are looked up.
    # ``at`` holds the context and the fixed class. No key of ``rest`` is there twice, so a partition of it is small.
    size = len(model.class_total)
    totals, moves = (F.array(*[F.lit(float(x)) for x in table.ravel()]) for table in (model.class_total, model.move))
    own = F.coalesce(F.col("class"), F.col("at") % size)
    total = F.element_at(totals, own + 1) - F.element_at(moves, F.col("at") - F.col("at") % size + own + 1)
    rows = texts(docs).withColumn("th", F.xxhash64("text"))
    rows = rows.mapInArrow(
        work, "doc_id long, th long, word binary, at int, n_here int, n_tokens long, n_known long, base double, score double"
    )
    rows = rows.join(rest.withColumn("log", F.log10(F.col("n") + ADD)).hint("shuffle_hash"), "word", "left")
    seen, here, log = F.coalesce("n", F.lit(0)), F.col("n_here"), F.coalesce("log", F.lit(math.log10(ADD)))
    found = rows.groupBy("doc_id", "th").agg(
        F.count("n_tokens").alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.when(seen > 0, here).otherwise(0).cast("long"))).alias("n_known"),
        F.sum(F.coalesce("base", here * (log - model.base_total))).alias("base_score"),
        F.sum(F.coalesce("score", here * (log - total))).alias("score"),
    )
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")  # repeated rows
    share = lambda c: (F.col(c) / F.col("copies")).alias(c)
    whole = lambda c: F.floor(F.col(c) / F.col("copies")).cast("long").alias(c)
    return found.select("doc_id", each, whole("n_tokens"), whole("n_known"), share("base_score"), share("score")).drop("copy")


def perplexity(scored: DataFrame, column: str = "score") -> float:
    total, tokens = scored.agg(F.sum(column), F.sum("n_tokens")).first()
    return 10 ** (-total / tokens) if tokens else float("nan")


def op4_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id"), FOLDS) == HELD_OUT
    model, rest = fit(docs, ~held_out)
    scored = score(docs, model, rest)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
