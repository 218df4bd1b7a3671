"""Token counts of a byte-level BPE file, by rank-synchronous merging of ragged arrays.

A batch of distinct pre-tokens is one flat array of symbols and one of sequence numbers. Each round
finds the lowest-ranked pair of every sequence at once (a minimum per segment), joins all places of
that pair in its sequence, from the left where places overlap, and looks up the ranks of the pairs
beside them. A sequence without a ranked pair leaves the arrays; the number of its symbols is its number
of tokens. Joining all places of a pair together gives what joining them one by one gives, because
no later pair of a trained file ranks before the pair that made its parts; ``Merges`` refuses a file
where one does.

Texts of plain Latin characters are cut into pre-tokens by a pattern, all others by the library's own
pre-tokenizer. Counts of pre-tokens are kept in the worker process, up to a limit. Nothing is shuffled.

Defined results: a null text is empty and has no tokens; the whole of a very long text counts; a
special string inside a text is one token, as the library has it by default; a null doc_id stays null;
repeated rows give repeated results; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import hold, slices, table, texts

LIMIT = 512
NONE = np.int32(np.iinfo(np.int32).max)
#: Symbols merged at a time.
CHUNK = 1 << 20


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level file.

    Fixed values of the format: visible Latin-1 characters stand for themselves, all
    others for the characters from U+0100 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class Merges:
    """The ranked pairs of a byte-level BPE model, as sorted arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        letters = byte_symbols()
        self.base = np.array([vocabulary[c] for c in letters], dtype=np.int32)
        made = dict.fromkeys(letters, -1)
        for rank, (left, right) in enumerate(pairs):
            if not max(made.get(left, rank), made.get(right, rank)) < rank:
                raise ValueError(f"pair {rank} joins what no earlier pair makes")
            made.setdefault(left + right, rank)
        ids = np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs], dtype=np.int64).reshape(-1, 3)
        keys, first = np.unique(ids[:, 0] << 32 | ids[:, 1], return_index=True)  # the lowest rank of a repeated pair
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.ranks = np.append(first.astype(np.int32), NONE)
        self.results = ids[:, 2].astype(np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, pairs)
        return np.where(self.keys[at] == pairs, self.ranks[at], NONE)

    def counts(self, data: bytes, lengths: np.ndarray) -> np.ndarray:
        """Surviving symbols of each sequence; ``lengths`` cut ``data`` into sequences of one byte or more."""
        out = np.empty(len(lengths), dtype=np.int64)
        symbols = self.base[np.frombuffer(data, dtype=np.uint8)]
        name = np.repeat(np.arange(len(lengths)), lengths)
        ranks = np.full(len(symbols), NONE, dtype=np.int32)
        inner = np.flatnonzero(name[1:] == name[:-1])
        ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
            sizes = np.diff(starts, append=len(name))
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NONE
            if done.any():
                out[name[starts[done]]] = sizes[done]
                left = np.repeat(~done, sizes)
                symbols, ranks, name = symbols[left], ranks[left], name[left]
                sizes, lowest = sizes[~done], lowest[~done]
                if not len(symbols):
                    break
            hit = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            # Places side by side overlap (a run of one symbol): every second of a run, from its left.
            head = np.flatnonzero(np.concatenate(([True], hit[1:] != hit[:-1] + 1)))
            inside = np.arange(len(hit)) - np.repeat(head, np.diff(head, append=len(hit)))
            hit = hit[inside % 2 == 0]
            symbols[hit] = self.results[ranks[hit]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[hit + 1] = False
            hit = hit - np.arange(len(hit))  # places once the right halves are gone
            symbols, ranks, name = symbols[stay], ranks[stay], name[stay]
            beside = np.concatenate((hit, hit - 1))
            beside = beside[beside >= 0]
            after = np.minimum(beside + 1, len(name) - 1)
            paired = (name[beside] == name[after]) & (after > beside)
            ranks[beside] = NONE
            beside = beside[paired]
            ranks[beside] = self.rank(symbols[beside], symbols[beside + 1])
        return out


class TokenCounter:
    """Tokens of whole texts, as the tokenizers library counts them for a byte-level BPE file."""

    # The characters for which LETTER and the digits 0-9 are all letters and numbers.
    PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
    LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
    PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\s0-9{LETTER}]+|\s+(?!\S)|\s+")

    def __init__(self, spec: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = json.loads(spec)
        cut = model.get("pre_tokenizer") or {}
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex") or model.get("normalizer"):
            raise ValueError("not a byte-level file of this kind")
        self.merges = Merges(model["model"]["vocab"], model["model"]["merges"])
        self.pre_tokenizer = Tokenizer.from_str(spec).pre_tokenizer
        self.byte_of = {c: b for b, c in enumerate(byte_symbols())}
        special = sorted((t["content"] for t in model.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known: dict[str | bytes, int] = {}
        self.limit = limit

    def clear(self) -> None:
        self.known.clear()

    def pieces(self, text: str) -> list:
        """The pre-tokens of a text without special strings: text, or bytes where the library cuts it."""
        if self.PLAIN.fullmatch(text):
            return self.PIECE.findall(text)
        return [bytes(map(self.byte_of.__getitem__, p)) for p, _ in self.pre_tokenizer.pre_tokenize_str(text)]

    def learn(self, missing: list) -> None:
        if len(self.known) + len(missing) > self.limit:
            self.known.clear()
        found, size = [], 0
        for piece in missing:
            found.append(piece.encode() if isinstance(piece, str) else piece)
            size += len(found[-1])
            if size >= CHUNK:
                self._count(missing, found)
                missing, found, size = missing[len(found) :], [], 0
        self._count(missing, found)

    def _count(self, names: list, found: list[bytes]) -> None:
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        if len(lengths):
            self.known.update(zip(names, self.merges.counts(b"".join(found), lengths).tolist()))

    def __call__(self, batch: Iterable[str]) -> list[int]:
        hold(self)
        cuts, totals = [], []
        for text in batch:
            parts = self.special.split(text) if self.special and self.special.search(text) else [text]
            cuts.append([p for part in parts for p in self.pieces(part)] if len(parts) > 1 else self.pieces(text))
            totals.append(len(parts) - 1)
        used = set().union(*cuts)
        missing = list(used.difference(self.known))
        if missing:
            if len(self.known) + len(missing) > self.limit:
                missing = list(used)
            self.learn(missing)
        count = self.known.__getitem__
        return [n + sum(map(count, cut)) for n, cut in zip(totals, cuts)]


_COUNTERS: dict[int, TokenCounter] = {}


def token_counter(spec: str) -> TokenCounter:
    """One counter for each worker process, so that its pre-tokens last from task to task."""
    key = zlib.crc32(spec.encode())
    if key not in _COUNTERS:
        _COUNTERS[key] = TokenCounter(spec)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; ``tokenizer`` is a path that the driver reads."""
    with open(tokenizer, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = token_counter(spec.value)
        for batch in slices(batches):
            found = counter(batch["text"])
            sizes = [len(t.encode()) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": sizes, "n_tokens": found})

    return texts(docs).mapInPandas(work, "doc_id long, n_bytes long, n_tokens long")


def op11_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    counted = count_tokens(table(spark, sf_dir, "documents"), tokenizer)
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
