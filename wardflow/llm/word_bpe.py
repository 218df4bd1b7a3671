"""BPE with word ends: a transducer lexicon of frequent words, and exact merges for all others.

Encoding gives what the tokenizers library gives for the file; decoding what its decode does
without a decoder, the tokens joined by spaces. The frequent words of the documents (at least
``share`` of all words, so no more than 1 / share of them) are encoded once, compiled into a
minimal acyclic transducer, and shipped as one file that every task maps into memory. Words that it
lacks are merged by rank, so the lexicon changes the speed and not the ids.

Texts of plain Latin characters are normalised and split here. Other texts, and those with
the string of a special token, pass the file's own normaliser and pre-tokenizer.

Defined results: a null text is empty and has no ids; the digest of no ids is that of the empty text;
repeated rows and rows of one doc_id count by themselves; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import Cache, put_file, slices, table, texts
from wardflow.llm.lexicon import Lexicon, build
from wardflow.session import durable

SHARE = 5e-6


def byte_signs() -> list[str]:
    """The printable sign of each byte: itself if visible in Latin-1, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


SIGNS = byte_signs()
BYTES = {sign: byte for byte, sign in enumerate(SIGNS)}


class WordBpe:
    """Encoder and decoder of one vocabulary file; ``lexicon`` is optional."""

    PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
    WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")

    def __init__(self, spec: str, lexicon: Lexicon | None = None, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = json.loads(spec)
        self.spec, self.lexicon, self._library = spec, lexicon, None
        self.vocabulary: dict[str, int] = dict(model["model"]["vocab"])
        self.suffix: str = model["model"].get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocabulary.items(), *self.special.items()]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known = Cache(self._both, limit)

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.spec)
        return self._library

    def merge(self, word: str) -> list[int]:
        """Ids of one word by merges: always the pair of lowest rank, the leftmost of equals."""
        symbols = [SIGNS[b] for b in word.encode()]
        symbols[-1] += self.suffix
        symbols = self._merge_short(symbols) if len(symbols) <= 40 else self._merge_long(symbols)
        return [self.vocabulary[s] for s in symbols if s in self.vocabulary]

    def _merge_short(self, symbols: list[str]) -> list[str]:
        rank, last = self.ranks.get, len(self.ranks)
        scores = [rank(pair, last) for pair in zip(symbols, symbols[1:])]
        while scores:
            best = min(scores)
            if best == last:
                break
            i = scores.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = rank((symbols[i], symbols[i + 1]), last)
            if i:
                scores[i - 1] = rank((symbols[i - 1], symbols[i]), last)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap and links, for words of any length."""
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        rank, end = self.ranks.get, len(symbols)
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if symbols[i] else end
            if j >= end or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], symbols[j] = a + b, ""
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else end
                if right < end and (r := rank((symbols[left], symbols[right]))) is not None:
                    heapq.heappush(heap, (r, left, symbols[left], symbols[right]))
        return [s for s in symbols if s]

    def word_ids(self, word: str) -> list[int]:
        if self.lexicon is not None and (found := self.lexicon.ids(word.encode())) is not None:
            return found
        return self.merge(word)

    def _both(self, word: str | int) -> tuple[str, str, int]:
        ids = [word] if isinstance(word, int) else self.word_ids(word)
        return " ".join(map(str, ids)), " ".join(self.tokens[i] for i in ids), len(ids)

    def is_plain(self, text: str) -> bool:
        return bool(self.PLAIN.fullmatch(text)) and "<|" not in text

    def words(self, text: str) -> list[str | int]:
        """The words of a text after normalisation; a special token is its id."""
        if self.is_plain(text):
            return self.WORD.findall(text.lower())
        found: list[str | int] = []
        for piece in self.cut.split(text):
            if piece in self.special:
                found.append(self.special[piece])
            elif piece:
                normal = self.library.normalizer.normalize_str(piece)
                split = self.library.pre_tokenizer.pre_tokenize_str(normal)
                found += [bytes(BYTES[sign] for sign in word).decode() for word, _ in split]
        return found

    def encode(self, text: str) -> list[int]:
        return [i for w in self.words(text) for i in ([w] if isinstance(w, int) else self.word_ids(w))]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)

    def joined(self, text: str) -> tuple[str, str, int]:
        """Decimal ids joined by spaces, the decoded text, and the number of ids."""
        parts = [p for p in map(self.known.__getitem__, self.words(text)) if p[2]]
        if not parts:
            return "", "", 0
        ids, tokens, counts = zip(*parts)
        return " ".join(ids), " ".join(tokens), sum(counts)


_OPEN: dict[tuple[int, str | None], WordBpe] = {}


def word_bpe(spec: str, file: str | None = None) -> WordBpe:
    """One coder for each worker process; ``file`` names a lexicon that Spark has shipped."""
    key = (zlib.crc32(spec.encode()), file)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = WordBpe(spec, Lexicon(SparkFiles.get(file)) if file else None)
    return _OPEN[key]


def count_words(docs: DataFrame, spec) -> DataFrame:
    """(word, n): how often each normalised word occurs in all texts."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, counts = word_bpe(spec.value), Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(coder.words(text))
            if len(counts) > 300_000:
                yield frame(counts)
                counts.clear()
        yield frame(counts)

    def frame(counts: Counter) -> pd.DataFrame:
        own = [(w, n) for w, n in counts.items() if isinstance(w, str)]
        return pd.DataFrame(own, columns=["word", "n"])

    parts = texts(docs).select("text").mapInPandas(work, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(docs: DataFrame, spec, share: float = SHARE) -> str:
    """Compile the words that make up at least ``share`` of all; the name of the shipped file."""
    spark = docs.sparkSession
    stored = durable(count_words(docs, spec), "words")
    total = stored.agg(F.sum("n")).first()[0] or 0
    frequent = [r["word"] for r in stored.where(F.col("n") >= max(1.0, share * total)).select("word").collect()]
    coder = WordBpe(spec.value)
    data = build((w.encode(), coder.merge(w)) for w in frequent)  # at most 1 / share words
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(put_file(spark, name, data))
    return name


def encode_documents(docs: DataFrame, tokenizer: str, share: float = SHARE) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: decimal ids joined by spaces, and the decoded text."""
    return _coded(docs, tokenizer, share, lambda ids, tokens: (ids, tokens), "ids string, decoded string")


def encode_digests(docs: DataFrame, tokenizer: str, share: float = SHARE) -> DataFrame:
    """As ``encode_documents``, with SHA-256 digests in place of ids and text."""
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return _coded(
        docs, tokenizer, share, lambda ids, tokens: (digest(ids), digest(tokens)), "ids_sha256 string, decoded_sha256 string"
    )


def _coded(docs: DataFrame, tokenizer: str, share: float, show, fields: str) -> DataFrame:
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    name = compile_lexicon(docs, spec, share)
    columns = [part.split()[0] for part in fields.split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = word_bpe(spec.value, name)
        for batch in slices(batches):
            rows = []
            for text in batch["text"]:
                ids, tokens, count = coder.joined(text)
                rows.append((count, *show(ids, tokens)))
            frame = pd.DataFrame(rows, columns=["n_tokens", *columns])
            frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield frame

    return texts(docs).mapInPandas(work, f"doc_id long, n_tokens long, {fields}")


def op5_word_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """``tokenizer``: path of the vocabulary file, read by the driver and sent to the tasks."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return encode_digests(table(spark, sf_dir, "documents"), tokenizer)
