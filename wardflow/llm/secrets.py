"""Secret scans: fixed patterns, and a linear-chain conditional random field over words.

Words are runs without ASCII white space. The field tags each as outside (O), beginning
(B) or continuing (I) a secret. Its features are the word's shape, length, alphabet and mix of
characters, the words before and after it, and features of the whole text. It is trained on at
most ``train_windows`` windows of words around pattern matches and as many elsewhere, chosen by
a hash of their text, by maximum likelihood; the patterns label the words. Values that the patterns find are
also respelled and put behind words that no pattern knows, or into quotes, so that the field learns more than the patterns. Whole texts are
decoded by Viterbi. Where O leads a word's other tags by more than all transitions can
return, every best path passes through O, so the text is decoded exactly in the stretches between
such words; most words need no further step.

Spans are code points, end exclusive. Pattern spans always stay; a tagged run that touches
none is added as kind ``crf``, without quotes and marks around it.

Defined results: a null text is empty and has no span; an empty table gives no rows; rows of one
doc_id count by themselves; with no pattern match anywhere there is no field, and the
patterns alone give spans. Other columns are passed through or not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import hold, table, texts, word_bounds
from wardflow.session import durable

TRAIN_WINDOWS = 3_000
WINDOW = 12
#: A tagged run needs as many characters other than low signs and spaces.
LEAST = 6
KINDS = ("assign", "access", "hex", "crf")

# Fixed patterns of the contract; (pattern, group that is measured, its least length).
PATTERNS = {
    "assign": (
        re.compile(
            rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
        ),
        2,
        6,
    ),
    "access": (re.compile(rb"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(rb"[0-9a-f]{24,}"), 0, 24),
}

O, B, I = 0, 1, 2
_MARKS = b"\"'`<>()[]{},;:.!?*#$%&|~^"
_KEYS = re.compile(rb"password|passwd|secret|token|key|auth|credential|pwd|bearer")
_SHAPE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", b"A" * 26 + b"a" * 26 + b"9" * 10
)
_RUNS = re.compile(rb"(.)\1+", re.S)


#: What every match of a pattern holds, in lower case for the first: texts without it are not searched.
_KEY_PARTS = (b"passw", b"secret", b"token", b"api")
_HEX = bytes(0x78 if c in b"0123456789abcdef" else 0x20 for c in range(256))


def _may_match(data: bytes) -> Iterator[str]:
    lower = data.lower()
    if any(part in lower for part in _KEY_PARTS):
        yield "assign"
    if b"AKIA" in data:
        yield "access"
    if b"x" * 24 in data.translate(_HEX):
        yield "hex"


def pattern_spans(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all patterns, byte offsets, by start and then kind."""
    found = []
    for name in _may_match(data):
        pattern, group, least = PATTERNS[name]
        for match in pattern.finditer(data):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), KINDS.index(name), match.end()))
    return sorted(found)


def own_features(word: bytes) -> tuple[str, ...]:
    if word.isalpha() and not (len(word) >= 8 and not word.strip(b"abcdefABCDEF")):  # no digit, sign or mark
        shape = "a" if word.islower() else "A" if word.isupper() else "Aa" if word[1:].islower() else None
        if shape:
            key = _KEYS.search(word.lower())
            found = (f"shape {shape}", f"length {min(len(word), 64) // 6}", f"kinds {len(set(word)) // 4}")
            return (*found, f"key {key[0].decode()}") if key else found
    classes = word.translate(_SHAPE)
    shape = _RUNS.sub(rb"\1", classes)[:10].decode("latin-1")
    core = word.strip(_MARKS)
    found = [f"shape {shape}", f"length {min(len(core), 64) // 6}", f"kinds {len(set(core)) // 4}"]
    if digits := classes.count(b"9"):
        runs = _RUNS.sub(rb"\1", core.translate(_SHAPE)).count(b"9")
        found += [f"digits {digits * 4 // len(word)}", f"digit runs {min(runs, 12) // 3}"]
    if len(core) >= 8 and not core.strip(b"0123456789abcdefABCDEF"):
        found.append("hex")
    if key := _KEYS.search(word.lower()):
        found.append(f"key {key[0].decode()}")
    if b"=" in word or b":" in word:
        found.append(f"sign {'alone' if not core else 'inside' if b'=' in core or b':' in core else 'end'}")
    return tuple(found)


def near_features(word: bytes) -> tuple[str, ...]:
    """What a word tells about the words beside it: whether it is a sign, names a secret, or is a long mix."""
    lower = word.lower().strip(_MARKS)
    key = _KEYS.search(lower)
    sign = word.decode("latin-1") if len(word) <= 2 and not word.isalnum() else ""
    long_mix = len(lower) >= 16 and any(48 <= c < 58 for c in lower)
    return (f"{'named ' + key[0].decode() if key else 'other'} {sign} {long_mix}",)


#: What any word of 3 to 15 characters tells that names no secret.
PLAIN_NEAR = near_features(b"word")


def file_features(data: bytes, words: int) -> tuple[str, ...]:
    signs = data.count(b"=") + data.count(b":")
    return (f"file signs {min(4, signs * 200 // max(words, 1))}", f"file size {min(words, 4095).bit_length() // 3}")


@dataclass
class Field:
    """Weights of each feature for the three tags, of transitions, and of the first tag."""

    weights: dict[str, np.ndarray]
    moves: np.ndarray
    begin: np.ndarray
    tables: dict[str, "WordScores"] = field(default_factory=dict, repr=False)
    totals: dict[tuple, np.ndarray] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "moves": self.moves, "begin": self.begin, "tables": {}, "totals": {}}

    def total(self, prefix: str, names: tuple[str, ...]) -> np.ndarray:
        key = (prefix, *names)
        if (found := self.totals.get(key)) is None:
            if len(self.totals) > 100_000:
                self.totals.clear()
            zero = np.zeros(3)
            found = self.totals[key] = sum((self.weights.get(prefix + n, zero) for n in names), zero)
        return found

    def emissions(self, data: bytes, words: list[bytes]) -> np.ndarray:
        scores = self.tables.setdefault("words", WordScores(self))
        places = scores.places(words)
        out = scores.values[places, :3] + self.total("", file_features(data, len(words)))
        out[1:] += scores.values[places[:-1], 3:6]
        out[:-1] += scores.values[places[1:], 6:]
        return out

    def tag(self, data: bytes, words: list[bytes]) -> np.ndarray:
        """The best tags of all words."""
        tags = np.zeros(len(words), dtype=np.int8)
        if not words:
            return tags
        scores = self.emissions(data, words)
        scores[0] += self.begin
        # No choice of neighbours can win back more than this for a tag other than O.
        into = max(float((self.moves[:, t] - self.moves[:, O]).max()) for t in (B, I))
        out = max(float((self.moves[t] - self.moves[O]).max()) for t in (B, I))
        open_ = np.flatnonzero(scores[:, O] - scores[:, 1:].max(axis=1) <= max(0.0, into) + max(0.0, out))
        if len(open_):
            for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
                a, b = int(run[0]), int(run[-1]) + 1
                tags[a:b] = self.viterbi(scores[a:b], a > 0, b < len(words))
        return tags

    def viterbi(self, scores: np.ndarray, after_outside: bool, before_outside: bool) -> list[int]:
        """The best path, between O on the sides where the text goes on."""
        best = scores[0] + (self.moves[O] if after_outside else 0)
        back = []
        for row in scores[1:]:
            paths = best[:, None] + self.moves
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        if before_outside:
            best = best + self.moves[:, O]
        path = [int(best.argmax())]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


class WordScores(dict):
    """Word -> row of ``values``: scores for the word itself, for the word after, for the word before.

    Words of the same features share a row, so there are few rows; words are kept up to ``LIMIT``.
    """

    LIMIT = 600_000

    def __init__(self, model: Field):
        super().__init__()
        self.model = model
        self.rows: dict[tuple, int] = {}
        self.values = np.zeros((1024, 9))

    def __missing__(self, word: bytes) -> int:
        plain = 2 < len(word) < 16 and not _KEYS.search(word.lower())
        key = (own_features(word), PLAIN_NEAR if plain else near_features(word))
        row = self.rows.get(key)
        if row is None:
            row = self.rows[key] = len(self.rows)
            if row == len(self.values):
                self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            total = self.model.total
            self.values[row] = np.concatenate([total("", key[0]), total("before ", key[1]), total("after ", key[1])])
        self[word] = row
        return row

    def places(self, words: list[bytes]) -> np.ndarray:
        hold(self)
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def label_words(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """B for the first word that a pattern span touches, I for its others."""
    tags = np.zeros(len(starts), dtype=np.int8)
    for start, _, end in spans:
        a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(starts, end, side="left"))
        if a < b and not tags[a:b].any():
            tags[a:b] = I
            tags[a] = B
    return tags


def training_windows(data: bytes, seed: int) -> Iterator[tuple[bool, list[bytes], bytes, list[str]]]:
    """(has a match, words, tags, file features): around the first matches, and one place elsewhere."""
    starts, ends = word_bounds(data)
    if not len(starts):
        return
    words = data.split()
    tags = label_words(starts, ends, pattern_spans(data))
    names = file_features(data, len(words))
    at = np.flatnonzero(tags == B)
    elsewhere = [seed % len(words)] if not len(at) else []
    for place in [*at.tolist(), *elsewhere]:
        a, b = max(0, place - WINDOW), min(len(words), place + WINDOW + 1)
        yield place not in elsewhere, words[a:b], tags[a:b].tobytes(), names


#: Words put before a moved value; they name a secret, but no pattern starts with them.
CONTEXTS = ((), (b"bearer",), (b"pwd", b"="), (b"credential",), (b"auth:",), (b"Authorization:", b"Bearer"), (b"pwd:",))
QUOTES = (b"%s", b'"%s"', b"'%s'", b"%s,")
#: Only values as long as this, with a digit, are moved: a plain word says nothing by itself.
MOVED = 12


def respelled(value: bytes, pick: int) -> bytes:
    """A value of another alphabet, made from a hash of ``value``: 16 to 40 characters."""
    digest = hashlib.blake2b(value, digest_size=48, salt=pick.to_bytes(8, "little")).digest()
    spell = (base64.b64encode, base64.urlsafe_b64encode, base64.b32encode, base64.b16encode)[pick % 4]
    return spell(digest)[: 16 + pick // 4 % 25]


def moved_windows(words: list[bytes], seed: int) -> Iterator[tuple[list[bytes], bytes]]:
    """(words, tags): each value that a pattern finds in a window, respelled, in a place that no pattern knows.

    The patterns' key words are gone from these windows, so the field has to learn secrets by their mix of
    characters, and by other words and quotes beside them.
    """
    data = b" ".join(words)
    starts, ends = word_bounds(data)
    for turn, (start, kind, end) in enumerate(pattern_spans(data)):
        pattern, group, _ = PATTERNS[KINDS[kind]]
        value = pattern.match(data, start, end)[group]
        if len(value) < MOVED or not any(48 <= c < 58 for c in value):
            continue
        a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(starts, end, side="left"))
        while a and _KEYS.search(words[a - 1].lower()):  # a key word apart from its value
            a -= 1
        pick = 31 * seed + turn
        before = CONTEXTS[pick % len(CONTEXTS)]
        found = [*words[:a], *before, QUOTES[pick % len(QUOTES)] % respelled(value, pick), *words[b:]]
        if not pattern_spans(b" ".join(found)):  # another secret of the window would be labelled O
            yield found, bytes([O] * (a + len(before)) + [B] + [O] * (len(words) - b))


def fit_field(windows: list[tuple[list[bytes], np.ndarray, list[str]]], steps: int = 80, prior: float = 1e-3) -> Field:
    """Maximum likelihood by forward and backward sums over all windows at once, with Adam steps."""
    index: dict[str, int] = {}
    most = max(len(w) for w, _, _ in windows)
    rows, gold = [], np.full((len(windows), most), -1, dtype=np.int64)
    place_of, feature_of = [], []
    for k, (words, tags, names) in enumerate(windows):
        gold[k, : len(words)] = tags
        near = [near_features(w) for w in words]
        for t, word in enumerate(words):
            own = [*own_features(word), *names]
            own += ["before " + n for n in near[t - 1]] if t else []
            own += ["after " + n for n in near[t + 1]] if t + 1 < len(words) else []
            for name in own:
                place_of.append(k * most + t)
                feature_of.append(index.setdefault(name, len(index)))
    rows, cols = np.array(place_of), np.array(feature_of)
    mask = gold >= 0
    n, size = len(windows), len(index)
    target = np.zeros((n, most, 3))
    target[mask] = np.eye(3)[gold[mask]]
    pairs = mask[:, 1:]
    seen = np.zeros((3, 3))
    np.add.at(seen, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
    theta = np.zeros(size * 3 + 12)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights, moves, begin = theta[: size * 3].reshape(size, 3), theta[size * 3 : size * 3 + 9].reshape(3, 3), theta[-3:]
        scores = np.stack([np.bincount(rows, weights[cols, y], minlength=n * most) for y in range(3)], axis=1).reshape(n, most, 3)
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0] + begin
        for t in range(1, most):
            own = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None], own, ahead[:, t - 1])
        for t in range(most - 2, -1, -1):
            own = np.logaddexp.reduce(moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(mask[:, t + 1, None], own, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        share = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        joint = np.exp(
            ahead[:, :-1, :, None] + moves + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        )
        difference = ((target - share) * mask[:, :, None]).reshape(-1, 3)
        gradient = np.empty_like(theta)
        gradient[: size * 3] = np.stack(
            [np.bincount(cols, difference[rows, y], minlength=size) for y in range(3)], axis=1
        ).ravel()
        gradient[size * 3 : size * 3 + 9] = (seen - (joint * pairs[:, :, None, None]).sum(axis=(0, 1))).ravel()
        gradient[-3:] = (target[:, 0] - share[:, 0]).sum(axis=0)
        gradient = gradient / n - prior * theta
        m1, m2 = 0.9 * m1 + 0.1 * gradient, 0.99 * m2 + 0.01 * gradient**2
        theta = theta + 0.15 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    weights = theta[: size * 3].reshape(size, 3)
    return Field({name: weights[k].copy() for name, k in index.items()}, theta[size * 3 : size * 3 + 9].reshape(3, 3), theta[-3:])


def train(docs: DataFrame, train_windows: int = TRAIN_WINDOWS) -> Field | None:
    """A field from at most ``train_windows`` windows with a match and as many without."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                data = text.encode()
                seed = int.from_bytes(hashlib.blake2b(data, digest_size=6).digest(), "big")
                for match, words, tags, names in training_windows(data, seed):
                    out.append((match, b" ".join(words), tags, "\n".join(names)))
            frame = pd.DataFrame(out, columns=["match", "words", "tags", "names"])
            yield frame.drop_duplicates()

    found = texts(docs).mapInPandas(work, "match boolean, words binary, tags binary, names string")
    # Equal windows say nothing new; the few with a word of thousands of characters are no use for training.
    found = durable(found.where(F.length("words") < 4096).distinct(), "windows")
    first = [F.xxhash64("words", "tags", "names"), "words", "tags", "names"]
    sample = []
    for match in (True, False):
        sample += found.where(F.col("match") == match).orderBy(*first).limit(train_windows).collect()
    if not any(r["match"] for r in sample):
        return None
    windows = []
    for place, row in enumerate(sample):
        words, names = bytes(row["words"]).split(), row["names"].split("\n")
        windows.append((words, np.frombuffer(row["tags"], np.int8), names))
        if row["match"]:
            windows += [(w, np.frombuffer(tags, np.int8), names) for w, tags in moved_windows(words, place)]
    return fit_field(windows)


def all_spans(text: str, model: Field | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points: pattern spans, and tagged runs that touch none."""
    data = text.encode()
    spans = pattern_spans(data)
    if model is not None:
        words = data.split()
        tags = model.tag(data, words)
        if tags.any():
            starts, ends = word_bounds(data)
            tagged = np.flatnonzero(tags)
            cuts = np.flatnonzero((np.diff(tagged) > 1) | (tags[tagged[1:]] == B)) + 1
            base = list(spans)
            for run in np.split(tagged, cuts):
                a, b = int(starts[run[0]]), int(ends[run[-1]])
                piece = data[a:b]
                a, b = a + len(piece) - len(piece.lstrip(_MARKS)), b - (len(piece) - len(piece.rstrip(_MARKS)))
                if sum(c > 47 for c in data[a:b]) >= LEAST and not any(s < b and a < e for s, _, e in base):
                    spans.append((a, len(KINDS) - 1, b))
    if len(data) != len(text) and spans:
        points = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
        at = np.append(0, points)
        # A span may end or start inside no character: patterns and marks are ASCII.
        spans = [(int(at[s]), k, int(at[e])) for s, k, e in spans]
    return sorted(spans)


def show(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]], sign: str = "[SECRET]") -> str:
    """``text`` with each stretch that spans cover replaced by ``sign``."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], sign]
        at = max(at, end)
    return "".join([*out, text[at:]])


def with_spans(docs: DataFrame, model: Field | None) -> DataFrame:
    """(doc_id, spans) of every row, spans as an array of (kind, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [all_spans(t, shared.value) for t in batch["text"]]
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in own] for own in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": spans})

    return texts(docs).mapInPandas(work, "doc_id long, spans array<struct<kind string, start int, end int>>")


def redact_documents(docs: DataFrame, model: Field | None, sign: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets replaced in ``text``, and ``n_chars`` (if there) counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def clean(batch: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redact(t, all_spans(t, shared.value), sign) for t in batch], dtype=object)

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return out


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = with_spans(docs, train(docs))
    shown = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "crf")
    return found.select(
        "doc_id",
        *[number(kind) for kind in KINDS],
        F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )
