"""Repeated passages: every byte covered by a string of ``length`` bytes that also starts earlier.

Depth-limited radix sort of suffixes, most significant digit first. All suffixes are put in order only
through their first ``length`` bytes; those left in one group are exactly the repeated windows. Three digits
are taken in turn:

1. A content-defined digit. Of the short grams inside a window, the one with the smallest hash (the
   leftmost of equals) is its anchor. Equal windows have equal anchors at equal offsets, so
   windows with different anchors need no comparison. Neighbouring windows mostly share their
   anchor: a text has one *run* of windows for about every 35 bytes, and only runs are shuffled.
2. The whole run. Runs with the same anchor and the same bytes (64 + 64 bits of hashes) repeat
   each other; all but the first are covered. A task keeps the first of its own equal runs and
   reports the others at once, so copies, however many, send one row per task.
3. Digits of eight bytes. Only where one anchor has different runs (edits, borders of passages) are
   the bytes of the first of each kind fetched, and their windows sorted by
   digits, dropping windows that are alone after each pass.

Very common anchors (found in a sample; the choice moves work and never results) would gather all
surroundings of a common line in one task. Their runs are split into single windows, each keyed by
its own digest, which spread evenly.

"Earlier" means a smaller doc_id, or the same document and an earlier start. Defined results: a null text
is empty; texts shorter than ``length`` keep all; a null doc_id is the smallest; rows of one doc_id are
ordered by a hash of their text, and of equal rows one comes first; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import mix, slices, table, texts
from wardflow.session import durable

LENGTH = 100
LOWEST = -(2**63)
#: Places of a chunk fit into the low bits of an anchor's key.
CHUNK, PLACE_BITS = 1 << 23, np.uint64(24)
#: One in so many documents is looked at for common anchors; how often such an anchor is seen there
#: at least; the most anchors that are treated so (8 bytes each are broadcast).
SAMPLE, COMMON, MOST_COMMON = 64, 16, 1_000_000
HELD_RUNS = 1_000_000
#: A run's windows and its anchor's place in one number; the last place says that it is a single window.
SHIFT, SINGLE = 12, (1 << 12) - 1


def gram_length(length: int) -> int:
    return max(1, length * 8 // 25)


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` bytes, put together from those of halves."""
    base = 0x9E3779B97F4A7C15
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    part, size = data.astype(np.uint64) + np.uint64(1), 1
    whole, done = None, 0
    while True:
        if width & size:
            if whole is None:
                whole, done = part, size
            else:
                n = len(data) - done - size + 1
                whole, done = whole[:n] * power(size) + part[done : done + n], done + size
        if done == width:
            return mix(whole)
        n = len(data) - 2 * size + 1
        part, size = part[:n] * power(size) + part[size : size + n], 2 * size


def runs_of(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows, anchor's place in the first window) of each run."""
    width = gram_length(length)
    span = length - width + 1
    found = []
    for begin in range(0, len(data) - length + 1, CHUNK):
        own = np.frombuffer(data, dtype=np.uint8)[begin : begin + CHUNK + length - 1]
        hashes = gram_hashes(own, width)
        keys = hashes >> PLACE_BITS << PLACE_BITS | np.arange(len(hashes), dtype=np.uint64)
        windows = len(hashes) - span + 1
        blocks = np.append(keys, np.full(-len(keys) % span, 2**64 - 1, dtype=np.uint64)).reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
        anchor = (least & np.uint64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
        first = np.append(0, np.flatnonzero(np.diff(anchor)) + 1)
        count = np.diff(np.append(first, windows))
        found.append((hashes[anchor[first]].view(np.int64), first + begin, count, anchor[first] - first))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(part) for part in zip(*found))


def join_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching intervals as one; ends are exclusive."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(new[1:], True)]


def sort_windows(
    data: np.ndarray, groups: np.ndarray, windows: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Radix passes over windows (places in ``data``) that start out in ``groups``.

    Returns (group, index of the window) of all windows that are not alone after ``length`` bytes.
    """
    data = np.append(data, np.zeros(8, dtype=np.uint8))
    digits = np.ndarray((len(data) - 7,), dtype=">u8", buffer=data.data, strides=(1,))
    alive = np.arange(len(windows))
    group = np.unique(groups, return_inverse=True)[1]
    for depth in range(-8, length, 8):
        if depth >= 0:
            digit = digits[windows[alive] + depth].astype(np.uint64)
            if depth + 8 > length:
                digit >>= np.uint64(8 * (depth + 8 - length))
            order = np.lexsort((digit, group))
            alive, group, digit = alive[order], group[order], digit[order]
            new = np.append(True, (group[1:] != group[:-1]) | (digit[1:] != digit[:-1]))[: len(alive)]
        else:
            order = np.argsort(group, kind="stable")
            alive, group = alive[order], group[order]
            new = np.append(True, group[1:] != group[:-1])[: len(alive)]
        group = np.cumsum(new) - 1
        together = np.bincount(group, minlength=1)[group] > 1
        alive, group = alive[together], group[together]
        if not len(alive):
            break
    return group, alive


def repeated_windows(
    data: np.ndarray, groups: np.ndarray, windows: np.ndarray, docs: np.ndarray, places: np.ndarray, length: int
) -> np.ndarray:
    """Indexes of the windows that equal an earlier one of their group."""
    group, alive = sort_windows(data, groups, windows, length)
    if not len(alive):
        return alive
    order = np.lexsort((places[alive], docs[alive], group))
    group, alive = group[order], alive[order]
    return alive[np.append(False, group[1:] == group[:-1])]


def with_keys(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): distinct keys in the order of documents; doc_id itself unless one comes twice."""
    rows = texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(LOWEST)))
    if rows.groupBy("key").count().where("count > 1").isEmpty():
        return rows.select("key", "doc_id", "text")
    ordered = rows.withColumn("th", F.xxhash64("text")).repartitionByRange("key", "th")
    ordered = ordered.sortWithinPartitions("key", "th")
    number = F.monotonically_increasing_id()  # ascends with the sorted ranges
    return durable(ordered.select(number.alias("key"), "doc_id", "text"), "keyed")


def common_anchors(rows: DataFrame, length: int) -> np.ndarray:
    """Sorted hashes of anchors that many runs share in a sample of documents."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.unique(runs_of(t.encode(), length)[0]) for t in batch["text"]]
            yield pd.DataFrame({"h": np.concatenate([*found, np.empty(0, dtype=np.int64)])})

    own = rows.where(F.pmod(F.xxhash64("key"), F.lit(SAMPLE)) == 0).select("text").mapInPandas(work, "h long")
    top = own.groupBy("h").count().where(F.col("count") >= COMMON).orderBy(F.desc("count"), "h").limit(MOST_COMMON)
    return np.sort(top.select("h").toPandas()["h"].to_numpy(dtype=np.int64))


class TaskRuns:
    """Runs of a task: first of each kind, and the stretches that repeat earlier ones of the task."""

    def __init__(self, length: int, common: np.ndarray):
        self.length, self.common, self.parts, self.held = length, common, [], 0

    def add(self, key: int, data: bytes) -> None:
        h, first, count, place = runs_of(data, self.length)
        if len(self.common) and len(h):
            at = np.minimum(np.searchsorted(self.common, h), len(self.common) - 1)
            split = self.common[at] == h
            if split.any():
                repeat = np.where(split, count, 1)
                index = np.repeat(np.arange(len(h)), repeat)
                step = np.arange(len(index)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
                single = split[index]
                first, count, place = first[index] + step * single, np.where(single, 1, count[index]), np.where(single, SINGLE, place[index])
                h = h[index]
        digest, most = xxhash.xxh3_64_intdigest, self.length - 1
        bounds = zip(first.tolist(), (first + count + most).tolist())
        c = np.array([digest(data[a:b]) for a, b in bounds], dtype=np.uint64)
        kind = (count << SHIFT | place).astype(np.uint64)
        h = np.where(place == SINGLE, mix(c + np.uint64(77)).view(np.int64), h)
        c = mix(c + kind).view(np.int64)
        self.parts.append((h, c, np.full(len(h), key, dtype=np.int64), first, count << SHIFT | place))
        self.held += len(h)

    def frames(self) -> Iterator[pd.DataFrame]:
        """(h, c, key, start, run): first runs, run = windows and anchor's place; else ``-windows`` covered."""
        if not self.held:
            return
        h, c, key, start, run = (np.concatenate(p) for p in zip(*self.parts))
        self.parts, self.held = [], 0
        order = np.lexsort((start, key, c, h))
        h, c, key, start, run = h[order], c[order], key[order], start[order], run[order]
        new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1]))
        yield pd.DataFrame({"h": h[new], "c": c[new], "key": key[new], "start": start[new], "run": run[new].astype(np.int32)})
        key, start, windows = key[~new], start[~new], run[~new] >> SHIFT
        order = np.lexsort((start, key))
        key, start, windows = key[order], start[order], windows[order]
        if len(key):
            head = np.append(True, (key[1:] != key[:-1]) | (start[1:] > start[:-1] + windows[:-1]))
            tail = np.append(head[1:], True)
            first, total = start[head], start[tail] + windows[tail] - start[head]
            spread = mix(key[head].view(np.uint64) * np.uint64(31) + first.view(np.uint64)).view(np.int64)
            yield pd.DataFrame({"h": spread, "c": first, "key": key[head], "start": first, "run": (-total).astype(np.int32)})


def mark_runs(rows: DataFrame, length: int) -> DataFrame:
    """(key, start, windows, place, h, covered): covered runs, and first runs that differ from others of their anchor."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(common_anchors(rows, length))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskRuns(length, shared.value)
        for batch in batches:
            for key, text in zip(batch["key"].tolist(), batch["text"]):
                task.add(key, text.encode())
                if task.held > HELD_RUNS:
                    yield from task.frames()
        yield from task.frames()

    found = rows.select("key", "text").mapInPandas(work, "h long, c long, key long, start long, run int")
    found = found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "h")
    kind, anchor = Window.partitionBy("h", "c").orderBy("key", "start"), Window.partitionBy("h")
    found = found.withColumn("rank", F.row_number().over(kind))
    found = found.withColumn("mixed", F.min("c").over(anchor) != F.max("c").over(anchor))
    covered = (F.col("run") < 0) | (F.col("rank") > 1)
    windows = F.when(F.col("run") < 0, -F.col("run")).otherwise(F.shiftright("run", SHIFT))
    place = F.col("run").bitwiseAND(SINGLE)
    found = found.where(covered | (F.col("mixed") & (place != SINGLE)))
    return found.select("key", "start", windows.alias("windows"), place.alias("place"), "h", covered.alias("covered"))


def compare_runs(runs: DataFrame, length: int, held: int = 20_000) -> DataFrame:
    """(key, start, windows) covered among runs with their bytes: (h, key, start, windows, place, data)."""
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = frame["windows"].to_numpy()
        data = np.frombuffer(b"".join(frame["data"]), dtype=np.uint8)
        begins = np.cumsum(frame["data"].str.len().to_numpy()) - frame["data"].str.len().to_numpy()
        run = np.repeat(np.arange(len(frame)), sizes)
        step = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # Equal windows have their anchor at the same place: a digit that is known already.
        groups = np.unique(frame["h"].to_numpy(), return_inverse=True)[1][run] * (2 * length) + frame["place"].to_numpy()[run] - step
        key, start = frame["key"].to_numpy()[run], frame["start"].to_numpy()[run] + step
        hits = np.sort(repeated_windows(data, groups, begins[run] + step, key, start, length))
        key, start = key[hits], start[hits]
        if not len(hits):
            return pd.DataFrame({"key": [], "start": [], "windows": []}).astype("int64")
        head = np.append(True, (key[1:] != key[:-1]) | (start[1:] != start[:-1] + 1))
        at = np.flatnonzero(head)
        return pd.DataFrame({"key": key[head], "start": start[head], "windows": np.diff(np.append(at, len(key)))})

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, rows = [], 0
        for batch in batches:
            if rows >= held:
                whole = pd.concat(parts, ignore_index=True)
                last = whole["h"].to_numpy() == whole["h"].iloc[-1]  # this anchor may go on
                if not last.all():
                    yield finish(whole[~last])
                    parts, rows = [whole[last]], int(last.sum())
            parts.append(batch)
            rows += len(batch)
        if parts:
            yield finish(pd.concat(parts, ignore_index=True))

    dealt = runs.repartition(parts, "h").sortWithinPartitions("h")
    return dealt.mapInPandas(work, "key long, start long, windows long")


def find_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, doc_id, text, starts, ends) of every row: byte stretches to remove, in order, apart from each other."""
    if not 4 <= length <= SINGLE:
        raise ValueError(f"windows of {length} bytes are not supported")
    rows = with_keys(docs)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = durable(mark_runs(rows, length), "runs")
    dealt = rows.repartition(parts, "key")

    wanted = marked.where(~F.col("covered")).groupBy("key").agg(F.collect_list(F.struct("h", "start", "windows", "place")).alias("own"))
    wanted = wanted.select("key", *[F.col(f"own.{c}").alias(c) for c in ("h", "start", "windows", "place")])

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, pieces, held = [], [], 0

        def frame() -> pd.DataFrame:
            h, key, start, windows, place = (np.concatenate(p) for p in zip(*parts))
            return pd.DataFrame({"h": h, "key": key, "start": start, "windows": windows, "place": place, "data": pieces})

        for batch in batches:
            for key, text, h, start, windows, place in zip(*(batch[c] for c in ("key", "text", "h", "start", "windows", "place"))):
                data = text.encode()
                parts.append((h, np.full(len(h), key, dtype=np.int64), start, windows, place))
                pieces += [data[a : a + n + length - 1] for a, n in zip(start.tolist(), windows.tolist())]
                held += len(h)
                if held >= 20_000:
                    yield frame()
                    parts, pieces, held = [], [], 0
        if parts:
            yield frame()

    runs = dealt.join(wanted, "key").select("key", "text", "h", "start", "windows", "place")
    runs = runs.mapInPandas(fetch, "h long, key long, start long, windows int, place int, data binary")
    spans = marked.where("covered").select("key", "start", F.col("windows").cast("long").alias("windows"))
    spans = spans.union(compare_runs(runs, length))
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("own"))
    spans = spans.select("key", F.col("own.start").alias("start"), F.col("own.windows").alias("windows"))
    both = dealt.join(spans, "key", "left").select("key", "doc_id", "text", "start", "windows")

    def unite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            found = []
            for start, windows in zip(batch["start"], batch["windows"]):
                if start is None:
                    found.append((np.empty(0, dtype=np.int64),) * 2)
                else:
                    found.append(join_intervals(np.asarray(start), np.asarray(start) + np.asarray(windows) + length - 1))
            yield pd.DataFrame(
                {
                    "key": batch["key"], "doc_id": batch["doc_id"].astype("Int64"), "text": batch["text"],
                    "starts": [f[0] for f in found], "ends": [f[1] for f in found],
                }
            )

    return both.mapInPandas(unite, "key long, doc_id long, text string, starts array<long>, ends array<long>")


def kept_bytes(data: bytes, starts, ends) -> bytes:
    out, at = [], 0
    for start, end in zip(starts, ends):
        out.append(data[at:start])
        at = end
    return b"".join([*out, data[at:]])


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_repeats(table(spark, sf_dir, "documents"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, starts, ends in zip(batch["text"], batch["starts"], batch["ends"]):
                data = text.encode()
                kept = kept_bytes(data, starts.tolist(), ends.tolist())
                rows.append((len(data), len(data) - len(kept), len(starts), hashlib.sha256(kept).hexdigest()))
            frame = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield frame

    return found.mapInPandas(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
