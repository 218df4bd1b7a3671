"""SimHash near-duplicates: fingerprints, and vantage-point trees that find all close pairs.

A fingerprint is 64 bits: a bit is set if it is set in over half the hashes of a text's
word shingles. Two fingerprints link if they differ in at most ``radius`` bits.

The pairs come from a vantage-point tree. A node holds a point v and a distance mu. What
is within mu of v goes to the inner branch, what is farther to the outer one. By the
triangle inequality two linked points differ by at most ``radius`` in their distance to v, so only
inner points at mu - radius + 1 .. mu can have a partner outside: those are also copied to the outer
branch. Every linked pair thus meets in at least one branch, and a branch is never
compared with another. The upper levels are built from a sample and deal the
fingerprints out to shards; each shard goes on by itself down to small leaves.

Equal fingerprints are merged first, so groups of copies cost one row. A shard reports a
spanning forest of its links, never all pairs of a group.

Defined results: a null text is empty; a text without words has fingerprint zero and links
like any other; fewer words than a shingle make one shingle; repeated shingles count each
time; repeated rows link. A null id sorts first; an id of -2^63 counts as null. Other
columns are passed through or not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import table, texts
from wardflow.llm.components import connected_components
from wardflow.session import durable

RADIUS = 3
WIDTH = 3
#: Shards for each task that can run at once, the most fingerprints that a shard should hold, and the most that
#: are sampled for the upper levels. Beyond some 300 million fingerprints the sample no longer makes shards of
#: that size; they then grow, at 8 bytes a fingerprint.
SHARDS_A_SLOT = 4
SHARD_ROWS = 50_000
MAX_SAMPLE = 200_000
LEAF = 256
LOWEST = -(2**63)


def simhash(text: str, width: int = WIDTH) -> int:
    """The fingerprint as an unsigned number; A-Z count as lower case."""
    words = text.encode().lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest, span = xxhash.xxh64_intdigest, min(width, len(words)) - 1
    pairs = zip(starts[: len(words) - span].tolist(), ends[span:].tolist())
    hashes = np.array([digest(data[s:e], 42) for s, e in pairs], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp, th) of every row: fingerprint as a signed number, and a hash of the text."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([simhash(t, width) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": found.view(np.int64), "th": batch["th"]})

    rows = texts(docs).select(F.coalesce("doc_id", F.lit(LOWEST)).alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    return rows.mapInPandas(work, "doc_id long, fp long, th long")


def distances(points: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ v)


def choose_split(points: np.ndarray, radius: int, rng: np.random.Generator, tries: int = 6):
    """(v, mu) that leaves the smaller larger branch, or None where no try shrinks it by a tenth."""
    best, found = 0.9 * len(points), None
    for v in rng.choice(points, size=min(tries, len(points)), replace=False):
        counts = np.bincount(distances(points, v), minlength=65)
        upto = np.cumsum(counts)
        for mu in range(radius, 64):
            copies = upto[mu] - upto[mu - radius]
            largest = max(upto[mu], len(points) - upto[mu] + copies)
            if largest < best:
                best, found = largest, (v, mu)
    return found


class Node:
    """An inner node of the upper levels; ``leaf`` numbers the shards."""

    def __init__(self, v=None, mu=0, inner=None, outer=None, leaf=-1):
        self.v, self.mu, self.inner, self.outer, self.leaf = v, mu, inner, outer, leaf


def upper_levels(sample: np.ndarray, rows: int, shard_rows: int, radius: int) -> tuple[Node, int]:
    """The tree over a sample that stands for ``rows`` fingerprints, and its number of shards."""
    rng, leaves = np.random.default_rng(7), [0]

    def build(points: np.ndarray) -> Node:
        if len(points) * rows > shard_rows * len(sample) and len(points) >= 32:
            if split := choose_split(points, radius, rng):
                v, mu = split
                d = distances(points, v)
                return Node(v, mu, build(points[d <= mu]), build(points[d > mu - radius]))
        leaves[0] += 1
        return Node(leaf=leaves[0] - 1)

    return build(sample), leaves[0]


def route(node: Node, points: np.ndarray, places: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its points); a point near a border is in several shards."""
    if not len(places):
        return
    if node.leaf >= 0:
        yield node.leaf, places
        return
    d = distances(points[places], node.v)
    yield from route(node.inner, points, places[d <= node.mu], radius)
    yield from route(node.outer, points, places[d > node.mu - radius], radius)


def close_pairs(points: np.ndarray, radius: int, leaf: int = LEAF, seed: int = 11) -> Iterator[np.ndarray]:
    """Pairs of places of linked points, as arrays of two rows; a pair may come twice."""
    rng = np.random.default_rng(seed)
    stack = [np.arange(len(points))]
    while stack:
        places = stack.pop()
        if len(places) < 2:
            continue
        own = points[places]
        if len(places) > leaf and (split := choose_split(own, radius, rng)):
            d = distances(own, split[0])
            stack += [places[d <= split[1]], places[d > split[1] - radius]]
            continue
        for at in range(0, len(places), 512):  # a leaf, or points that no split separates
            near = np.bitwise_count(own[at : at + 512, None] ^ own[None, at:]) <= radius
            i, j = np.nonzero(np.triu(near, 1))
            if len(i):
                yield np.stack([places[at + i], places[at + j]])


def spanning(n: int, pairs: Iterator[np.ndarray]) -> np.ndarray:
    """Rows (i, j) of a forest with the same components as the pairs.

    Trees are hooked many at a time: each root takes part in one pair and goes below a
    smaller one, so no ring can arise, and pairs within a tree are dropped together.
    """
    parent = np.arange(n)

    def tops(x: np.ndarray) -> np.ndarray:
        top = parent[x]
        while (parent[top] != top).any():
            top = parent[top]
        parent[x] = top
        return top

    kept = [np.empty((2, 0), dtype=np.int64)]
    for block in pairs:
        while block.shape[1]:
            a, b = tops(block[0]), tops(block[1])
            apart = a != b
            block, high, low = block[:, apart], np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            high, first = np.unique(high, return_index=True)
            parent[high] = low[first]
            kept.append(block[:, first])
    return np.concatenate(kept, axis=1).T


def rows_per_shard(rows: int, slots: int) -> int:
    """Fingerprints that a shard should hold: small enough for every slot to have some, whatever the table's size."""
    return min(SHARD_ROWS, max(LEAF, -(-rows // (SHARDS_A_SLOT * slots))))


def links(fingerprints: DataFrame, radius: int = RADIUS, shard_rows: int | None = None) -> DataFrame:
    """(a, b) links of distinct fingerprints ``fp``: the same components as all close pairs."""
    spark = fingerprints.sparkSession
    rows = fingerprints.count()
    shard_rows = shard_rows or rows_per_shard(rows, spark.sparkContext.defaultParallelism)
    size = min(MAX_SAMPLE, max(2048, 64 * rows // shard_rows))
    drawn = fingerprints.orderBy(F.xxhash64("fp"), "fp").limit(size).toPandas()["fp"]
    tree, shards = upper_levels(np.sort(drawn.to_numpy(dtype=np.int64).view(np.uint64)), rows, shard_rows, radius)
    shared = spark.sparkContext.broadcast(tree)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for shard, places in route(shared.value, points, np.arange(len(points)), radius):
                yield pd.DataFrame({"shard": shard, "fp": points[places].view(np.int64)})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def finish(parts: list[np.ndarray]) -> pd.DataFrame:
            points = np.concatenate(parts).view(np.uint64)
            found = spanning(len(points), close_pairs(points, radius))
            return pd.DataFrame({"a": points[found[:, 0]].view(np.int64), "b": points[found[:, 1]].view(np.int64)})

        shard, parts = None, []
        for batch in batches:
            for key, group in batch.groupby("shard", sort=True):
                if key != shard and parts:
                    yield finish(parts)
                    parts = []
                shard = key
                parts.append(group["fp"].to_numpy(dtype=np.int64))
        if parts:
            yield finish(parts)

    dealt = fingerprints.mapInPandas(deal, "shard int, fp long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(shards, 10_000))
    return dealt.repartition(parts, "shard").sortWithinPartitions("shard").mapInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, fp, th) of all documents, and (fp, root) of all fingerprints."""
    rows = durable(with_fingerprints(docs, width), "simhash")
    single = durable(rows.select("fp").distinct(), "fingerprints")
    roots = connected_components(links(single, radius)).withColumnRenamed("node", "fp")
    return rows, single.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def cluster_documents(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp, component_id) of every row; the component is its smallest doc_id."""
    rows, roots = near_duplicates(docs, radius, width)
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    first = durable(first.join(roots, "fp"), "roots")
    component = first.groupBy("root").agg(F.min("first").alias("component_id"))
    named = first.join(component, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of each group: the smallest (doc_id, text hash)."""
    rows, roots = near_duplicates(docs, radius, width)
    first = rows.groupBy("fp").agg(F.min(F.struct("doc_id", "th")).alias("first"))
    kept = first.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("__id"), F.col("first.th").alias("__th"))
    own = docs.withColumn("__id", F.coalesce("doc_id", F.lit(LOWEST)))
    own = own.withColumn("__th", F.xxhash64(F.coalesce("text", F.lit(""))))
    return own.join(kept, ["__id", "__th"]).dropDuplicates(["__id", "__th"]).drop("__id", "__th").select(*docs.columns)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_documents(table(spark, sf_dir, "documents"))
    shown = lambda name: F.nullif(name, F.lit(LOWEST)).alias(name)
    return found.select(
        shown("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), shown("component_id")
    )
