"""Benchmark decontamination: short test items found inside long documents.

An item is the set of its ``width``-word shingles. A document contains it if it has at
least ``threshold`` of them; letter case and white space do not matter.

Containment MinHash: every shingle has one hash. An item's sketch is its bottom-m hashes, and
m depends on the partition of items by size: of an item with q shingles, a document may lack at
most floor((1 - threshold) * q), so the m = that + 1 smallest must share one with every
document that contains the item. Items are partitioned by size (powers of two), and a
partition's m is that of its largest size, no more than q. Documents are long and items
short, so the document side is not sketched: all its shingle hashes are looked up among the
sketches of all partitions, and a document of fewer distinct shingles than threshold * q is no
candidate. No containing document is missed. Candidates are verified on the words themselves.

Items are dealt into blocks of about ``block_words`` words by a hash of their id. A block is what
is collected and broadcast at a time; more items mean more passes over the documents.

Defined results: null texts are empty; an item without words is never found; an item with
fewer words than a shingle is one shingle of all its words; repeated shingles of an item count
once; rows of one doc_id (or item_id) each count by themselves; a null id stays null; empty
tables give no rows. Other columns are passed through or not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm.common import Cache, rolling, table, texts

WIDTH = 5
THRESHOLD = 0.8
BLOCK_WORDS = 1_000_000

_WORDS = Cache(xxhash.xxh64_intdigest, 400_000)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))


def needed(q: int, threshold: float) -> int:
    """Fewest of q shingles that make a containment."""
    return next(k for k in range(int(q * threshold), q + 1) if k / q >= threshold)


class Index:
    """The sketches of one block of items, by shingle width, and the items to verify."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int, threshold: float):
        self.items: list[tuple[int | None, dict[int, set[bytes]], int, int]] = []
        sketches: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            w = min(width, len(words))
            shingles: dict[int, set[bytes]] = defaultdict(set)
            for h, i in zip(rolling(word_hashes(words), w).tolist(), range(len(words))):
                shingles[h].add(b" ".join(words[i : i + w]))
            q = sum(map(len, shingles.values()))
            largest = (1 << q.bit_length()) - 1  # of the size partition
            m = min(q, largest - needed(largest, threshold) + 1)
            for h in sorted(shingles)[:m]:
                sketches[w][h].append(len(self.items))
            self.items.append((item_id, dict(shingles), q, w))
        self.threshold = threshold
        self.widths = {}
        for w, found in sketches.items():
            hashes = np.array(sorted(found), dtype=np.uint64)
            self.widths[w] = (hashes, [found[h] for h in hashes.tolist()])

    def contained(self, text: str) -> Iterator[tuple[int | None, int, int]]:
        """(item_id, shared shingles, shingles) of each item that ``text`` contains."""
        words = words_of(text)
        own = word_hashes(words)
        for w, (hashes, holders) in self.widths.items():
            rolled = rolling(own, w)
            if not len(rolled):
                continue
            places = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            hits = np.unique(places[hashes[places] == rolled])
            if not len(hits):
                continue
            candidates = {k for place in hits.tolist() for k in holders[place]}
            order = np.argsort(rolled, kind="stable")
            ranked = rolled[order]
            for k in sorted(candidates):
                item_id, shingles, q, _ = self.items[k]
                if len(rolled) < needed(q, self.threshold):
                    continue
                shared = 0
                for h, wanted in shingles.items():
                    a, b = (np.searchsorted(ranked, np.uint64(h), side=side) for side in ("left", "right"))
                    seen = {b" ".join(words[i : i + w]) for i in order[a:b].tolist()} if b > a else set()
                    shared += len(wanted & seen)
                if shared / q >= self.threshold:
                    yield item_id, shared, q


def item_blocks(items: DataFrame, block_words: int) -> Iterator[Broadcast]:
    """The rows of ``items`` in broadcast blocks of about ``block_words`` words; eight bytes count as one word at least."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    words = F.size(F.split("text", r"[\x20\x09-\x0D]+"))
    total = items.agg(F.sum(F.greatest(words, F.floor(F.octet_length("text") / 8)))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield items.sparkSession.sparkContext.broadcast([tuple(r) for r in own.collect()])


def find_items(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, th, item_id, n_shared, n_shingles): the items that each document contains.

    ``th`` is the document's xxhash64, to tell rows of one id apart.
    """
    rows = texts(docs).withColumn("th", F.xxhash64("text"))
    schema = "doc_id long, th long, item_id long, n_shared long, n_shingles long"
    found = None
    for shared in item_blocks(items, block_words):

        def work(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = Index(shared.value, width, threshold)
            for batch in batches:
                out = [
                    (i, th, *hit)
                    for i, th, text in zip(batch["doc_id"].astype(object), batch["th"], batch["text"])
                    for hit in index.contained(text)
                ]
                frame = pd.DataFrame(out, columns=["doc_id", "th", "item_id", "n_shared", "n_shingles"])
                yield frame.astype({"doc_id": "Int64", "item_id": "Int64"})

        part = rows.mapInPandas(work, schema)
        found = part if found is None else found.union(part)
    return found


def drop_contaminated(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` without the rows that contain an item; each row is judged where it is read."""
    for shared in item_blocks(items, block_words):
        docs = docs.where(_is_clean(shared, width, threshold)(F.coalesce("text", F.lit(""))))
    return docs


def _is_clean(shared: Broadcast, width: int, threshold: float):
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(shared.value, width, threshold)
        for batch in batches:
            yield pd.Series([next(index.contained(t), None) is None for t in batch], dtype="bool")

    return clean


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_id", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    )


OP2_SQL = r"""
WITH split_docs AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents
), split_items AS (
  SELECT item_id, row_number() OVER () AS r, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, r, least(5, len(w)) AS n,
         unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(w[i:i + least(5, len(w)) - 1], ' '))) AS s
  FROM split_items WHERE len(w) > 0
), widths AS (SELECT DISTINCT n FROM item_shingles),
doc_shingles AS (
  SELECT DISTINCT doc_id, r, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
  FROM split_docs, widths WHERE len(w) >= n
), sizes AS (SELECT r, count(*) AS q FROM item_shingles GROUP BY r)
SELECT d.doc_id, i.item_id, count(*) AS n_shared, max(q) AS n_shingles, count(*) / max(q) AS containment
FROM doc_shingles d JOIN item_shingles i USING (n, s) JOIN sizes z ON z.r = i.r
GROUP BY d.doc_id, d.r, i.item_id, i.r HAVING count(*) / max(q) >= 0.8
"""
