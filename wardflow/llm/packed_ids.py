"""Token ids in fixed-width bit-packed files, with block offsets for random access.

An id takes the fewest bits that the vocabulary needs. A file (``segment``) is::

    magic "WIDS", bits per id (u1), padding (u1 x 3), ids per block (u4),
    documents (u8), ids (u8), ids before it in its shard (u8),
    doc_id (i8 each), ids of each document (u8 each),
    byte offset of each block, and of the end (u8 each),
    blocks: ids, lowest bit first, each block padded to whole bytes

All numbers are little-endian. A document is never cut. Documents lie in ascending
doc_id order: shard after shard, segment after segment. Segments are rows of a Parquet
table, since Spark's writers reach every store and executors share no local folder.

Defined results: a null text is empty, and an empty document holds the end id alone; a null
doc_id sorts first and reads back as null (-2^63 in the file); rows with one doc_id are
ordered by text; an empty table gives no segment. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import hold, table, texts
from wardflow.session import durable

MAGIC = b"WIDS"
HEADER = struct.Struct("<4sB3xIQQQ")
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20
LOWEST = -(2**63)
END_ID = 2
#: Texts whose new pieces are encoded together.
TEXTS = 100
#: Widths of whole numbers: the same bytes without going through single bits.
WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in WHOLE:
        return ids.astype(WHOLE[bits]).tobytes()
    wide = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=bits)
    return np.packbits(wide, bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in WHOLE:
        return np.frombuffer(data, WHOLE[bits], count).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little", count=count * bits)
    wide = np.packbits(flat.reshape(count, bits), axis=1, bitorder="little")
    out = np.zeros((count, 4), dtype=np.uint8)
    out[:, : wide.shape[1]] = wide
    return out.view("<u4").reshape(-1)


def write_segment(doc_ids: list[int], ids: list[np.ndarray], bits: int, before: int, block: int = BLOCK_IDS) -> bytes:
    every = np.concatenate(ids) if ids else np.empty(0, dtype=np.uint32)
    if len(every) and int(every.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    blocks = [pack(every[i : i + block], bits) for i in range(0, len(every), block)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return b"".join(
        [
            HEADER.pack(MAGIC, bits, block, len(doc_ids), len(every), before),
            np.array(doc_ids, dtype="<i8").tobytes(),
            np.array([len(x) for x in ids], dtype="<u8").tobytes(),
            offsets.tobytes(),
            *blocks,
        ]
    )


class Segment:
    """A written segment: its documents, and any range of its ids without unpacking the rest."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.bits, self.block, docs, self.n_ids, self.before = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment of packed ids")
        at = HEADER.size
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.lengths = np.frombuffer(data, "<u8", docs, at + 8 * docs).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at + 16 * docs).astype(np.int64)
        self.body = at + 16 * docs + 8 * (blocks + 1)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids at places start .. stop - 1 of the segment."""
        if stop <= start:
            return np.empty(0, dtype=np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        found = []
        for i in range(first, last + 1):
            count = min(self.block, self.n_ids - i * self.block)
            found.append(unpack(self.data[self.body + self.offsets[i] : self.body + self.offsets[i + 1]], self.bits, count))
        return np.concatenate(found)[start - first * self.block : stop - first * self.block]

    def document(self, place: int) -> np.ndarray:
        start = int(self.starts[place])
        return self.ids(start, start + int(self.lengths[place]))


class ByteEncoder:
    """Ids of whole texts, as the tokenizers library gives them for a byte-level BPE file.

    Texts of plain Latin characters are cut into the pieces that the file's pre-tokenizer
    makes, and the library encodes each piece once; pieces are kept up to ``limit``. All
    other texts go to the library whole.
    """

    #: In Latin-1, the characters for which LETTER and the digits 0-9 are all letters and numbers.
    PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
    LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
    PIECE = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[0-9]+| ?[^\s0-9{LETTER}]+|\s+(?!\S)|\s+"
    )

    def __init__(self, spec: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if special else None
        self.known: dict[str, bytes] = {}  # ids as little-endian u4
        self.limit = limit

    def clear(self) -> None:
        self.known.clear()

    def _is_plain(self, text: str) -> bool:
        try:
            return not text.encode("latin-1").translate(None, self.PLAIN) and not (self.special and self.special.search(text))
        except UnicodeEncodeError:
            return False

    def __call__(self, batch: Iterable[str]) -> list[np.ndarray]:
        batch = list(batch)
        hold(self)
        return [ids for at in range(0, len(batch), TEXTS) for ids in self._encode(batch[at : at + TEXTS])]

    def _encode(self, batch: list[str]) -> Iterator[np.ndarray]:
        cut, known, parted = self.PIECE.findall, self.known.get, []
        missing: dict = {}
        for text in batch:
            if not self._is_plain(text):
                parted.append((None, text))
                continue
            pieces = cut(text)
            found = list(map(known, pieces))  # each piece is looked up while it is at hand
            holes = [(k, pieces[k]) for k, ids in enumerate(found) if ids is None]
            missing.update(dict.fromkeys(p for _, p in holes))
            parted.append((found, holes))
        encoded = self.tokenizer.encode_batch_fast(list(missing), add_special_tokens=False)
        missing = dict(zip(missing, (array("I", e.ids).tobytes() for e in encoded)))
        if len(self.known) + len(missing) > self.limit:
            self.known.clear()
        self.known.update(missing)
        for found, rest in parted:
            if found is None:
                yield np.array(self.tokenizer.encode(rest, add_special_tokens=False).ids, dtype=np.uint32)
                continue
            for k, piece in rest:
                found[k] = missing[piece]
            yield np.frombuffer(b"".join(found), dtype=np.uint32)


_ENCODERS: dict[int, ByteEncoder] = {}


def byte_encoder(spec: str) -> ByteEncoder:
    """One encoder for each worker process, so that its pieces last from task to task."""
    key = zlib.crc32(spec.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = ByteEncoder(spec)
    return _ENCODERS[key]


def write_ids(
    docs: DataFrame, encode: Callable[[Iterable[str]], list[np.ndarray]], bits: int, end_id: int | None, path: str | None = None
) -> DataFrame:
    """Encode all rows of ``docs`` in ascending doc_id order; the stored table of segments."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, place, before = TaskContext.get().partitionId(), 0, 0
        names, ids, held = [], [], 0

        def segment() -> pd.DataFrame:
            data = write_segment(names, ids, bits, before)
            return pd.DataFrame({"shard": [shard], "place": [place], "n_docs": [len(names)], "n_ids": [held], "data": [data]})

        for batch in batches:
            for name, own in zip(batch["doc_id"].tolist(), encode(batch["text"])):
                if end_id is not None:
                    own = np.append(own, np.uint32(end_id))
                if names and held + len(own) > SEGMENT_IDS:
                    yield segment()
                    place, before = place + 1, before + held
                    names, ids, held = [], [], 0
                names.append(name)
                ids.append(own)
                held += len(own)
        if names:
            yield segment()

    rows = texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(LOWEST)))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    found = rows.mapInPandas(work, "shard int, place int, n_docs long, n_ids long, data binary")
    if path is None:
        return durable(found, "packed")
    found.write.parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def read_documents(segments: DataFrame, fields: str, take: Callable[[Segment], dict]) -> DataFrame:
    """``take(segment)`` for every segment, with ``start``: ids before the document in all shards.

    ``take`` returns a column for each of ``fields``, one value per document. Only
    one row per shard is totalled and broadcast.
    """
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, data in zip(batch["shard"], batch["data"]):
                segment = Segment(bytes(data))
                own = {"shard": shard, "doc_id": segment.doc_ids, "at": segment.before + segment.starts, "n_tokens": segment.lengths}
                yield pd.DataFrame({**own, **take(segment)})

    rows = segments.select("shard", "data").mapInPandas(work, f"shard int, doc_id long, at long, n_tokens long, {fields}")
    rows = rows.join(F.broadcast(bases), "shard")  # one row per shard
    return rows.withColumn("start", F.col("base") + F.col("at")).drop("shard", "at", "base")


def op9_packed_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """``tokenizer``: path of the vocabulary file, read by the driver and sent to the tasks."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    bits = bits_for(byte_encoder(spec.value).tokenizer.get_vocab_size())
    segments = write_ids(table(spark, sf_dir, "documents"), lambda batch: byte_encoder(spec.value)(batch), bits, END_ID)

    def crc(segment: Segment) -> dict:
        ids = segment.ids(0, segment.n_ids).astype("<u4")
        ends = segment.starts + segment.lengths
        return {"ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(segment.starts, ends)]}

    found = read_documents(segments, "ids_crc32 long", crc)
    return found.select(F.nullif("doc_id", F.lit(LOWEST)).alias("doc_id"), "start", "n_tokens", "ids_crc32")
