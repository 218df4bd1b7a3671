"""Phrase collocations by Toivonen's sampling method.

Words and phrases of two or three words are counted per language, inside pieces that punctuation
and line ends divide. A phrase is frequent only if its first and its last part are, so:

1. A sample of a quarter of the rows proposes the words and pairs that it holds often enough for a
   threshold below the sample's share of the real one.
2. A full pass counts, exactly and over all rows, every proposed phrase and the negative border: the
   phrases that were not proposed though all their parts were. Words have no parts, so all are counted.
3. Border phrases that turn out frequent are failures of the sample. They join the collection, which
   opens further border phrases; another full pass counts those, until none fails. Three words are the
   longest phrase, so three full passes are the most.

The sample thus decides when a phrase is counted, never whether or how.

Tasks hold the collection as one array of bits under 64-bit hashes, at most ``MAX_BITS`` of them. Two
phrases on one bit only cause a phrase more to be counted, exactly as any other: bits are only added, and
what a pass counts is what the array opens now and did not open before. Counts are summed in each task
before the shuffle.

Defined results: a null text is empty; a null language counts as ``und``; a very long text is
taken in segments that overlap by two words; repeated rows count each time; an empty table, or one
without frequent phrases, gives no rows. Ties are broken by the order of the result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardflow.llm.common import mix, table
from wardflow.session import durable

MIN_COUNT = 10
TOP = 2000
#: A shorter candidate goes if a longer one that holds it has this percentage of its occurrences.
COVERED = 50
#: One row in so many is in the sample, and the count there that proposes a phrase.
SAMPLE_PART = 4
SAMPLE_COUNT = 2
MAX_BITS = 1 << 27
MIN_BITS = 1 << 20
#: Words of a segment; three of its word numbers must fit into 63 bits, so 2^20 at most.
SEGMENT = 1 << 19
#: Characters of texts that are counted together.
CHUNK = 1 << 21
#: Words with at least this share of all words are broadcast: no more than 100,000 of them.
HEAVY = 100_000

#: In whole numbers of up to 38 digits: exact for counts up to 10^16.
SCORE = """(1000000 * cast(cast(a as decimal(19,0)) * cast(a as decimal(19,0)) as decimal(32,0)))
div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"""

CUTS = b".,;:!?\n\x0b\x0c\r"
IS_CUT = np.zeros(256, dtype=bool)
IS_CUT[list(CUTS)] = True
IS_GAP = IS_CUT.copy()
IS_GAP[[0x20, 0x09]] = True
TO_SPACE = bytes(0x20 if IS_GAP[b] else b for b in range(256))
PAIR = np.uint64(0x9E3779B97F4A7C15)


def language_seed(lang: str) -> int:
    return zlib.crc32(lang.encode())


def word_hashes(words: Iterable[bytes], seed: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(seed)), dtype=np.uint64)


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * PAIR + right)


def phrase_hash(phrase: str, lang: str) -> int:
    """The hash of a phrase of one or two words, as the segments compute it."""
    hashes = word_hashes(phrase.encode().split(b" "), language_seed(lang))
    return int(hashes[0] if len(hashes) == 1 else pair_hashes(hashes[:1], hashes[1:])[0])


class Members:
    """A set of hashes as an array of bits; it may hold more than was put in, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def __contains__(self, value: int) -> bool:
        return bool(self.of(np.array([value], dtype=np.uint64))[0])

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


class Segment:
    """Up to ``SEGMENT`` starting places of phrases, with the two words after the last."""

    def __init__(self, words: list[bytes], piece: np.ndarray, starts: int, seed: int):
        numbers: defaultdict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__  # a new word gets the next number
        self.ids = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
        numbers.default_factory = None  # it refers to the dictionary itself
        self.words = list(numbers)
        self.hashes = word_hashes(numbers, seed)
        self.starts = starts
        self.second = np.flatnonzero(piece[1:] == piece[:-1])  # places where a pair starts
        self.third = np.flatnonzero(piece[2:] == piece[:-2])
        self.pairs = pair_hashes(self.hashes[self.ids[:-1]], self.hashes[self.ids[1:]])

    def opened(self, members: Members | None) -> tuple[np.ndarray, np.ndarray]:
        """Per place: whether the pair that starts there has both words in the set, and the triple both pairs."""
        if members is None:
            return np.zeros(len(self.pairs), dtype=bool), np.zeros(max(len(self.pairs) - 1, 0), dtype=bool)
        word, pair = members.of(self.hashes)[self.ids], members.of(self.pairs)
        return word[:-1] & word[1:], pair[:-1] & pair[1:]

    def counted(self, width: int, places: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Word numbers of the distinct phrases at the places, and their counts."""
        places = places[places < self.starts]
        key = self.ids[places]
        for i in range(1, width):
            key = key << 21 | self.ids[places + i]
        key, counts = np.unique(key, return_counts=True)
        return [key >> 21 * (width - 1 - i) & 0x1FFFFF for i in range(width)], counts


def segments(texts: list[str], lang: str) -> Iterator[Segment]:
    data = "\n".join(texts).encode().lower()  # bytes: only A-Z change
    raw = np.frombuffer(data, dtype=np.uint8)
    gap = np.ones(len(raw) + 1, dtype=bool)
    gap[1:] = IS_GAP[raw]
    begins = np.flatnonzero(gap[:-1] & ~gap[1:])
    piece = np.searchsorted(np.flatnonzero(IS_CUT[raw]), begins)
    del raw, gap
    for at in range(0, len(begins), SEGMENT):
        end = min(at + SEGMENT, len(begins))
        stop = begins[end + 2] if end + 2 < len(begins) else len(data)
        words = data[begins[at] : stop].translate(TO_SPACE).split()
        yield Segment(words, piece[at : end + 2], end - at, language_seed(lang))


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """(language, texts) in chunks of about ``CHUNK`` characters, a longer text by itself."""
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                held.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= CHUNK:
                    yield lang, held.pop(lang)
                    del sizes[lang]
            if sum(sizes.values()) >= 4 * CHUNK:  # many languages: all go
                yield from held.items()
                held, sizes = {}, {}
    yield from held.items()


def _rows(docs: DataFrame) -> DataFrame:
    """(text, lang, drawn) of every row."""
    text, lang = F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("und"))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE_PART)) == 0
    return docs.select(text.alias("text"), lang.alias("lang"), drawn.alias("drawn"))


def _proposed(rows: DataFrame) -> DataFrame:
    """Hashes of the words and pairs that the sample holds ``SAMPLE_COUNT`` times or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in by_language(batches):
            for part in segments(texts, lang):
                places = part.second[part.second < part.starts]
                pairs, n_pairs = np.unique(part.pairs[places], return_counts=True)
                n_words = np.bincount(part.ids[: part.starts], minlength=len(part.words))
                for hashes, counts in ((part.hashes, n_words), (pairs, n_pairs)):
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "c"])

    found = rows.where("drawn").select("text", "lang").mapInArrow(work, "h long, c long")
    return found.groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= SAMPLE_COUNT).select("h")


def _set_bits(hashes: DataFrame, n_bits: int) -> np.ndarray:
    """The array of bits of all hashes. Tasks build its blocks; the driver gets n_bits bits at most."""
    block_bits = 1 << 16

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch["at"].to_numpy()
            for block in np.unique(at // block_bits).tolist():
                own = np.zeros(block_bits, dtype=np.uint8)
                own[at[at // block_bits == block] % block_bits] = 1
                own = np.packbits(own, bitorder="little")
                blocks[block] = blocks[block] | own if block in blocks else own
        if blocks:
            yield pd.DataFrame({"block": list(blocks), "bits": [b.tobytes() for b in blocks.values()]})

    at = hashes.select(F.col("h").bitwiseAND(F.lit(n_bits - 1)).alias("at"))
    dealt = at.repartition((F.col("at") / block_bits).cast("int"))
    out = np.zeros((n_bits // block_bits, block_bits // 8), dtype=np.uint8)
    for row in dealt.mapInPandas(work, "block int, bits binary").toLocalIterator():
        out[row["block"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out.reshape(-1)


def _count(rows: DataFrame, before: Members | None, now: Members) -> DataFrame:
    """(phrase, lang, f) of all phrases that ``now`` opens and ``before`` did not, if frequent.

    Without ``before`` all words are counted too, and an empty phrase holds the number of words.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((before, now))  # 2 x MAX_BITS bits at most

    def batch(lang: str, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        keys = pc.binary_join_element_wise(phrases, pa.scalar(lang), "\n")
        return pa.RecordBatch.from_arrays([keys, pa.array(counts.astype(np.int64))], ["key", "c"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, now = shared.value
        for lang, texts in by_language(batches):
            for part in segments(texts, lang):
                names = pa.array(part.words, pa.binary()).cast(pa.string())
                if before is None:
                    yield batch(lang, names, np.bincount(part.ids[: part.starts], minlength=len(names)))
                    yield batch(lang, pa.array([""]), np.array([part.starts]))
                old2, old3 = part.opened(before)
                new2, new3 = part.opened(now)
                new2, new3 = new2 & ~old2, new3 & ~old3
                for width, places, fresh in ((2, part.second, new2), (3, part.third, new3)):
                    ids, counts = part.counted(width, places[fresh[places]])
                    for at in range(0, len(counts), 100_000):
                        some = [names.take(pa.array(i[at : at + 100_000])) for i in ids]
                        yield batch(lang, pc.binary_join_element_wise(*some, " "), counts[at : at + 100_000])
                # Nothing of a segment is held while the next is built.
                del part, names, old2, old3, new2, new3, places, fresh, ids, counts

    found = rows.select("text", "lang").mapInArrow(work, "key string, c long")
    found = found.groupBy("key").agg(F.sum("c").alias("f")).where((F.col("f") >= MIN_COUNT) | F.col("key").startswith("\n"))
    phrase = F.substring_index("key", "\n", 1)
    lang = F.expr("substring(key, length(substring_index(key, '\n', 1)) + 2)")
    return durable(found.select(phrase.alias("phrase"), lang.alias("lang"), "f"), "phrases")


def _failures(found: DataFrame, now: Members) -> DataFrame:
    """Hashes of the frequent words and pairs that are not in the collection."""
    shared = found.sparkSession.sparkContext.broadcast(now)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = np.array([phrase_hash(p, lang) for p, lang in zip(batch["phrase"], batch["lang"])], dtype=np.uint64)
            yield pd.DataFrame({"h": hashes[~shared.value.of(hashes)].view(np.int64)})

    short = found.where("phrase <> '' and length(phrase) - length(replace(phrase, ' ', '')) < 2")
    return short.mapInPandas(work, "h long")


def frequent_phrases(docs: DataFrame) -> DataFrame:
    """(phrase, lang, f): exact counts of all words and phrases that occur ``MIN_COUNT`` times or more in a
    language, and the number of its words under the empty phrase."""
    rows = _rows(docs)
    proposed = durable(_proposed(rows), "proposed")
    size = proposed.count()
    n_bits = min(MAX_BITS, max(MIN_BITS, 1 << (8 * size).bit_length()))
    before, now, parts = None, Members(_set_bits(proposed, n_bits)), []
    while True:
        found = _count(rows, before, now)
        parts.append(found)
        failed = durable(_failures(found, now), "failures")
        if failed.isEmpty():
            break
        before, now = now, Members(now.bits | _set_bits(failed, n_bits))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _first(ranked: DataFrame, top: int) -> DataFrame:
    """The first rows of each language, with ``rank``. A language is first cut down in salted parts."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*order)
    some = ranked.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first phrases of each language."""
    found = frequent_phrases(docs)
    totals = found.where("phrase = ''").select("lang", F.col("f").alias("n"))
    counts = found.where("phrase <> ''").withColumn("w", F.split("phrase", " ")).withColumn("k", F.size("w"))
    candidates = counts.where("k > 1")

    first, last = F.col("w")[0], F.element_at("w", -1)
    front = F.concat_ws(" ", F.col("w")[0], F.col("w")[1])
    back = F.concat_ws(" ", F.element_at("w", -2), F.element_at("w", -1))

    def need(cut: int, left, right):
        return [F.struct(F.lit(cut).alias("cut"), F.lit(s).alias("side"), p.alias("part")) for s, p in (("l", left), ("r", right))]

    needs = F.when(F.col("k") == 2, F.array(*need(1, first, last))).otherwise(F.array(*need(1, first, back), *need(2, front, last)))
    parts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.inline(needs))
    one = counts.select("lang", F.col("phrase").alias("part"), "f")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    heavy = one.where(~F.col("part").contains(" ") & (F.col("f") * HEAVY >= n_words)).withColumnRenamed("f", "heavy")
    parts = parts.join(F.broadcast(heavy), ["lang", "part"], "left")  # at most HEAVY rows
    light = parts.where("heavy is null").join(one, ["lang", "part"])
    parts = parts.where("heavy is not null").withColumn("f", F.col("heavy")).unionByName(light)
    cuts = parts.groupBy("lang", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r")
    )
    cuts = cuts.withColumn("score", F.expr(SCORE))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    scored = scored.select("lang", "phrase", "a", "low.l", "low.r", "low.score")

    longer = candidates.where("k = 3").select("lang", "f", F.explode(F.array(front, back)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {COVERED} * a")
    out = _first(kept.drop("longer"), top).join(totals, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM worded
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM worded
), counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= {MIN_COUNT}
), cuts AS (
  SELECT lang, phrase, k, f, 1 AS cut, w[1] AS lp, array_to_string(w[2:], ' ') AS rp FROM candidates
  UNION ALL
  SELECT lang, phrase, k, f, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE k = 3
), scored AS (
  SELECT c.lang, c.phrase, c.k, c.f AS a, c.cut, l.f AS l, r.f AS r,
         ((1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN counted l ON l.lang = c.lang AND l.phrase = c.lp JOIN counted r ON r.lang = c.lang AND r.phrase = c.rp
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, f, w[1] || ' ' || w[2] AS part FROM candidates WHERE k = 3
    UNION ALL
    SELECT lang, f, w[2] || ' ' || w[3] FROM candidates WHERE k = 3) GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.part = s.phrase
  WHERE g.f IS NULL OR 100 * g.f < {COVERED} * s.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
