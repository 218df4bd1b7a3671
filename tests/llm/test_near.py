"""SimHash, trees and components against brute force; packed ids against the library."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardflow.llm import packed_ids, simhash
from wardflow.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, root string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y") for i, t in rows], SCHEMA)


def slow_simhash(text: str) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps: list[int], radius: int = 3) -> list[int]:
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    return label


@pytest.mark.parametrize("text", ["", "  \n", "One", "one TWO", "A b c", "a b c a b c a b c", "Ünï Çode ÀB x y\tz"])
def test_simhash(text):
    assert simhash.simhash(text) == slow_simhash(text)


@pytest.mark.parametrize("leaf", [4, 40])
def test_every_close_pair_is_found(leaf):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 400, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in (1, 2, 3, 4) for _ in range(60)]
    points = np.unique(np.concatenate([base, base[: len(flips)] ^ np.array(flips), [0, 1, 3, 7, 15]]).astype(np.uint64))
    wanted = {(i, j) for i in range(len(points)) for j in range(i) if int(points[i] ^ points[j]).bit_count() <= 3}
    found = {(max(p), min(p)) for block in simhash.close_pairs(points, 3, leaf) for p in block.T.tolist()}
    assert found == wanted
    tree, shards = simhash.upper_levels(points, len(points), 50, 3)
    assert shards > 3
    dealt = list(simhash.route(tree, points, np.arange(len(points)), 3))
    together = {(max(a, b), min(a, b)) for _, p in dealt for a in p.tolist() for b in p.tolist() if a != b}
    assert wanted <= together


def test_points_that_nothing_separates():
    points = np.array([1 << i for i in range(64)] * 1, dtype=np.uint64)
    pairs = [p for block in simhash.close_pairs(points, 3, 8) for p in block.T.tolist()]
    assert len({tuple(sorted(p)) for p in pairs}) == 64 * 63 // 2
    assert len(simhash.spanning(64, simhash.close_pairs(points, 3, 8))) == 63


def test_a_forest_of_a_dense_ball():
    """Thousands of points of which each is close to hundreds: as many links as points, less one for each component."""
    rng = np.random.default_rng(5)
    flips = {sum(1 << int(b) for b in rng.choice(30, 3, replace=False)) for _ in range(20_000)}
    points = np.array([*flips, 2**63, 2**63 + 1, 2**40 - 1], dtype=np.uint64)
    forest = simhash.spanning(len(points), simhash.close_pairs(points, 3))
    assert (np.bitwise_count(points[forest[:, 0]] ^ points[forest[:, 1]]) <= 3).all()
    label = list(range(len(points)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in forest.tolist():
        a, b = top(i), top(j)
        assert a != b
        label[max(a, b)] = min(a, b)
    for block in simhash.close_pairs(points, 3):
        assert all(top(i) == top(j) for i, j in block[:, :: 997].T.tolist())
    assert {top(i) for i in range(len(points))} == {0, len(points) - 1}  # the ball, and the last point alone
    assert len(forest) == len(points) - 2
    assert simhash.spanning(3, iter([])).shape == (0, 2)


@pytest.mark.parametrize("rows, slots, shard", [(0, 8, 256), (10_000, 8, 313), (40_000, 6, 1667), (10**9, 8, 50_000), (10**6, 4000, 256)])
def test_shards_follow_rows_and_slots(rows, slots, shard):
    assert simhash.rows_per_shard(rows, slots) == shard


def test_links_over_many_shards(spark):
    """Far more fingerprints than one shard takes, of which every third has close ones on any side of a border."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(1000)], dtype=np.uint64)
    points = np.unique(np.concatenate([base, base[:1000] ^ flips, base[:500] ^ flips[500:]]))
    assert len(points) > 4 * simhash.rows_per_shard(len(points), spark.sparkContext.defaultParallelism)
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    wanted = set()
    for i in range(len(points)):
        near = np.nonzero(np.bitwise_count(points ^ points[i]) <= 3)[0]
        wanted |= {tuple(sorted((int(points.view(np.int64)[i]), int(points.view(np.int64)[j])))) for j in near if j > i}
    found = {tuple(sorted(r)) for r in simhash.links(df).collect()}
    assert found <= wanted  # a forest leaves out pairs whose ends are joined already

    def roots(edges):
        frame = spark.createDataFrame(sorted(edges), "a long, b long")
        return {r["node"]: r["root"] for r in connected_components(frame).collect()}

    assert len(wanted) > 1400 and roots(found) == roots(wanted)


def test_components_of_paths_rings_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7000, 7000)] + [(500, k) for k in range(501, 560)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100), **dict.fromkeys(range(500, 560), 500)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_of_the_small_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    fps = [slow_simhash(t) for _, t in rows]
    wanted = {(i, f"{fp:016x}", rows[c][0]) for (i, _), fp, c in zip(rows, fps, slow_components(fps))}
    found = {tuple(r) for r in simhash.op7_simhash(spark, folder).select("doc_id", "fingerprint", "component_id").collect()}
    assert found == wanted


def test_odd_documents(spark):
    rows = [(5, None), (3, ""), (9, " "), (None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (8, "q w e r t y")]
    found = [tuple(r) for r in simhash.cluster_documents(frame(spark, rows)).collect()]
    assert sorted((i, c) for i, _, c in found) == sorted(
        [(5, 3), (3, 3), (9, 3), (simhash.LOWEST, simhash.LOWEST), (4, simhash.LOWEST), (4, simhash.LOWEST), (8, 8)]
    )
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 0), (True, 3), (True, 8)]
    assert simhash.cluster_documents(frame(spark, [])).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 999, dtype=np.uint32)
    assert (packed_ids.unpack(packed_ids.pack(ids, bits), bits, len(ids)) == ids).all()
    data = packed_ids.write_segment([4, 5, 6], [ids[:1], ids[1:1], ids[1:]], bits, 70, block=64)
    segment = packed_ids.Segment(data)
    assert (segment.before, segment.n_ids) == (70, 999)
    assert (segment.document(2) == ids[1:]).all() and len(segment.document(1)) == 0
    for a, b in [(0, 999), (63, 65), (64, 128), (998, 999), (500, 500)]:
        assert (segment.ids(a, b) == ids[a:b]).all()


def test_whole_widths_are_copied(monkeypatch):
    ids = np.array([0, 1, 50256, 65535], dtype=np.uint32)
    bits = np.packbits(np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=16), bitorder="little")
    monkeypatch.setattr(packed_ids.np, "unpackbits", None)
    assert packed_ids.pack(ids, 16) == bits.tobytes()
    assert packed_ids.unpack(bits.tobytes(), 16, 4).tolist() == ids.tolist()


def test_an_id_beyond_the_width():
    with pytest.raises(ValueError):
        packed_ids.write_segment([1], [np.array([8], dtype=np.uint32)], 3, 0)


def library(name):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


ODD = ["", " ", "a", "It's  we'LL   \n\n x 12 ab12", "<|endoftext|> x", "日本語 text", "a b", "é́", "''s 's  '", "tab\t\tend \n", "x\x0by", "²½", "ǅ ß"]


def test_byte_encoder_equals_the_library():
    tokenizer = library("byte_bpe_50k.json")
    encode = packed_ids.ByteEncoder(tokenizer.to_str(), limit=20)
    for text, ids in zip(ODD, encode(ODD)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_plain_texts_and_new_pieces():
    """Every Latin-1 character beside others, and pieces that are forgotten between and within groups of texts."""
    tokenizer = library("byte_bpe_50k.json")
    texts = [f"a{chr(c)}1 {chr(c)} 'tis{chr(c)}{chr(c)}\n é{chr(c)}" for c in range(256)] * 2
    encode = packed_ids.ByteEncoder(tokenizer.to_str(), limit=300)
    assert encode._is_plain("tab\t é\r\n") and not any(map(encode._is_plain, ["\x0b", "×", "Ā", "<|endoftext|>"]))
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packed_ids_of_the_small_table(spark, folder):
    tokenizer = library("byte_bpe_50k.json")
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    wanted, start = set(), 0
    for name, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        wanted.add((name, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert {tuple(r) for r in packed_ids.op9_packed_ids(spark, folder).collect()} == wanted


def test_ids_of_odd_documents(spark):
    encode = lambda batch: [np.arange(len(t), dtype=np.uint32) for t in batch]
    segments = packed_ids.write_ids(frame(spark, [(2, "ab"), (None, "abc"), (1, None), (1, "a")]), encode, 4, 2)
    found = packed_ids.read_documents(segments, "size long", lambda s: {"size": s.lengths}).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["size"]) for r in found] == [(packed_ids.LOWEST, 0, 4), (1, 4, 1), (1, 5, 2), (2, 7, 3)]
    empty = packed_ids.write_ids(frame(spark, []), encode, 4, 2)
    assert packed_ids.read_documents(empty, "size long", lambda s: {"size": s.lengths}).count() == 0


def test_segments_split_between_documents(spark, monkeypatch):
    encode = lambda batch: [np.arange(len(t), dtype=np.uint32) for t in batch]
    rows = [(i, "x" * (i % 9)) for i in range(60)]
    segments = packed_ids.write_ids(frame(spark, rows), encode, 4, None)
    starts = {r["doc_id"]: r["start"] for r in packed_ids.read_documents(segments, "size long", lambda s: {"size": s.lengths}).collect()}
    assert starts == {i: sum(j % 9 for j in range(i)) for i in range(60)}
    assert segments.where(F.col("n_ids") > packed_ids.SEGMENT_IDS).count() == 0
