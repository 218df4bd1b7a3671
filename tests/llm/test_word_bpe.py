"""The lexicon against a dict, and encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import pytest

from wardflow.llm.lexicon import Lexicon, build
from wardflow.llm.word_bpe import WordBpe, encode_documents, op5_word_bpe

ODD = ["", " ", "It's  we'LL\n12 ab12 !!", "<|endoftext|>x<|startoftext|> y <|", "日本語 Text", "é́ É", "İstanbul ΣΑΣ", "a b", "x" * 300, "!?" * 90, "ß ÿ × ÷ ² ª", "don't 'S", "\x1c \x85 z", "ǅ"]


def test_lexicon(tmp_path):
    rng = random.Random(1)
    words = {bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 7))) + rng.choice([b"", b"ing", b"ed"]) for _ in range(900)}
    entries = {w: [rng.randint(0, 9) for _ in range(rng.randint(1, 4))] for w in words}
    path = tmp_path / "lexicon"
    path.write_bytes(build(entries.items()))
    lexicon = Lexicon(str(path))
    assert lexicon.words == len(entries)
    for place, word in enumerate(sorted(entries)):
        assert lexicon.place(word) == place and lexicon.ids(word) == entries[word]
    for word in [b"", b"zzz", b"abcdabcdabcd", *(w + b"x" for w in entries)]:
        assert lexicon.ids(word) is None
    # Shared suffixes: far fewer states than a trie has.
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    assert len(lexicon.final) < len(prefixes) / 2
    with pytest.raises(ValueError):
        build([(b"a", [1]), (b"a", [2])])


def test_empty_lexicon(tmp_path):
    path = tmp_path / "lexicon"
    path.write_bytes(build([]))
    assert Lexicon(str(path)).ids(b"a") is None


@pytest.fixture(scope="module")
def library():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, public.path("word_bpe_49k.json")


def test_coder_equals_the_library(library):
    tokenizer, path = library
    coder = WordBpe(open(path, encoding="utf-8").read(), limit=5)
    for text in ODD:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids, text
        assert coder.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)
        assert coder.joined(text) == (" ".join(map(str, ids)), coder.decode(ids), len(ids))


def test_long_words_merge_alike(library):
    coder = WordBpe(open(library[1], encoding="utf-8").read())
    rng = random.Random(2)
    for _ in range(300):
        symbols = [rng.choice("aeinrstho") for _ in range(rng.randint(2, 60))]
        symbols[-1] += "</w>"
        assert coder._merge_short(list(symbols)) == coder._merge_long(list(symbols))


def test_small_table(spark, folder, library):
    tokenizer, _ = library
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted = set()
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        wanted.add((r["doc_id"], len(ids), digest(" ".join(map(str, ids))), digest(tokenizer.decode(ids, skip_special_tokens=False))))
    found = op5_word_bpe(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert {tuple(r) for r in found.collect()} == wanted


def test_odd_rows(spark, library):
    docs = spark.createDataFrame([(1, None, 5), (None, "a b", 6), (1, "a b", 7), (1, "a b", 7)], "doc_id long, text string, ids int")
    found = encode_documents(docs, library[1])
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    rows = sorted(((r["doc_id"], r["n_tokens"], r["decoded"]) for r in found.collect()), key=repr)
    assert rows == [(1, 0, ""), (1, 2, "a</w> b</w>"), (1, 2, "a</w> b</w>"), (None, 2, "a</w> b</w>")]
    assert encode_documents(docs.limit(0), library[1]).count() == 0
