"""Encoding and decoding against the tokenizers library."""

import random
from collections import Counter
from hashlib import sha256

import pytest
from corpus_helpers import DATA

from commerce_lake.llm import bpe, queries

PATH = bpe.public_vocabulary()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def packed(values):
    return b"".join(v.to_bytes(4, "little") for v in values)


def test_tree_of_pieces_is_the_encoding(library):
    voc, rng = bpe.Vocabulary(PATH), random.Random(3)
    for trial in range(300):
        text = "".join(rng.choice("abehinorstué") for _ in range(rng.randrange(1, 300)))
        if trial % 3 == 0:
            text = rng.choice(["ab", "the", "hello", "é"]) * rng.randrange(1, 60)
        if trial % 4 == 0:
            text += "!?" * rng.randrange(20) + "'s12 <|endoftext|>" + "İΣ日本" * rng.randrange(20)
        got, part = [], []
        for piece, unsplit, last in voc.pieces(text, rng.choice([1, 2, 3, 8, 64])):
            own = list(memoryview(voc.encode_piece(piece, unsplit, last)).cast("I"))
            if not unsplit:
                got += own
                continue
            part.append((own, last))
            if last:
                got += voc.tree(part)
                part = []
        assert got == ids(library, text)
        assert voc.encode(text) == packed(ids(library, text))


def test_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 4)
    voc = bpe.Vocabulary(PATH)
    for text in ("one two three four five six one two", "six five, four. three! two? one"):
        assert voc.encode(text) == packed(ids(library, text))


def test_edge_cases(docs, no_docs, library):
    encoded = bpe.encode(docs, PATH, piece=64)
    got = Counter((r.doc_id, bytes(r.ids)) for r in encoded.collect())
    assert got == Counter((r.doc_id, packed(ids(library, r.text or ""))) for r in docs.collect())
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0
    decoded = {(r.doc_id, r.decoded) for r in bpe.decode(encoded, PATH).collect()}
    assert decoded == {(r.doc_id, r.decoded) for r in bpe.encode_decode(docs, PATH, piece=64).collect()}
    assert decoded == {(r.doc_id, library.decode(ids(library, r.text or ""), skip_special_tokens=False)) for r in docs.collect()}


def test_query(spark, library):
    got = {r.doc_id: r for r in queries.op1_bpe_encode_decode(spark, str(DATA)).collect()}
    for row in spark.read.parquet(f"{DATA}/documents.parquet").collect():
        own = ids(library, row.text or "")
        want = (len(own), sha256(packed(own)).hexdigest(), sha256(library.decode(own, skip_special_tokens=False).encode()).hexdigest())
        r = got[row.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want


def test_plain_text_goes_by_words(library):
    """A word is encoded once, whatever marks stand around it; the ids are those of the library."""
    voc, rng = bpe.Vocabulary(PATH), random.Random(8)
    signs = "aZ09é×÷ßÿÀ'\"-.,<| \t\n\x0b\x0c\r"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(500)]
    for text in [*texts, "don't I'LL 'S x's'", "É É", "a\x1cb a\x85b a\xa0b", "plain <|endoftext|> plain", ""]:
        assert voc.encode(text) == packed(ids(library, text)), repr(text)
    voc, words = bpe.Vocabulary(PATH), []
    make = voc.words.make
    voc.words.make = lambda w: words.append(w) or make(w)
    voc.encode("bridge, (Bridge) 'bridge' bridge. bridge;\tBRIDGE!")
    assert words.count("bridge") == 1 and not voc.chunks
