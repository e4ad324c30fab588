"""Encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegate.llm import trie_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "the", "ing", "<|endoftext|>", "<|endof", " ", "  ", "\t", "\n", "\r\n", " ", "é", "文字", "x" * 40,
         "-" * 9, "'s", "'ll", "12", "\U0001F600", "İ", "\x1c", "\x85", "　", "!", "ſ", "ﬁ", "\x00", "Ġ", "\U0001e6c0"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return trie_bpe.Encoder(PATH)


def test_random_texts(library, encoder):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(97, 123), rng.randrange(32, 1000), rng.randrange(0x300, 0xd000)]))
                      for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode_each(texts), strict=True):
        theirs = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == theirs == encoder.encode(text).tolist(), text
        assert encoder.decode(ids) == library.decode(theirs, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["x" * 60_000, "ab" * 20_000, " " * 20_000, "a b" * 700_000, "日本語" * 5000, "a\r\n b" * 9000])
def test_long_texts(library, encoder, text):
    assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_tables_that_start_afresh(monkeypatch, library):
    monkeypatch.setattr(trie_bpe, "TRIE_NODES", 50)
    monkeypatch.setattr(trie_bpe, "KNOWN_PAIRS", 5)
    monkeypatch.setattr("tidegate.llm.units.KNOWN_UNITS", 20)
    encoder, rng = trie_bpe.Encoder(PATH), random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice(PARTS) for _ in range(20))
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_no_token_stands_that_merges_would_not_make(encoder):
    """The words of a vocabulary encode to themselves."""
    words = sorted(encoder.vocabulary.whole)[::37]
    assert all(ids == [encoder.vocabulary.whole[w]] for w, ids in encoder._trie.encode(words).items())


def test_round_trip(spark, library):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60))), "e", 1, "z", b"f") for i in range(60)]
    rows += [(60, None, None, None, None, None), (61, "", "e", 2, "y", None), (None, "no id", "e", 3, "", b""),
             rows[0], rows[0], (62, "long " * 400_000, "e", 4, "", b"")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, __row string, key binary")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in
           trie_bpe.round_trip(df.repartition(3), PATH).collect()}

    def expected(row):
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        return (row[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest())

    assert got == {expected(r) for r in rows}
    assert trie_bpe.round_trip(df, PATH).count() == len(rows)
    ids = {r.doc_id: r.ids for r in trie_bpe.encode_documents(df, PATH).collect()}
    assert ids[62] == library.encode(rows[-1][1], add_special_tokens=False).ids
    assert trie_bpe.round_trip(df.where("false"), PATH).collect() == []
