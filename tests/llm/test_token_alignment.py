"""Links, groups and corpus counts against whole-text encodings compared token by token."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidegate.llm import token_alignment as alignment
from tidegate.llm.perfect_hash import PerfectHash
from tidegate.llm.trie_bpe import byte_alphabet

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["hello", "world", "the", "ing", "<|endoftext|>", "</s>", " ", " ", " ", "  ", "\t", "\n", "\r\n", "{\r\n", " ", "é",
         "文字", "x" * 20, "-" * 9, "'s", "12", "\U0001F600", "\x85", "　", "!", "ﬁ", "\x00", "<0x41>", "é"]


@pytest.fixture(scope="module")
def encode():
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    names, alphabet = {i: t for t, i in a.get_vocab().items()}, byte_alphabet()

    def run(text):
        a_ids = a.encode(" " + text, add_special_tokens=False).ids
        b_ids = b.encode(text)
        a_bytes = [bytes(alphabet[c] for c in names[i]) for i in a_ids]
        b_bytes = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return None
        return a_ids, a_bytes, b_ids, b_bytes
    return run


def spans(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def brute_force(rows, encode):
    made, counts = [], Counter()
    for doc_id, text in rows:
        encoded = encode(text or "")
        if encoded is None:
            made.append((doc_id, None))
            continue
        a_ids, a_bytes, b_ids, b_bytes = encoded
        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        links, low = [], 0
        for i, (x, y) in enumerate(a_spans):
            while b_spans[low][1] <= x:
                low += 1
            j = low
            while j < len(b_spans) and b_spans[j][0] < y:
                links.append((a_ids[i], b_ids[j]))
                j += 1
        both = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        spelled, start = [], 0
        for end in both:
            spelled.append("|".join(",".join(str(i) for i, (x, y) in zip(ids, where) if start <= x < end)
                                    for ids, where in ((a_ids, a_spans), (b_ids, b_spans))))
            start = end
        made.append((doc_id, (len(a_ids), len(b_ids), len(both), links, ";".join(spelled))))
        counts.update(links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = Counter()
    for doc_id, row in made:
        if row is None:
            out[doc_id, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        n_a, n_b, groups, links, spelled = row
        out[doc_id, n_a, n_b, groups, len(links), sum(counts[p] == best[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(spelled.encode()).hexdigest()] += 1
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " "), (203, "\n"), (204, "with ▁ in it"), (205, "\ta  b "), (None, "no id"),
             (206, "long text " * 700), (207, "y" * 4000), rows[3], rows[3]]
    return rows


def found(df):
    return Counter(tuple(r) for r in alignment.align_documents(df, A_PATH, B_PATH).collect())


def test_against_whole_texts(spark, rows, encode, tmp_path, monkeypatch):
    wide = [(i, t, 1, "x", b"y", 2, "z") for i, t in rows]
    df = spark.createDataFrame(wide, "doc_id long, text string, split int, __row string, keys binary, grp int, n_a string")
    want = brute_force(rows, encode)
    assert found(df.repartition(3)) == want
    df.repartition(4).write.parquet(str(tmp_path / "t"))
    # Many splits, a tree of several levels, and tables of units that start afresh.
    monkeypatch.setattr(alignment, "SPLIT_BYTES", 9000)
    monkeypatch.setattr(alignment, "FAN", 2)
    monkeypatch.setattr("tidegate.llm.units.KNOWN_UNITS", 50)
    assert found(spark.read.parquet(str(tmp_path / "t"))) == want


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == Counter()


def test_perfect_hash_has_no_gaps_and_comes_back_from_bytes():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 7, 5000):
        keys = np.unique(rng.integers(-2**62, 2**62, n))
        made = PerfectHash.from_bytes(*PerfectHash.build(keys).to_bytes())
        assert sorted(made.of(keys).tolist()) == list(range(len(keys)))
        others = np.setdiff1d(rng.integers(-2**62, 2**62, 100), keys)
        assert ((made.of(others) >= -1) & (made.of(others) < max(len(keys), 1))).all()
