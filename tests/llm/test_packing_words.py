"""The ids of words, encoded in pieces and a few at a time."""

import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tidegate.llm import packing
from tidegate.llm.queries import TOKENIZER


def _texts():
    rng = random.Random(8)
    parts = ["word", "Word", "WORD", "don't", "'s", "'", ".", "...", "…", "é", "́", "été", "7", "42", "-", "_", "\"", "ß", "I'll",
             "你", "\x01", " ", "(", ")", "ΣΣ", "İ", "a", "Z", "<s>", "@"]
    return ["".join(rng.choice([*parts, " ", "\n", "\t"]) for _ in range(rng.randint(0, 60))) for _ in range(1500)]


def test_pieces_have_the_ids_of_whole_texts():
    texts, whole = _texts(), Tokenizer.from_file(TOKENIZER)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    found = [r for b in packing._tokenise(TOKENIZER, 2048)([batch]) for r in b.to_pylist()]
    for text, row in zip(texts, found):
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, packing.END_ID], "<u4")
        assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes())), text


def test_letters_are_learnt_once_and_few_at_a_time(monkeypatch):
    known = packing.WordIds(TOKENIZER)
    calls = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.append(list(texts))
            return whole.encode_batch_fast(texts, **options)

    whole, known.tokenizer = known.tokenizer, Counting()
    monkeypatch.setattr(packing, "WordIds", lambda path: known)
    monkeypatch.setattr(packing, "CALL_WORDS", 4)
    texts = ["Word, word. WORD! (word) other-word", " ".join(f"w{chr(97 + k)}x," for k in range(20))]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts)], ["doc_id", "text"])
    list(packing._tokenise(TOKENIZER, 2048)([batch]))
    assert max(map(len, calls)) == 4
    met = [t.lower() for c in calls for t in c]
    assert len(met) == len(set(met)) and {"word", "other", ",", "."} < set(met)


def test_letters_and_marks_are_encoded_as_few_texts():
    rng, whole = random.Random(5), Tokenizer.from_file(TOKENIZER)
    words = list({"".join(rng.choice("abcdeéßÿöÄÑXYZ") for _ in range(rng.randint(1, 9))) for _ in range(3000)})
    words += list({"".join(rng.choice("!#$%&()<|>*~`_-") for _ in range(rng.randint(1, 5))) for _ in range(500)})
    words += ["don't", "éte", "1234", "क़a", "İb", " ", "a b", "日本", "x́"]
    known, calls = packing.WordIds(TOKENIZER), []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.extend(texts)
            return whole.encode_batch_fast(texts, **options)

    known.tokenizer = Counting()
    known.learn(np.arange(len(words), dtype=np.uint64), words)
    assert len(calls) < 20
    for word, (a, b) in zip(words, known.spans):
        assert known.ids[a:b].tolist() == whole.encode(word, add_special_tokens=False).ids, word


def test_known_words_do_not_count_twice(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 30)
    known, learnt = packing.WordIds(TOKENIZER), []
    learn = known.learn
    known.learn = lambda hashes, texts: (learnt.extend(texts), learn(hashes, texts))
    text = pa.array([" ".join(f"{a}{b}" for a in "abcd" for b in "efghi")])
    for _ in range(3):
        for _, words in packing.words_of(text):
            known.spans_of(words)
    assert len(learnt) == 20
