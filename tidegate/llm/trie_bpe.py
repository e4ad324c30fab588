"""Byte-level BPE by traversal of a trie of the distinct words.

The encoding of a word is settled by the last token of each of its prefixes: a token that
ends a prefix belongs to its encoding when it can stand after the last token of the prefix
before it, that is when merging the two tokens' bytes gives the two tokens again. So the
distinct words (as the tokenizer's own splitter cuts them) are inserted into a trie; each node
stands for a prefix and holds its last token, found from the nodes above it. Words
are inserted in sorted order, which visits the trie depth first; a prefix that several words
share is worked out once. The encoding of a word is read off backwards along its path.

Spark deals out the texts; each task keeps one trie, of bounded size, over the words it meets.
Texts are looked up by units (white space and the word behind it), and no step holds more than
one text.

Defined results: a NULL or empty text has no tokens; special tokens written in a text are
encoded as the library does, each as one id; repeated rows repeat; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .units import SLICE_BYTES, Grown, Numbers, cut, plainly_spaced

#: Nodes of a trie and pairs of tokens a task remembers before it starts afresh.
TRIE_NODES, KNOWN_PAIRS = 800_000, 500_000
#: Longer words share nothing and get a path of their own.
SHARED_WORD = 256
#: Tokens after which a task sends on what it has.
BATCH_TOKENS = 2_000_000

#: The words of byte-level vocabularies, for ASCII.
_ASCII_WORD = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t-\rA-Za-z0-9]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones write
    themselves, the others follow from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, the two tokens each was merged from, and the order of the merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout") \
                or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.names = [""] * size
        for token, number in self.ids.items():
            self.names[number] = token
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made = self.ids[a + b]
            if self.born[made] >= 0:
                raise ValueError(f"two merges make the token {a + b!r}")
            self.born[made], self.left[made], self.right[made] = rank, self.ids[a], self.ids[b]
            self.merge[self.ids[a], self.ids[b]] = rank
        #: Tokens the merges reach; those that whole words of their own text would not become, are none.
        self.whole = {t: n for t, n in self.ids.items()
                      if len(t) == 1 or (self.born[n] >= 0 and self._stands(
                          self.left[n], self.right[n], 2 * self.born[n]))}
        #: What tokens end with, to the token it is itself, or -1.
        self.tails = {t[k:]: -1 for t in self.whole for k in range(1, len(t))} | self.whole
        alphabet = byte_alphabet()
        self.bytes = [bytes(alphabet[c] for c in t) for t in self.names]
        for content, number in self.special.items():
            self.bytes[number] = content.encode()
        self.pairs: dict[int, bool] = {}

    def _stands(self, a: int, b: int, end: int) -> bool:
        """Whether no merge across the border of a and b comes before ``end`` and before the
        merges that take up its two sides.

        Time runs in half steps: of one rank, the merge further left comes first.
        """
        while True:
            rank = self.merge.get((a, b))
            if rank is not None and 2 * rank < end:
                return False
            made_a, made_b = 2 * self.born[a], 2 * self.born[b] + 1
            if self.born[a] < 0 and self.born[b] < 0:
                return True
            if made_a > made_b:                 # what was merged last is taken apart first
                end, a = made_a, self.right[a]
            else:
                end, b = made_b, self.left[b]

    def follows(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of a and b together gives a and b."""
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > KNOWN_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self._stands(a, b, 2 * len(self.merge))
        return found


class Trie:
    """Nodes are prefixes of words; ``last`` is the last token of a prefix's encoding."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.child: dict[int, int] = {}
        self.last = [-1]

    def _last_token(self, word: str, end: int, path, last: list[int]) -> int:
        """The last token of ``word[:end]``; ``last[path[k]]`` is that of ``word[:k]``."""
        tails, follows = self.vocabulary.tails, self.vocabulary.follows
        start, found = end - 1, []
        while start >= 0 and (token := tails.get(word[start:end])) is not None:
            if token >= 0:
                found.append((start, token))
            start -= 1
        for start, token in reversed(found):
            if start == 0 or follows(last[path[start]], token):
                return token
        raise ValueError(f"no token ends {word[:end]!r}")

    def encode(self, words: list[str]) -> dict[str, list[int]]:
        """The tokens of sorted words, each inserted below what it shares with the one before."""
        out, path, before = {}, [0], ""
        for word in words:
            if len(word) > SHARED_WORD:
                out[word] = self._tokens(word, *self._alone(word))
                continue
            same = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                same += 1
            del path[same + 1:]
            self._insert(word, path)
            out[word] = self._tokens(word, path, self.last)
            before = word
        return out

    def _tokens(self, word: str, path, last: list[int]) -> list[int]:
        tokens, at, names = [], len(word), self.vocabulary.names
        while at:
            token = last[path[at]]
            tokens.append(token)
            at -= len(names[token])
        return tokens[::-1]

    def _insert(self, word: str, path: list[int]) -> None:
        """Go on along ``word`` from the node at the end of ``path``."""
        child, last, node = self.child, self.last, path[-1]
        for end in range(len(path), len(word) + 1):
            key = node << 9 | ord(word[end - 1])            # the alphabet's characters lie below 512
            node = child.get(key)
            if node is None:
                token = self._last_token(word, end, path, last)
                node = child[key] = len(last)
                last.append(token)
            path.append(node)

    def _alone(self, word: str):
        path, last = range(len(word) + 1), [-1]
        for end in range(1, len(word) + 1):
            last.append(self._last_token(word, end, path, last))
        return path, last


class Encoder:
    """Texts to ids, with a trie and a table of units of bounded size."""

    def __init__(self, path: str, vocabulary: Vocabulary | None = None):
        from tokenizers import Tokenizer

        self.vocabulary = vocabulary or Vocabulary(path)
        self._split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._write = str.maketrans({chr(b): c for c, b in byte_alphabet().items() if b < 128})
        self._special = sorted(self.vocabulary.special)
        self._numbers = Numbers(self._learn, self._forget)
        self._trie = Trie(self.vocabulary)
        self._forget()

    def _forget(self) -> None:
        self._ids, self._ends = Grown(np.uint32), Grown(np.int64)
        self._ends.add([0])

    def _words(self, unit: bytes) -> list[str]:
        """The words of a unit in the vocabulary's alphabet; the library splits what isn't ASCII."""
        if unit.isascii():
            return [w.translate(self._write) for w in _ASCII_WORD.findall(unit.decode())]
        return [w for w, _ in self._split(unit.decode())]

    def _learn(self, units: list[bytes]) -> None:
        if len(self._trie.last) > TRIE_NODES:
            self._trie = Trie(self.vocabulary)
        cuts = [self._words(u) for u in units]
        words = self._trie.encode(sorted({w for c in cuts for w in c}))
        ids = [[i for w in c for i in words[w]] for c in cuts]
        self._ends.add(np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) + self._ids.size)
        self._ids.add([i for c in ids for i in c])

    def _units(self, text: str) -> Iterator[list[bytes]]:
        data = text.encode()
        if plainly_spaced(data):
            yield from cut(data)
        else:                   # the library's splitter cuts the whole text; its words are units
            yield [text[a:b].encode() for _, (a, b) in self._split(text)]

    def _pieces(self, text: str) -> Iterator[str]:
        """Special tokens and what lies between them."""
        while text:
            place, token = min(((p, t) for t in self._special if (p := text.find(t)) >= 0),
                               default=(len(text), ""), key=lambda found: (found[0], -len(found[1])))
            yield from (p for p in (text[:place], token) if p)
            text = text[place + len(token):]

    def _ids_of(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units, and the place in them where each unit ends."""
        numbers = self._numbers.of(units)
        starts = self._ends.all()[numbers]
        sizes = self._ends.all()[numbers + 1] - starts
        ends = np.cumsum(sizes)
        return self._ids.all()[np.repeat(starts - ends + sizes, sizes) + np.arange(int(sizes.sum()))], ends

    def encode(self, text: str) -> np.ndarray:
        """The ids of one text of any length."""
        self._numbers.make_room()
        parts = [np.zeros(0, np.uint32)]
        for piece in self._pieces(text):
            if piece in self.vocabulary.special:
                parts.append(np.array([self.vocabulary.special[piece]], np.uint32))
            else:
                parts += [self._ids_of(units)[0] for units in self._units(piece)]
        return np.concatenate(parts)

    def encode_each(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text; the new words of many short texts go into the trie together."""
        waiting: list[int] = []
        units: list[bytes] = []
        size = 0

        def done():
            if waiting:
                self._numbers.make_room()
                ids, ends = self._ids_of(units)
                yield from np.split(ids, np.append(0, ends)[waiting[:-1]])

        for text in texts:
            if len(text) > SLICE_BYTES // 4 or any(t in text for t in self._special):
                yield from done()
                waiting, units, size = [], [], 0
                yield self.encode(text)
                continue
            for part in self._units(text):
                units += part
            waiting.append(len(units))
            size += len(text)
            if size > SLICE_BYTES:
                yield from done()
                waiting, units, size = [], [], 0
        yield from done()

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _encoded(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, schema: str, made) -> DataFrame:
    """``made(encoder, ids)``, the columns behind doc_id, for every document."""
    names = [c.split()[0] for c in schema.split(", ")]
    # Tables of the vocabulary alone, so of bounded size; made once instead of in every task.
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    kinds = [pa.from_numpy_dtype(np.int64) if "long" in c else pa.list_(pa.int32()) if "array" in c
             else pa.string() for c in schema.split(", ")]

    def run(batches):
        encoder = Encoder(vocabulary, shared.value)
        for batch in batches:
            texts = (text.as_py() or "" for text in batch.column(1))
            at, rows, size = 0, [], 0
            for ids in encoder.encode_each(texts):
                rows.append(made(encoder, ids))
                size += len(ids)
                if size > BATCH_TOKENS or at + len(rows) == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, len(rows))]
                        + [pa.array(c, k) for c, k in zip(zip(*rows), kinds[1:])], names)
                    at, rows, size = at + len(rows), [], 0

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return narrow.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int)."""
    return _encoded(docs, vocabulary, id_col, text_col, "doc_id long, ids array<int>",
                    lambda encoder, ids: (ids.astype(np.int32),))


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text is encoded, and its ids are decoded."""
    def made(encoder, ids):
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(encoder.decode(ids).encode()).hexdigest())

    return _encoded(docs, vocabulary, id_col, text_col,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", made)
