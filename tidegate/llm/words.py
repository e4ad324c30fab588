"""The words of many texts as numpy arrays: places and 64-bit hashes, without a Python object a word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; one longer text is worked on alone.
SLICE_BYTES = 2_000_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, ascending; by a sort, as numpy's own hash table takes 40 times as long for hashes."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def _byte_table(fold: bool) -> np.ndarray:
    table = mix((np.arange(256, dtype=np.uint64) + np.uint64(77)) * _STEP)
    if fold:
        table[65:91] = table[97:123]
    table[_SPACE] = 0
    return table


_TABLES = {fold: _byte_table(fold) for fold in (False, True)}


def _powers(n: int, base: np.uint64, known: dict = {}) -> np.ndarray:
    key = int(base)
    if key not in known or len(known[key]) < n:
        full = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        full[0] = 1
        known[key] = np.multiply.accumulate(full)
    return known[key][:n]


@dataclass
class Words:
    """Words of consecutive texts. ``first[d]:first[d+1]`` are the words of text d."""

    data: np.ndarray          # the bytes of all texts
    starts: np.ndarray        # byte places of the words
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def _split(data: np.ndarray, bounds: np.ndarray, fold: bool) -> Words:
    word = ~_SPACE[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    opens[edges] = word[edges]
    edges = bounds[1:][bounds[1:] > 0] - 1
    closes[edges] = word[edges]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds), _hashes(data, starts, ends, fold))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """Hashes of pieces that have nothing but space between them."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = np.take(_TABLES[fold], data)
    values *= _powers(len(data), _STEP)
    sums = np.add.reduceat(values, starts)
    sums *= _powers(len(data), _INVERSE)[starts]
    return mix(sums + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: ASCII letters 1, ASCII marks but the apostrophe 2, all else 0.
_KINDS = np.array([1 if chr(b).isalpha() and b < 128 else 2 if 32 < b < 127 and not chr(b).isalnum() and b != 39 else 0
                   for b in range(256)], np.uint8)


def cut_at_marks(words: Words, fold: bool = False) -> Words:
    """The pieces of the words, cut between ASCII letters and marks other than the apostrophe."""
    kinds = _KINDS[words.data]
    cuts = np.flatnonzero(kinds[1:] + kinds[:-1] == 3) + 1
    starts, ends = (np.zeros(len(words.data) + 1, bool) for _ in range(2))
    starts[words.starts], starts[cuts] = True, True
    ends[words.ends], ends[cuts] = True, True
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    first = np.searchsorted(starts, np.append(words.starts, len(words.data))[words.first])
    return Words(words.data, starts, ends, first, _hashes(words.data, starts, ends, fold))


def words_of(texts: pa.Array, fold: bool = False, size: int | None = None) -> Iterator[tuple[int, Words]]:
    """(first row, words) of slices of a string array; NULL has no words; ``fold`` lower-cases A-Z; ``size``: bytes of a slice."""
    size = size or SLICE_BYTES
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, _split(data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row], fold)
        row = end


def runs(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hashes of every ``length`` consecutive values; the caller drops runs that leave a text."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(seed * 2 + 1), dtype=np.uint64)
    factor = 1
    for k in range(length):
        factor = factor * 0xDA942042E4DD58B5 % 2**64
        out += hashes[k:k + n] * np.uint64(factor)
    return mix(out)


def shingles(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``length`` words inside a text; a shorter text gives its whole sequence."""
    counts = words.counts()
    hashed = runs(words.hashes, length)
    inside = np.zeros(max(len(words.hashes), 1), dtype=bool)
    docs = words.doc_of()
    if len(hashed):
        inside[:len(hashed)] = docs[:len(hashed)] == docs[length - 1:]
    places = np.flatnonzero(inside[:len(hashed)])
    doc, value = docs[places], hashed[places]
    for d in np.flatnonzero((counts > 0) & (counts < length)):
        part = words.hashes[words.first[d]:words.first[d + 1]]
        doc = np.append(doc, d)
        value = np.append(value, runs(part, len(part), seed=len(part)))
    return doc, value


def u64(values) -> pa.Array:
    """uint64 values as the bit-equal Spark long."""
    return pa.array(np.ascontiguousarray(values, dtype=np.uint64).view(np.int64))
