"""Sharding by a keyed permutation of the row numbers.

Rows are numbered 0..n-1 in the order of (doc_id, size, text_crc32). A Feistel network permutes the
smallest even number of bits that holds n; a value that falls outside 0..n-1 is permuted
again until it falls inside (cycle walking), which makes the whole a permutation of
0..n-1. The shard is the permuted number modulo the number of shards and the slot its
quotient, so shard sizes differ by one row at most, and both directions can be computed
for any single row without a table.

Defined results: NULL ids come first; NULL texts count as empty (size 1, checksum 0);
rows that repeat get numbers of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import GROUP_ROWS, SEQ, number_rows
from .common import Workspace

SHARDS, SEED, ROUNDS = 16, 20_260_701, 8


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _mix(values: np.ndarray, key: int) -> np.ndarray:
    values = (values + np.uint64(key & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def _network(values: np.ndarray, bits: int, seed: int, rounds) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = values >> shift, values & mask
    for number in rounds:
        left, right = right, left ^ (_mix(right, seed * ROUNDS + number) & mask)
    return (left << shift) | right


def _walk(values, n: int, step) -> np.ndarray:
    out = step(np.asarray(values, dtype=np.uint64))
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = step(out[outside])
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def permute(values, n: int, seed: int = SEED) -> np.ndarray:
    """Where rows 0..n-1 go."""
    bits = _half_bits(n)
    return _walk(values, n, lambda v: _network(v, bits, seed, range(ROUNDS)))


def invert(values, n: int, seed: int = SEED) -> np.ndarray:
    """The row that ``permute`` sends to each place."""
    bits = _half_bits(n)
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)

    def back(v):
        left, right = v >> shift, v & mask
        for number in reversed(range(ROUNDS)):
            left, right = right ^ (_mix(left, seed * ROUNDS + number) & mask), left
        return (left << shift) | right

    return _walk(values, n, back)


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number."""
    ws = Workspace(docs.sparkSession, "sharding")
    text = F.coalesce(docs[text_col], F.lit(""))
    narrow = ws.keep(docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32")), "narrow")
    numbered = number_rows(narrow, [], ["doc_id", "size", "text_crc32"], ws.folder("numbered"))

    @F.pandas_udf("long")
    def place(row: pd.Series, rows: pd.Series) -> pd.Series:
        return pd.Series(permute(row, int(rows.iloc[0]), seed)) if len(row) else row

    placed = numbered.select(
        "doc_id", "size", "text_crc32", F.col(SEQ).alias("row_number"),
        place(F.col(SEQ), F.col(GROUP_ROWS)).alias("_place"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("_place") % shards).cast("int").alias("shard"),
        F.expr(f"_place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
