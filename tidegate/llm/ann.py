"""Approximate nearest neighbours by multi-index hashing.

Codes: centred vectors are rotated by a matrix learned on a bounded sample (iterative
quantisation: alternate signs and the best orthogonal fit to them) and cut to one sign
bit a dimension; several rotations from different starts give longer codes. A code is
split into substrings and every shard of the table keeps an index of each substring. By
the pigeonhole principle a code within Hamming radius r of the query differs in at most
r // m bits of at least one of m substrings, so probing all substring values that near
retrieves every code within r; these are checked by their full distance and reranked by
the inner product of the original vectors in double precision.

The radius is measured, not guessed: sample queries are answered by brute force over all
rows, and r is what holds the wanted share of their neighbours. A query that finds fewer
than k rows within r widens it until it has k or the shard is exhausted.

Every row is indexed; only the rotation and the radius are fitted on samples. Shards and
query blocks have a fixed size, so a task's memory is bounded; all blocks meet all shards.

Defined results: vectors that are NULL, zero, of another length than most, or hold NULL or
non-finite components take no part; NULL ids take no part; repeated rows each count; ties go to
the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace

K = 20
ROTATIONS, SUBSTRING_BITS = 2, 8
#: Rows the rotations are fitted on, queries the radius is measured on, and the share of
#: their neighbours that it must hold.
FIT_ROWS, FIT_QUERIES, FIT_SHARE = 4096, 200, 0.95
SHARD_ROWS, BLOCK_ROWS = 32_768, 1024
SEED = 11

_BLOB = "id int, ids binary, vectors binary"
_FOUND = "query_id long, vec_id long, score double"


def learn_rotations(sample: np.ndarray, rotations: int = ROTATIONS, steps: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """The mean, and a (dim, rotations * dim) matrix whose signs are the code."""
    mean = sample.mean(axis=0)
    centred, dim = sample - mean, sample.shape[1]
    rng = np.random.default_rng(SEED)
    found = []
    for _ in range(rotations):
        turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(steps):
            left, _, right = np.linalg.svd(np.where(centred @ turn > 0, 1.0, -1.0).T @ centred)
            turn = (left @ right).T
        found.append(turn)
    return mean, np.concatenate(found, axis=1)


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Codes as bytes, one substring a byte."""
    return np.packbits((vectors - mean) @ turn > 0, axis=1)


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


class SubstringIndex:
    """For each substring, the rows by its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.rows = [np.argsort(column, kind="stable").astype(np.int32) for column in codes.T]
        self.ends = [np.searchsorted(column[order], np.arange(257)) for column, order in zip(codes.T, self.rows)]
        self.masks = [np.array([sum(1 << b for b in bits) for d in range(r + 1)
                                for bits in combinations(range(SUBSTRING_BITS), d)], dtype=np.uint8)
                      for r in range(SUBSTRING_BITS + 1)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is within the radius, each once."""
        near = self.masks[min(radius // len(self.rows), SUBSTRING_BITS)]
        seen = np.zeros(len(self.codes), dtype=bool)
        for part, order, ends in zip(code, self.rows, self.ends):
            for value in (part ^ near).tolist():
                seen[order[ends[value]:ends[value + 1]]] = True
        rows = np.flatnonzero(seen)
        return rows[distances(self.codes[rows], code) <= radius]


def _nearest(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    order = np.lexsort((ids[rows], -scores))
    return order[:k]


def _blobs(size: int):
    """Groups rows into blocks of a fixed size."""
    def run(batches):
        ids, vectors = [], []

        def block(ids, vectors):
            return pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                 pa.array([np.concatenate(vectors).tobytes()], pa.binary())], ["id", "ids", "vectors"])

        held = 0
        for batch in batches:
            dim = len(batch.column(1)[0]) if batch.num_rows else 0
            rows = np.asarray(batch.column(0), dtype=np.int64)
            values = np.asarray(batch.column(1).flatten(), dtype=np.float64).reshape(-1, max(dim, 1))
            for start in range(0, len(rows), size):
                ids.append(rows[start:start + size])
                vectors.append(values[start:start + size])
                held += len(ids[-1])
                if held >= size:
                    yield block(ids, vectors)
                    ids, vectors, held = [], [], 0
        if held:
            yield block(ids, vectors)
    return run


def _read(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(vectors, np.float64).reshape(len(ids), -1)


def _found_batch(queries, rows, scores) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(queries, np.int64)), pa.array(np.asarray(rows, np.int64)),
         pa.array(np.asarray(scores, np.float64))], ["query_id", "vec_id", "score"])


def _search(mean, turn, radius, k):
    """Rows with a query block and a shard: the k nearest of the shard for each query.

    Without a radius the shard is scanned whole.
    """
    def run(batches):
        held, index = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if held != row["id"]:
                    held = row["id"]
                    ids, vectors = _read(row["ids"], row["vectors"])
                    index = None if radius is None else SubstringIndex(encode(vectors, mean, turn))
                asked, queries = _read(row["q_ids"], row["q_vectors"])
                codes = encode(queries, mean, turn)
                out = [[], [], []]
                for query_id, query, code in zip(asked, queries, codes):
                    wide = radius
                    while True:
                        rows = np.arange(len(ids)) if index is None else index.within(code, wide)
                        rows = rows[ids[rows] != query_id]
                        if index is None or len(rows) >= k or wide >= 8 * codes.shape[1]:
                            break
                        wide += codes.shape[1]
                    scores = (vectors[rows] * query).sum(axis=1)
                    best = _nearest(rows, scores, ids, k)
                    out[0] += [query_id] * len(best)
                    out[1] += ids[rows[best]].tolist()
                    out[2] += scores[best].tolist()
                yield _found_batch(*out)
    return run


def _meet(shards: DataFrame, blocks: DataFrame, n_shards: int, search) -> DataFrame:
    """Every query block at every shard."""
    sent = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("id"),
                         F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    pairs = sent.join(shards.hint("shuffle_hash"), "id").select("id", "ids", "vectors", "q_ids", "q_vectors")
    return pairs.mapInArrow(search, _FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def neighbours(table: DataFrame, is_query, k: int = K, id_col: str = "vec_id",
               vector_col: str = "embedding", ws: Workspace | None = None) -> DataFrame:
    """query_id, rank, vec_id, score for the rows that ``is_query`` (a condition on ``vec_id``) names."""
    spark = table.sparkSession
    ws = ws or Workspace(spark, "ann")
    rows = table.select(table[id_col].cast("long").alias("vec_id"), table[vector_col].cast("array<double>").alias("v"))
    sound = F.expr("""vec_id is not null and v is not null and size(v) > 0 and
        forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x != 0)""")
    rows = rows.where(F.coalesce(sound, F.lit(False)))
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return empty
    rows = rows.where(F.size("v") == common["dim"])
    n_rows = common["count"]
    n_shards = -(-n_rows // SHARD_ROWS)

    # Fitted on the rows with the smallest hashes: the same at every run, however rows are laid out.
    fit = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS)
    sample = np.array([r["v"] for r in fit.collect()])
    mean, turn = learn_rotations(sample)

    dealt = rows.repartition(n_shards) if n_shards > 1 else rows.coalesce(1)
    blobs = dealt.select("vec_id", "v").mapInArrow(_blobs(2 * SHARD_ROWS), _BLOB)
    shards = ws.keep(blobs.withColumn("id", F.spark_partition_id()), "shards")
    queries = rows.where(is_query)
    n_queries = queries.count()
    if not n_queries:
        return empty
    asked = queries.repartition(-(-n_queries // BLOCK_ROWS)).select("vec_id", "v")
    blocks = ws.keep(asked.mapInArrow(_blobs(BLOCK_ROWS), _BLOB), "blocks")
    tried = (queries.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(FIT_QUERIES).coalesce(1)
             .select("vec_id", "v").mapInArrow(_blobs(BLOCK_ROWS), _BLOB))
    true = _merged(_meet(shards, tried, n_shards, _search(mean, turn, None, k)), k)
    gaps = (true.join(rows.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query_id")
            .join(rows, "vec_id").select("q", "v").collect())
    radius = 0
    if gaps:
        ends = [encode(np.array([r[c] for r in gaps]), mean, turn) for c in ("q", "v")]
        radius = int(np.ceil(np.quantile(np.bitwise_count(ends[0] ^ ends[1]).sum(axis=1), FIT_SHARE)))
    found = ws.keep(_meet(shards, blocks, n_shards, _search(mean, turn, radius, k)), "found")
    return _merged(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
