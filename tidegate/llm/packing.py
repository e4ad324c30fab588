"""Best-fit packing of tokenised documents, in bulk-synchronous rounds.

Pieces are placed by falling size bands. In every round the unplaced pieces of the band and the
gaps of all open sequences are sorted together by size in range partitions, gaps before
pieces of the same size, largest first. Going down this order each piece wants the
smallest gap that still holds it, its successor. Which piece gets which gap follows from
ranks alone: a gap opens a bracket, a piece closes one, and the running depth, a prefix
sum over the partitions, pairs each piece with the latest gap still open (of several
pieces after one gap, the first in rank gets it, the next gets the gap before). Matched gaps
shrink, pieces left without a gap open new sequences, larger ones first, and the next
round follows until the band is placed.

A round moves narrow rows only (number, size), and a window over a depth is short, since it
holds at most one gap and one piece of each size. Token ids are made once, in Arrow batches, with a
bounded cache of words (of their letters and marks, where the tokenizer parts these, a thousand new ones
encoded as one text), and are reduced to checksums there.

Defined results: a NULL or empty text is the end token alone; repeated rows are packed
separately; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace
from .words import cut_at_marks, words_of

CAPACITY, END_ID = 2048, 0
#: Distinct words a task remembers the ids of before it starts afresh.
CACHE_WORDS = 400_000
#: Words encoded in one call, and the least of them that are joined to one text.
CALL_WORDS, JOINED_WORDS = 1000, 64
#: A splitting at white space that also parts letters from marks, whatever stands beside them.
PARTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words that such a splitting leaves whole: letters that normal form C and lower case keep letters, or marks.
_WHOLE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[!-&(-/:-@[-`{-~]+").fullmatch

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordIds:
    """Token ids of words; a bounded table from word hash to a slice of ids."""

    def __init__(self, path: str):
        # Spark's tasks fill the cores; threads of the library would only take time from each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = PARTING in str(self.tokenizer.pre_tokenizer)
        self.folds = "Lowercase()" in str(self.tokenizer.normalizer)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = None
        if self.parts and suffix:
            # The ids that end what the splitting leaves whole.
            self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.keys, self.spans = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _apart(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        """(number of ids of each word, ids); an object is made for every word."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return list(map(len, found)), np.array(list(chain.from_iterable(found)), np.uint32)

    def _joined(self, texts: list[str]) -> tuple[list[int], np.ndarray]:
        """The same for words that are left whole, encoded as one text and told apart by the ids that end them."""
        if len(texts) < JOINED_WORDS:
            return self._apart(texts)
        found = self.tokenizer.encode_batch_fast(["\n".join(texts)], add_special_tokens=False)[0].ids
        ids = np.array(found, np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(texts) or ends[-1] != len(ids):
            return self._apart(texts)
        return np.diff(ends, prepend=0).tolist(), ids

    def learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """``hashes`` ascend."""
        whole, rest = [], []
        for k, text in enumerate(texts):
            (whole if self.last is not None and _WHOLE(text) else rest).append(k)
        sizes, parts = [], [self.ids]
        for chosen, encode in ((whole, self._joined), (rest, self._apart)):
            for k in range(0, len(chosen), CALL_WORDS):
                counts, ids = encode([texts[i] for i in chosen[k:k + CALL_WORDS]])
                sizes += counts
                parts.append(ids)
        ends = np.cumsum(sizes, dtype=np.int64) + len(self.ids)
        spans = np.empty((len(texts), 2), np.int64)
        spans[whole + rest] = np.stack([ends - sizes, ends], axis=1)
        self.ids = np.concatenate(parts)
        at = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, at, hashes)
        self.spans = np.insert(self.spans, at, spans, axis=0)

    def _new(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each of the hashes is not known."""
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return self.keys[at] != hashes if len(self.keys) else np.ones(len(hashes), bool)

    def spans_of(self, words) -> np.ndarray:
        """(from, to) in ``ids`` for every word."""
        distinct, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        new = self._new(distinct)
        if len(self.keys) + int(new.sum()) > CACHE_WORDS:
            self.clear()
            new = self._new(distinct)
        if new.any():
            data = words.data.tobytes()
            places = first[new]
            self.learn(distinct[new], [data[a:b].decode("utf-8", "replace") for a, b in
                                       zip(words.starts[places].tolist(), words.ends[places].tolist())])
        return self.spans[np.searchsorted(self.keys, distinct)][back]


def _tokenise(tokenizer_path: str, capacity: int):
    def run(batches):
        known = WordIds(tokenizer_path)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, words in words_of(batch.column(1), fold=known.folds):
                if known.parts:
                    words = cut_at_marks(words, fold=known.folds)
                out = [[] for _ in range(5)]
                spans = known.spans_of(words) if len(words.hashes) else np.zeros((0, 2), np.int64)
                sizes = spans[:, 1] - spans[:, 0]
                ends = np.cumsum(sizes)
                flat = known.ids[np.repeat(spans[:, 0] - ends + sizes, sizes) + np.arange(int(sizes.sum()))]
                bounds = np.concatenate([[0], ends])[words.first].tolist()
                for d, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    tokens = np.append(flat[a:b], np.uint32(END_ID)).astype("<u4")
                    for piece, start in enumerate(range(0, len(tokens), capacity)):
                        part = tokens[start:start + capacity]
                        for column, value in zip(out, (ids[row + d], piece, start, len(part),
                                                       zlib.crc32(part.tobytes()))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *[pa.array(c, pa.int64()) for c in out[2:]]],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return narrow.mapInArrow(_tokenise(tokenizer_path, capacity), _PIECES)


def _round(ws: Workspace, pieces: DataFrame, bins: DataFrame, high: int) -> DataFrame:
    """The sorted gaps and pieces with what each gap got: ``put``/``put_length`` on gap rows,
    ``rank`` (among those without a gap, largest first) on pieces that got none.

    A gap that holds several pieces of the band whatever their sizes offers as many slots.
    """
    several = F.greatest(F.lit(1), F.expr(f"gap div {high}"))
    slots = bins.select("bin", "gap", F.explode(F.sequence(F.lit(1).cast("long"), several)).alias("slot"))
    slots = slots.select(F.when(F.col("gap") >= 2 * high, F.lit(high)).otherwise(F.col("gap")).alias("length"),
                         F.lit(1).alias("way"), F.col("bin").alias("name"), "slot", "gap")
    none = F.lit(None).cast("long")
    both = slots.unionByName(pieces.select(
        "length", F.lit(-1).alias("way"), F.col("key").alias("name"), none.alias("slot"), none.alias("gap")))
    # Larger first; of one size, gaps first.
    order = [F.desc("length"), F.desc("way"), F.asc("name"), F.asc("slot")]
    dealt = both.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = ws.keep(dealt.withColumn("at", F.monotonically_increasing_id())
                    .withColumn("part", F.spark_partition_id()), "sorted")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("part").agg(F.sum("way").alias("total")).select(
        "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("run", F.sum("way").over(inside)).join(parts, "part")
    depth = F.col("base") + F.col("run")
    # Gaps and pieces alternate on a level; only the pieces that lower the depth to a new
    # minimum, 0, -1, -2, .., have no gap before them.
    placed = placed.withColumn("level", F.when(F.col("way") > 0, depth).otherwise(depth + 1))
    level = Window.partitionBy("level").orderBy("at")
    matched = ws.keep(
        placed.withColumn("after", F.lead(F.struct("way", "name", "length")).over(level))
        .withColumn("before", F.lag("way").over(level))
        .select("way", "name", "length", "slot", "gap",
                F.when((F.col("way") > 0) & (F.col("after.way") < 0), F.col("after.name")).alias("put"),
                F.when((F.col("way") > 0) & (F.col("after.way") < 0), F.col("after.length")).alias("put_length"),
                F.when((F.col("way") < 0) & F.coalesce(F.col("before") < 0, F.lit(True)), -F.col("level"))
                .alias("rank")), "matched", like=dealt)
    ws.drop(dealt)
    return matched


def pack(ws: Workspace, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """key, sequence_id, offset for pieces (key, length)."""
    def opened(first: DataFrame) -> tuple[DataFrame, DataFrame]:
        return (first.select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset")),
                first.select(F.col("key").alias("bin"), (capacity - F.col("length")).alias("gap")).where("gap > 0"))

    bounds = [capacity >> k for k in range(1, max(2, capacity.bit_length() - 4))] + [0]
    sizes = {r["band"]: r for r in pieces.groupBy(
        F.expr("case " + " ".join(f"when length > {b} then {k}" for k, b in enumerate(bounds)) + " end").alias("band"))
        .agg(F.count(F.lit(1)).alias("n")).collect()}
    places, bins = opened(pieces.where(F.col("length") > bounds[0]))
    placed = [places]
    for k in range(1, len(bounds)):
        high, low = bounds[k - 1], bounds[k]
        if k not in sizes:
            continue
        left = sizes[k]["n"]
        rest = pieces.where((F.col("length") <= high) & (F.col("length") > low))
        idle, bins = bins.where(F.col("gap") <= low), bins.where(F.col("gap") > low)
        while left:
            matched = _round(ws, rest, bins, high)
            lost = matched.where("rank is not null").select(F.col("name").alias("key"), "length", "rank")
            # Pieces without a gap: the largest open new sequences, so many as their words fill.
            sums = lost.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("words")).first()
            left = sums["n"]
            own = Window.partitionBy("name").orderBy("slot")
            upto = F.sum(F.coalesce("put_length", F.lit(0))).over(own.rowsBetween(Window.unboundedPreceding, 0))
            placed.append(matched.where("put is not null").select(
                F.col("put").alias("key"), F.col("name").alias("sequence_id"),
                (capacity - F.col("gap") + upto - F.col("put_length")).alias("offset")))
            bins = matched.where("way > 0").groupBy(F.col("name").alias("bin")).agg(
                (F.first("gap") - F.sum(F.coalesce("put_length", F.lit(0)))).alias("gap")).where("gap > 0")
            if left:
                new = -(-sums["words"] // capacity)
                places, fresh = opened(lost.where(F.col("rank") < new))
                placed.append(places)
                bins, left = bins.unionByName(fresh), left - min(new, left)
                rest = lost.where(F.col("rank") >= new).select("key", "length")
        bins = bins.unionByName(idle)
        bins = ws.keep(bins, "bins", like=bins)
    out = placed[0]
    for part in placed[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, **columns) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    ws = Workspace(docs.sparkSession, "packing")
    pieces = ws.keep(pieces_of(docs, tokenizer_path, capacity, **columns)
                     .withColumn("key", F.monotonically_increasing_id()), "pieces")
    places = pack(ws, pieces.select("key", "length"), capacity)
    return pieces.join(places, "key").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
