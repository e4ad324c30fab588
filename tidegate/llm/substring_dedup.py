"""Removal of repeated passages by compressed FM-indexes.

A window is WINDOW consecutive words of a document. Windows that repeat anywhere share their
minimizer, the smallest hash of the MARK-word runs inside. The text is cut into segments,
maximal runs of windows with one minimizer at one place, and only segments whose minimizer
occurs more than once go on: no other window can repeat. Equal segments are one segment
with a count. Shards hold segments by minimizer, so every occurrence of a window is in
one shard, of a size that is fixed.

A shard builds an FM-index over its segments: suffixes sorted by prefix doubling to a depth
beyond any segment, the Burrows-Wheeler transform in a wavelet matrix of packed bits
with rank directories, and the lengths of common prefixes for shrinking a match. Its
segments are then streamed backwards through the index, all at once in numpy, which keeps for
each place the longest match that occurs at least twice (matching statistics); places
with a match of WINDOW words or more are reported as intervals. Every word under an
interval is removed; the documents are judged on the input.

A minimizer with more than HOT different segments, as in large groups of near copies, is cut
to single windows instead, which are equal or different as a whole, so that no shard grows.

Defined results: NULL and empty texts have no words; documents shorter than a window lose
nothing; repeated rows remove each other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, Workspace, keyed, pinned
from .words import runs, u64, words_of

WINDOW, MARK = 35, 8
#: Different segments of a minimizer beyond which they are cut to windows; at least 1.
HOT = 2000
#: Words of text in a shard.
SHARD_WORDS = 400_000

_SEGMENTS = f"{ROW} long, at int, n int, mark long, content long"


class PackedBits:
    """Bits in words of 64, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.concatenate([bits, np.zeros(-len(bits) % 64 + 64, np.uint8)]), bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)])

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of any symbol, one packed bit vector a level."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        for bit in reversed(range(max(1, int(symbols - 1).bit_length()))):
            ones = (values >> bit) & 1
            self.levels.append((bit, PackedBits(ones.astype(np.uint8))))
            self.zeros.append(int(len(values) - ones.sum()))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        start = np.zeros_like(low)
        for (bit, bits), zeros in zip(self.levels, self.zeros):
            one = ((symbol >> bit) & 1).astype(bool)
            ends = bits.ones(np.concatenate([start, low, high])).reshape(3, -1)
            start, low, high = (np.where(one, zeros + o, p - o) for o, p in zip(ends, (start, low, high)))
        return low - start, high - start


class FMIndex:
    """Backward search over a text of non-negative symbols, right for patterns up to ``depth``."""

    def __init__(self, text: np.ndarray, depth: int):
        self.symbols = int(text.max()) + 1
        n = len(text)
        rank, step, levels = text.astype(np.int64), 1, []
        while True:
            levels.append((step, rank))
            if step >= depth:
                break
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1]
            step *= 2
        order = np.argsort(rank, kind="stable")
        common = np.zeros(n + 1, np.int32)
        a, b = order[:-1].copy(), order[1:].copy()
        for step, rank in reversed(levels):
            inside = (a < n) & (b < n)
            same = inside & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
            common[1:n][same] += step
            a[same] += step
            b[same] += step
        common[0] = common[n] = -1
        # Smallest common prefix over blocks of 2**k, for widening an interval to a depth.
        self.low = [np.minimum(common, 127).astype(np.int8)]
        while (1 << len(self.low)) <= n:
            last, half = self.low[-1], 1 << (len(self.low) - 1)
            self.low.append(np.minimum(last[:-half], last[half:]))
        self.common, self.n = common, n
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])
        self.bwt = WaveletMatrix(text[order - 1], self.symbols)

    def extend(self, symbol, low, high):
        """Interval of the pattern with a symbol put in front."""
        a, b = self.bwt.rank(symbol, low, high)
        return self.first[symbol] + a, self.first[symbol] + b

    def widen(self, low, high):
        """The parent interval: the next shorter match with more occurrences, and its length."""
        depth = np.maximum(self.common[low], self.common[high])
        depth = np.maximum(depth, 0)
        low, high = low.copy(), high.copy()
        for k in reversed(range(len(self.low))):
            block, size = self.low[k], 1 << k
            back = low - size + 1
            ok = (back >= 0) & (block[np.maximum(back, 0)] >= depth)
            low[ok] -= size
            ok = (high < len(block)) & (block[np.minimum(high, len(block) - 1)] >= depth)
            high[ok] += size
        return depth, low, high


def repeated_starts(segments: list[np.ndarray], window: int) -> list[np.ndarray]:
    """For each segment, the places where a window starts that occurs at least twice in all."""
    sizes = np.array([len(s) for s in segments])
    flat = np.concatenate(segments)
    _, ids = np.unique(flat, return_inverse=True)
    ends = np.cumsum(sizes + 1)
    text = np.zeros(int(ends[-1]), np.int64)                # 0 ends every segment
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    text[inside] = ids + 1
    index = FMIndex(text, int(sizes.max()))
    matched = np.zeros(len(text), np.int32)
    active = np.arange(len(segments))
    place = ends - 2
    low, high, length = np.zeros(len(segments), np.int64), np.full(len(segments), index.n), np.zeros(len(segments), np.int64)
    start = ends - 1 - sizes
    while len(active):
        symbol = text[place[active]]
        a, b = index.extend(symbol, low[active], high[active])
        good = b - a >= 2
        on = active[good]
        low[on], high[on] = a[good], b[good]
        length[on] += 1
        stuck = active[~good & (length[active] == 0)]       # the word itself occurs once
        matched[place[on]] = length[on]
        place[on] -= 1
        place[stuck] -= 1
        shrink = active[~good & (length[active] > 0)]
        if len(shrink):
            length[shrink], low[shrink], high[shrink] = index.widen(low[shrink], high[shrink])
            none = shrink[length[shrink] == 0]
            low[none], high[none] = 0, index.n
        active = active[place[active] >= start[active]]
    return [np.flatnonzero(matched[s:s + n] >= window) for s, n in zip(start, sizes)]


def _minima(marks: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest value in every ``width`` consecutive ones."""
    place, size = np.arange(len(marks)), 1
    while size < width:
        step = min(size, width - size)
        left, right = place[:len(place) - step], place[step:]
        place = np.where(marks[right] < marks[left], right, left)
        size += step
    return place


def _cut(words, window: int, mark: int):
    """text, first word, number of windows, minimizer, content hash of every segment of a slice."""
    n = len(words.hashes)
    if n < window:
        return None
    marks = runs(words.hashes, mark)
    least = _minima(marks, window - mark + 1)
    doc = words.doc_of()
    inside = doc[:n - window + 1] == doc[window - 1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return None
    new = np.ones(len(at), bool)
    new[1:] = (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    starts, count = at[first], np.diff(np.append(first, len(at)))
    # The content: a hash of its first and last window; these overlap, or share their minimizer.
    whole = runs(words.hashes, window, seed=3)
    last = starts + count - 1
    gap = (count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    content = whole[starts] * np.uint64(0xDA942042E4DD58B5) + whole[last] + gap
    return doc[starts], starts - words.first[doc[starts]], count, marks[least[starts]], content


def _segments(window: int, mark: int):
    def run(batches):
        for batch in batches:
            rows = np.asarray(batch.column(0))
            for row, words in words_of(batch.column(1)):
                cut = _cut(words, window, mark)
                if cut is not None:
                    doc, at, n, marks, content = cut
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[row + doc]), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)),
                         u64(marks), u64(content)], [ROW, "at", "n", "mark", "content"])
    return run


def _contents(window: int):
    """The word hashes of wanted segments; those of hot minimizers as single windows."""
    def run(batches):
        for batch in batches:
            asked = batch.column(2).to_pylist()
            rows = batch.column(0).to_pylist()
            for row, words in words_of(batch.column(1)):
                whole = runs(words.hashes, window, seed=3)
                out = [[] for _ in range(5)]
                for d in range(len(words.first) - 1):
                    base = int(words.first[d])
                    for s in asked[row + d]:
                        a = base + s["at"]
                        if s["hot"]:
                            for k in range(s["n"]):
                                key = int(whole[a + k].view(np.int64))
                                for column, value in zip(out, (rows[row + d], s["at"] + k, key, key,
                                                               words.hashes[a + k:a + k + window].tobytes())):
                                    column.append(value)
                        else:
                            for column, value in zip(out, (None, None, s["mark"], s["content"],
                                                           words.hashes[a:a + s["n"] + window - 1].tobytes())):
                                column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                     pa.array(out[3], pa.int64()), pa.array(out[4], pa.binary())],
                    [ROW, "at", "mark", "content", "words"])
    return run


def _search(window: int):
    def run(key, group):
        segments = [np.frombuffer(b, np.uint64) for b in group.column("words").to_pylist()]
        found = repeated_starts(segments, window)
        keep = [k for k, f in enumerate(found) if len(f)]
        return pa.table({"mark": group.column("mark").take(keep), "content": group.column("content").take(keep),
                         "starts": pa.array([found[k].tolist() for k in keep], pa.list_(pa.int32()))})
    return run


def repeated_windows(ws: Workspace, docs: DataFrame, text_col: str = "text", window: int = WINDOW,
                     mark: int = MARK) -> DataFrame:
    """__tidegate_row, starts: the places, in words, where repeated windows of a pinned input start."""
    texts = keyed(docs, F.col(text_col).cast("string").alias("text"))
    cut = ws.keep(texts.mapInArrow(_segments(window, mark), _SEGMENTS), "segments")
    contents = ws.keep(cut.groupBy("mark", "content").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct(ROW, "at", "n")).alias("one")), "contents")
    ws.release()
    marks = ws.keep(contents.groupBy("mark").agg(F.sum("times").alias("all"), F.count(F.lit(1)).alias("kinds"))
                    .where(F.col("all") > 1).select("mark", (F.col("kinds") > HOT).alias("hot"), "kinds"), "marks")
    # A content that occurs twice repeats whole; those with other contents beside them are searched.
    beside = marks.where("kinds > 1")
    shared = contents.join(beside.where("not hot").select("mark", "hot"), "mark").select(
        "one.*", "mark", "content", "hot")
    hot = cut.join(beside.where("hot").select("mark", "hot"), "mark").select(ROW, "at", "n", "mark", "content", "hot")
    wanted = shared.unionByName(hot).groupBy(ROW).agg(F.collect_list(F.struct("at", "n", "mark", "content", "hot")).alias("asked"))
    read = ws.keep(texts.join(wanted, ROW).select(ROW, "text", "asked").mapInArrow(
        _contents(window), f"{ROW} long, at int, mark long, content long, words binary"), "read")
    ws.release()
    single = read.where(F.col(ROW).isNotNull())
    twice = single.groupBy("content").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    size = read.where(F.col(ROW).isNull()).agg(F.sum(F.octet_length("words") / 8)).first()[0] or 0
    shards = max(1, int(size // SHARD_WORDS) + 1)
    found = ws.keep(
        read.where(F.col(ROW).isNull()).withColumn("shard", F.pmod(F.xxhash64("mark"), F.lit(shards)))
        .groupBy("shard").applyInArrow(_search(window), "mark long, content long, starts array<int>"), "found")
    ws.release()
    equal = contents.where("times > 1").select("mark", "content")
    quiet = cut.join(marks.where("not hot").select("mark"), "mark", "left_semi")
    starts = quiet.join(equal, ["mark", "content"], "left_semi").select(
        ROW, F.col("at").alias("from"), (F.col("at") + F.col("n") - 1).alias("to"))
    inner = quiet.join(found, ["mark", "content"]).select(ROW, F.explode("starts").alias("k"), "at").select(
        ROW, (F.col("at") + F.col("k")).alias("from"), (F.col("at") + F.col("k")).alias("to"))
    alone = single.join(twice, "content", "left_semi").select(ROW, F.col("at").alias("from"), F.col("at").alias("to"))
    spans = ws.keep(starts.unionByName(inner).unionByName(alone).groupBy(ROW).agg(
        F.collect_list(F.struct("from", "to")).alias("spans")), "spans")
    for done in (cut, contents, marks, read, found):
        ws.drop(done)
    ws.release()
    return spans


def _without(window: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            spans = batch.column(2)
            for row, words in words_of(batch.column(1)):
                n = len(words.first) - 1
                change = np.zeros(len(words.hashes) + 1, np.int32)
                part = spans.slice(row, n)
                counts = np.array([len(s) if s.is_valid else 0 for s in part]) if part.null_count < n else np.zeros(n, int)
                if counts.sum():
                    flat = part.drop_null().flatten()
                    base = np.repeat(words.first[:-1], counts)
                    np.add.at(change, base + np.asarray(flat.field("from")), 1)
                    np.add.at(change, base + np.asarray(flat.field("to")) + window, -1)
                kept = np.cumsum(change[:-1]) == 0
                doc = words.doc_of()
                # Kept words with one space between: mask of the bytes to keep.
                edge = np.zeros(len(words.data) + 2, np.int32)
                use = np.flatnonzero(kept)
                more = np.zeros(len(use), bool)
                more[:-1] = doc[use[1:]] == doc[use[:-1]]
                np.add.at(edge, words.starts[use], 1)
                np.add.at(edge, words.ends[use] + more, -1)
                mask = np.cumsum(edge[:len(words.data)]) > 0
                data = words.data.copy()
                data[words.ends[use[more]]] = 32
                out = data[mask]
                size = np.concatenate([[0], np.cumsum(np.bincount(doc[use], (words.ends - words.starts)[use] + more, minlength=n))]).astype(np.int64)
                total = words.counts()
                left = np.bincount(doc[use], minlength=n)
                view = out.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, n), pa.array(total), pa.array(total - left),
                     pa.array([view[a:b].decode("utf-8", "replace") for a, b in zip(size[:-1], size[1:])], pa.string())],
                    ["id", "n_words", "n_removed", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, n_words, n_removed, kept_text for every document."""
    ws = Workspace(docs.sparkSession, "substrings")
    docs = pinned(ws, docs)
    spans = repeated_windows(ws, docs, text_col, window)
    texts = keyed(docs, F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(spans, ROW, "left").select("id", "text", "spans").mapInArrow(
        _without(window), "id long, n_words long, n_removed long, kept_text string")

