"""Line deduplication by pairwise alignment.

Documents overlap where they share a line. A line goes from a document if the alignment with
any earlier document (smaller id) that holds it deletes it; the first holder keeps it. Each
later holder is first aligned with the first holder of each of its lines, which links every
holder once and settles nearly all. Line places that an earlier document holds and that are
still there are then aligned with the further earlier holders, in rank: 1, 2, 4, ... holders
a round, until the place is deleted or no earlier holder is left, so no place costs more
than twice the alignments it needs.

Each pair is aligned by patience diff: common prefix and suffix, then the lines that occur
once on both sides, of which the longest increasing run anchors the alignment, and again
between the anchors; a range without such lines is aligned by a longest common subsequence.
The lines of the aligned blocks are deleted from the later document.

Lines are compared by a 64-bit hash of their bytes. A pair carries two arrays of hashes,
as long as its documents have lines; no group of documents ever meets in one task.

Defined results: NULL and empty texts have no lines; lines without a word are never links
and go only where they are; repeated rows and repeated ids count as later documents in row
order; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import SEQ, number_rows
from .common import ROW, SPACES, Workspace, keyed, pinned


def _anchors(a: list, b: list, box: tuple) -> list[tuple[int, int]]:
    """Lines that are unique in both ranges, as the longest run increasing on both sides."""
    a0, a1, b0, b1 = box
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    place = {a[i]: i for i in range(a0, a1) if in_a[a[i]] == 1 and in_b.get(a[i]) == 1}
    pairs = [(place[b[j]], j) for j in range(b0, b1) if b[j] in place]
    tops, last, back = [], [], [None] * len(pairs)
    for k, (i, _) in enumerate(pairs):
        pile = bisect_left(tops, i)
        back[k] = last[pile - 1] if pile else None
        if pile == len(tops):
            tops.append(i)
            last.append(k)
        else:
            tops[pile], last[pile] = i, k
    run, k = [], last[-1] if last else None
    while k is not None:
        run.append(pairs[k])
        k = back[k]
    return run[::-1]


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of b and the first i of a, for every i; a row of bits a line of b."""
    masks = {}
    for i, line in enumerate(a):
        masks[line] = masks.get(line, 0) | 1 << i
    full = (1 << len(a)) - 1
    bits = full
    for line in b:
        hit = bits & masks.get(line, 0)
        bits = ((bits + hit) | (bits - hit)) & full
    flat = np.unpackbits(np.frombuffer(bits.to_bytes(len(a) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.append(0, np.cumsum(1 - flat[:len(a)].astype(np.int64)))


def _longest(a: list, b: list, box: tuple) -> list[tuple[int, int]]:
    """A longest common subsequence of two ranges, found by halving, in memory of one row."""
    a0, a1, b0, b1 = box
    found, halves = [], [([*range(a0, a1)], [*range(b0, b1)])]
    while halves:
        x, y = halves.pop()
        both = {a[i] for i in x} & {b[j] for j in y} - {None}
        x, y = [i for i in x if a[i] in both], [j for j in y if b[j] in both]
        if not x or not y:
            continue
        if len(y) == 1:
            found.append((x[0], y[0]))
            continue
        mid = len(y) // 2
        head = _lengths([a[i] for i in x], [b[j] for j in y[:mid]])
        tail = _lengths([a[i] for i in reversed(x)], [b[j] for j in reversed(y[mid:])])
        cut = int(np.argmax(head + tail[::-1]))
        halves += [(x[:cut], y[:mid]), (x[cut:], y[mid:])]
    return found


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """(place in a, place in b) of the aligned lines, in order. None never aligns."""
    found, boxes = [], [(0, len(a), 0, len(b))]
    while boxes:
        a0, a1, b0, b1 = boxes.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0] and a[a0] is not None:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1] and a[a1 - 1] is not None:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = [p for p in _anchors(a, b, (a0, a1, b0, b1)) if a[p[0]] is not None]
        if not anchors:
            found += _longest(a, b, (a0, a1, b0, b1))
            continue
        found += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        boxes += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if k > i + 1 and m > j + 1]
    return sorted(found)


def _align(batches):
    for batch in batches:
        rows, gone = [], []
        for row, early, late in zip(*(batch.column(c).to_pylist() for c in range(3))):
            places = [j for _, j in patience(early, late)]
            if places:
                rows.append(row)
                gone.append(places)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], [ROW, "gone"])


def _aligned(whole: DataFrame, pairs: DataFrame) -> DataFrame:
    """__tidegate_row, place of the lines that the pairs (__tidegate_row, early) delete."""
    # Both sides grow with the corpus: shuffled at every size, never broadcast.
    later = pairs.join(whole.select(ROW, F.col("lines").alias("late_lines")).hint("merge"), ROW)
    both = later.join(whole.select(F.col(ROW).alias("early"), F.col("lines").alias("early_lines")).hint("merge"), "early")
    gone = both.select(ROW, "early_lines", "late_lines").mapInArrow(_align, f"{ROW} long, gone array<int>")
    return gone.select(ROW, F.explode("gone").alias("place")).distinct()


def _further(ws: Workspace, whole: DataFrame, single: DataFrame, left: DataFrame) -> list[DataFrame]:
    """What the alignments with the holders after the first delete of the places ``left`` (__tidegate_row, place, line)."""
    lines = ws.keep(left.select("line").distinct(), "left-lines", like=left)
    holders = single.join(lines.hint("merge"), "line", "left_semi").select("line", F.col("doc.id").alias("id"), ROW)
    holders = ws.keep(number_rows(holders, ["line"], ["id", ROW], ws.folder("ranked")).select(
        "line", ROW, F.col(SEQ).alias("rank")), "holders")
    whole = ws.keep(whole.join(holders.select(ROW).distinct().hint("merge"), ROW, "left_semi"), "left-texts", like=whole)
    left = ws.keep(left.join(holders.hint("merge"), ["line", ROW]), "left", like=left)
    found, low = [], 1
    while True:
        left = left.where(F.col("rank") > low)
        if left.isEmpty():
            return found
        high = 2 * low
        tried = left.select(ROW, "line", F.explode(F.sequence(
            F.lit(low).cast("long"), F.least(F.lit(high).cast("long"), "rank") - 1)).alias("rank")).distinct()
        pairs = ws.keep(tried.join(holders.withColumnRenamed(ROW, "early").hint("merge"), ["line", "rank"])
                        .select(ROW, "early").distinct(), "further-pairs", like=left, times=low)
        gone = ws.keep(_aligned(whole, pairs), "further-gone", like=whole)
        ws.drop(pairs)
        found.append(gone)
        before = left
        left = ws.keep(left.join(gone.hint("merge"), [ROW, "place"], "left_anti"), "left", like=left)
        ws.drop(before)
        low = high
        ws.release()


def removed_lines(ws: Workspace, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__tidegate_row, gone: places of the deleted lines, for the documents of a pinned input that lose any."""
    lines = F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n"), lambda line: F.when(
        F.btrim(line, F.lit(SPACES)) != "", F.xxhash64(line)))
    whole = ws.keep(keyed(docs, F.col(id_col).alias("id"), lines.alias("lines")), "lines")
    single = whole.select(ROW, F.struct("id", ROW).alias("doc"), F.explode(F.array_distinct("lines")).alias("line"))
    single = single.where("line is not null")
    shared = ws.keep(single.groupBy("line").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("holders"))
                     .where("holders > 1"), "shared", like=whole)
    claims = ws.keep(single.join(shared.hint("merge"), "line").where(F.col("doc") > F.col("first"))
                     .select(ROW, "line", F.col(f"first.{ROW}").alias("early")), "claims", like=whole, times=3)
    ws.drop(shared)
    ws.release()
    gone = ws.keep(_aligned(whole, claims.select(ROW, "early").distinct()), "first-gone", like=whole)
    # The places of the claimed lines that the first holders leave.
    held = claims.groupBy(ROW).agg(F.collect_list("line").alias("held"))
    taken = gone.groupBy(ROW).agg(F.collect_list("place").alias("taken"))
    rest = (whole.join(held.hint("merge"), ROW).join(taken.hint("merge"), ROW, "left")
            .select(ROW, "held", "taken", F.posexplode("lines").alias("place", "line"))
            .where("line is not null and array_contains(held, line)"
                   " and not coalesce(array_contains(taken, place), false)"))
    left = ws.keep(rest.select(ROW, "place", "line"), "unsettled", like=whole, times=2)
    ws.drop(claims)
    ws.release()
    for more in _further(ws, whole, single, left):
        gone = gone.unionByName(more)
    gone = gone.distinct().groupBy(ROW).agg(F.collect_list("place").alias("gone"))
    return ws.keep(gone, "gone", like=gone)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of the documents, the text without its deleted lines, and __tidegate_lines, __tidegate_gone: their counts."""
    ws = Workspace(docs.sparkSession, "line-dedup")
    docs = pinned(ws, docs)
    gone = removed_lines(ws, docs, id_col, text_col)
    out = docs.join(
        gone.withColumnRenamed("gone", "__tidegate_places").hint("merge"), ROW, "left")
    out = out.withColumn("__tidegate_split", F.when(F.col("__tidegate_places").isNotNull(), F.split(F.col(text_col), "\n")))
    kept = F.expr("""array_join(transform(array_except(sequence(0, size(__tidegate_split) - 1), __tidegate_places),
                                          i -> __tidegate_split[i]), '\n')""")
    text = F.when(F.col("__tidegate_places").isNull(), F.col(text_col)).otherwise(kept)
    return out.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in docs.columns if c != ROW],
        F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("__tidegate_lines"),
        F.coalesce(F.size("__tidegate_places"), F.lit(0)).alias("__tidegate_gone"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           count_col: str = "n_chars") -> DataFrame:
    """The documents with their remaining text; those that lost every word go."""
    out = dedup_lines(docs, id_col, text_col)
    emptied = (F.col("__tidegate_gone") > 0) & (F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(SPACES)) == "")
    out = out.where(~emptied)
    if count_col in docs.columns:
        out = out.withColumn(count_col, F.when(F.col("__tidegate_gone") > 0, F.char_length(text_col).cast(
            docs.schema[count_col].dataType)).otherwise(F.col(count_col)))
    return out.select(*docs.columns)
