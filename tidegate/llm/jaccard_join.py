"""Exact Jaccard join of word-shingle sets by prefix lists and set relations.

Lists: the tokens (shingle hashes) of a set are ordered, frequent ones last, and two sets
of Jaccard similarity t share one of their first |x| - ceil(t|x|) + 1 tokens. Only those
enter the inverted lists, with the size of the set and the place of the token; a list is
cut into blocks by set size; blocks whose sizes can't match are skipped, and so are pairs
whose prefixes have too little in common for what is left behind them to make up.

Set relations: equal sets are one set. In a list block the first set is the leader; each
set is compared with the leader it shares most tokens with. Sets found similar to a leader
inherit its answers: they are in its class, so pairs inside a class are never made. For
the rest the leader's answer bounds theirs, since the Jaccard distance is a metric: sets
whose distances to a common leader differ by more than 1 - t can't be similar. What these
bounds leave is compared exactly, block of sets against block of sets. A group of N copies thus
costs about N comparisons.

The order of the tokens only decides the work, never the result: tokens whose count among
all sets is high come last; the list of those is bounded, and others follow hash order.

Defined results: A-Z are folded; fewer than five words make one shingle; sets without
words link with nothing; NULL texts have no words; repeated rows link; rows with NULL id
link but never name a class; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import SEQ, number_rows
from .common import ROW, Workspace, keyed, pinned
from .components import components
from .words import distinct, mix, shingles, u64, words_of

WORDS, PERCENT = 5, 75
#: Tokens counted for the order: those whose hash is in the lowest share; a prefix hardly
#: reaches further. Frequent: in more sets than HOT; at most so many are told to all tasks.
COUNTED_SHARE, HOT, HOT_TOKENS = 0.3, 40, 200_000
#: Rounds in which sets outside a class try further members before all pairs left are looked at.
ROUNDS = 3
#: Bytes of text whose words are worked on at a time: all that is made of them fits a core's cache.
SLICE = 250_000
#: Tokens that texts hold on average at least if each is sorted alone.
SORTED_ALONE = 32
#: Bits of a hash that are looked up before the frequent tokens are searched for it.
LOOK_BITS = 21
#: Tokens a task collects before it sends them on.
SEND = 2_000_000
#: Sets of a block, two words of bits at most, and bytes of their tokens; a longer set is a block of its own.
BLOCK_SETS, BLOCK_BYTES = 128, 400_000
#: Blocks that a task cuts at least, if there are so many.
TASK_BLOCKS = 4
#: Sets of a list up to which its pairs are made one by one; longer lists meet block against block.
SHORT_LIST = 64
#: Tokens that two blocks are compared on at a time.
STRIPE = 4096


def _grouped(group: np.ndarray) -> np.ndarray:
    """Order that brings equal small numbers together, stable; of 16 bits numpy sorts them by counting."""
    small = len(group) and int(group.max()) < 1 << 16
    return np.argsort(group.astype(np.uint16) if small else group, kind="stable")


def _by_text(doc: np.ndarray, value: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens by text and value. A sort for every text takes a quarter of the time of one for all, unless they are tiny."""
    if len(value) < SORTED_ALONE * texts:
        order = np.argsort(value)
        order = order[_grouped(doc[order])]
        return doc[order], value[order]
    if (doc[1:] < doc[:-1]).any():
        order = _grouped(doc)
        doc, value = doc[order], value[order]
    ends = np.searchsorted(doc, np.arange(texts + 1)).tolist()
    for start, end in zip(ends[:-1], ends[1:]):
        value[start:end].sort()
    return doc, value


def _sets(batch, column: int, length: int, below: int = 1 << 64):
    """(first row, number of texts, text, token) with each text's tokens under ``below`` distinct and ascending."""
    for row, words in words_of(batch.column(column), fold=True, size=SLICE):
        doc, value = shingles(words, length)
        if below < 1 << 64:
            low = value < np.uint64(below)
            doc, value = doc[low], value[low]
        doc, value = _by_text(doc, value, len(words.first) - 1)
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        yield row, len(words.first) - 1, doc[new], value[new]


def _profile(length: int):
    def run(batches):
        for batch in batches:
            for row, n, doc, value in _sets(batch, 2, length):
                ends = np.searchsorted(doc, np.arange(n + 1))
                totals = []
                for salt in (1, 2):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(value + np.uint64(salt)), dtype=np.uint64)])
                    totals.append(sums[ends[1:]] - sums[ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(np.diff(ends)),
                     u64(totals[0]), u64(totals[1])], [ROW, "id", "n", "f1", "f2"])
    return run


def _dealt(buckets: int, columns: list[str]):
    """Collects arrays and sends them on by bucket of the first, as binary columns."""
    def send(parts):
        arrays = [np.concatenate(p) for p in parts]
        bucket = (arrays[0] >> np.uint64(20)) % np.uint64(buckets)
        order = _grouped(bucket)
        arrays = [a[order] for a in arrays]
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        used = np.flatnonzero(np.diff(ends))
        return pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)),
             *[pa.array([a[ends[b]:ends[b + 1]].tobytes() for b in used], pa.binary()) for a in arrays]],
            ["bucket", *columns])
    return send


def _low_tokens(length: int, buckets: int):
    send = _dealt(buckets, ["tokens"])
    limit = int(COUNTED_SHARE * 2**64)

    def run(batches):
        held, parts = 0, []
        for batch in batches:
            for _, _, _, value in _sets(batch, 0, length, limit):
                parts.append(value)
                held += len(value)
                if held >= SEND:
                    yield send([parts])
                    held, parts = 0, []
        if held:
            yield send([parts])
    return run


def _frequent(key, group):
    tokens = np.sort(np.concatenate([np.frombuffer(b, np.uint64) for b in group.column("tokens").to_pylist()]))
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    counts = np.diff(np.append(starts, len(tokens)))
    hot = counts > HOT
    return pa.table({"token": u64(tokens[starts[hot]]), "n": pa.array(counts[hot])})


def _among(known: np.ndarray):
    """Whether values are among ascending known ones; most are told apart by their leading bits."""
    shift = np.uint64(64 - LOOK_BITS)
    seen = np.zeros(1 << LOOK_BITS, bool)
    seen[known >> shift] = True

    def run(values: np.ndarray) -> np.ndarray:
        found = seen[values >> shift]
        at = np.flatnonzero(found)
        places = np.minimum(np.searchsorted(known, values[at]), len(known) - 1)
        found[at] = known[places] == values[at]
        return found
    return run


def _postings(length: int, percent: int, hot: np.ndarray, buckets: int):
    send = _dealt(buckets, ["tokens", "rows", "sizes", "places"])

    def run(batches):
        held, parts, frequent = 0, ([], [], [], []), _among(hot)
        for batch in batches:
            rows = np.asarray(batch.column(0))
            for row, n, doc, value in _sets(batch, 1, length):
                if len(hot):
                    order = _grouped(2 * doc + frequent(value))
                    doc, value = doc[order], value[order]
                sizes = np.diff(np.searchsorted(doc, np.arange(n + 1)))
                starts = np.cumsum(sizes) - sizes
                place = np.arange(len(doc)) - starts[doc]
                used = place < (sizes - (percent * sizes + 99) // 100 + 1)[doc]
                for part, array in zip(parts, (value[used], rows[row + doc[used]], sizes[doc[used]].astype(np.int32),
                                               place[used].astype(np.int32))):
                    part.append(array)
                held += int(used.sum())
                if held >= SEND:
                    yield send(parts)
                    held, parts = 0, ([], [], [], [])
        if held:
            yield send(parts)
    return run


def _repeated(key, group):
    """Entries of the tokens that several sets hold."""
    kinds = {"tokens": np.uint64, "rows": np.int64, "sizes": np.int32, "places": np.int32}
    arrays = {c: np.concatenate([np.frombuffer(b, kind) for b in group.column(c).to_pylist()]) for c, kind in kinds.items()}
    order = np.argsort(arrays["tokens"], kind="stable")
    tokens = arrays["tokens"][order]
    same = np.zeros(len(tokens) + 1, dtype=bool)
    same[1:-1] = tokens[1:] == tokens[:-1]
    keep = same[:-1] | same[1:]
    order = order[keep]
    return pa.table({"token": u64(tokens[keep]), ROW: arrays["rows"][order],
                     "n": arrays["sizes"][order], "place": arrays["places"][order]})


def _set_bytes(length: int):
    def run(batches):
        for batch in batches:
            for row, n, doc, value in _sets(batch, 1, length):
                ends = np.searchsorted(doc, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n),
                     pa.array([value[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
                     batch.column(2).slice(row, n), batch.column(3).slice(row, n)], [ROW, "tokens", "leader", "leads"])
    return run


def _common(batches):
    for batch in batches:
        a, b, left, right = (batch.column(k) for k in range(4))
        sizes = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64),
                                    assume_unique=True)) for x, y in zip(left, right)]
        union = [(x.as_buffer().size + y.as_buffer().size) // 8 - c for x, y, c in zip(left, right, sizes)]
        yield pa.RecordBatch.from_arrays([a, b, pa.array(sizes, pa.int64()), pa.array(union, pa.int64())],
                                         ["a", "b", "common", "joint"])


def _prefix_blocks(batches):
    """Cuts the sets, as they come, into blocks of their listed tokens."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    names = ["rows", "sizes", "comps", "leaders", "fars"]
    held, parts, longs, width = [[] for _ in names], [], [], 0

    def block():
        return pa.RecordBatch.from_arrays(
            [*[pa.array([v], pa.list_(k)) for v, k in zip(held, kinds)],
             pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
             pa.array([np.concatenate(parts).tobytes()], pa.binary()),
             pa.array([distinct(np.concatenate(longs)).tobytes()], pa.binary())], [*names, "counts", "tokens", "longs"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:5]]
        for k, (tokens, far_held) in enumerate(zip(batch.column(5), batch.column(6))):
            tokens = np.sort(tokens.values.to_numpy(zero_copy_only=False).view(np.uint64))
            if parts and (len(parts) == BLOCK_SETS or width + tokens.nbytes > BLOCK_BYTES):
                yield block()
                held, parts, longs, width = [[] for _ in names], [], [], 0
            for part, column in zip(held, columns):
                part.append(column[k])
            parts.append(tokens)
            longs.append(far_held.values.to_numpy(zero_copy_only=False).view(np.uint64))
            width += tokens.nbytes
    if parts:
        yield block()


def _block_tokens(batches):
    """The long lists of a block, with the least and the largest size of its sets."""
    for batch in batches:
        for block, sizes, tokens in zip(*batch.columns):
            found = np.frombuffer(tokens.as_buffer(), np.uint64)
            sizes = sizes.values.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [u64(found), *[pa.array(np.full(len(found), v, np.int64)) for v in (block.as_py(), sizes.min(), sizes.max())]],
                ["token", "block", "low", "high"])


def _arrays(batch, k: int) -> list:
    """The columns of one row: lists and binaries as arrays."""
    out = []
    for column in batch.columns:
        value = column[k]
        if pa.types.is_binary(value.type) or pa.types.is_large_binary(value.type):
            out.append(np.frombuffer(value.as_buffer(), np.uint64))
        elif pa.types.is_list(value.type) or pa.types.is_large_list(value.type):
            out.append(value.values.to_numpy(zero_copy_only=False))
        else:
            out.append(value.as_py())
    return out


def _candidates(percent: int):
    """Of two blocks, the pairs that sizes, classes, leaders and listed tokens leave open.

    ``kinds`` says which two classes a pair would link.
    """
    slack = 1 - percent / 100 + 1e-9

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                (x, y, rows_x, n_x, comps_x, leaders_x, fars_x, counts_x, tokens_x,
                 rows_y, n_y, comps_y, leaders_y, fars_y, counts_y, tokens_y) = _arrays(batch, k)
                common = _grid_counts(tokens_x, counts_x, tokens_y, counts_y)
                (rx, ry), (nx, ny), (cx, cy), (lx, ly), (fx, fy) = (
                    (u[:, None], v[None, :]) for u, v in ((rows_x, rows_y), (n_x, n_y), (comps_x, comps_y),
                                                          (leaders_x, leaders_y), (fars_x, fars_y)))
                # Up to the end of the prefix that ends first, common tokens are all in both lists.
                enough = (common + (percent * np.maximum(nx, ny) + 99) // 100 - 1
                          >= (percent * (nx + ny) + 99 + percent) // (100 + percent))
                left = ((common > 0) & enough & (cx != cy) & (percent * nx <= 100 * ny) & (percent * ny <= 100 * nx)
                        & ((lx != ly) | (np.abs(fx - fy) <= slack)) & (lx != ry) & (ly != rx))
                if x == y:
                    left = np.triu(left, 1)
                i, j = np.nonzero(left)
                if len(i):
                    _, kind_x = np.unique(comps_x, return_inverse=True)
                    _, kind_y = np.unique(comps_y, return_inverse=True)
                    used = distinct(np.concatenate([rows_x[i], rows_y[j]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], pa.int64()), pa.array([y], pa.int64()),
                         pa.array([(i * BLOCK_SETS + j).astype(np.int32)]),
                         pa.array([(kind_x[i] * BLOCK_SETS + kind_y[j]).astype(np.int32)]), pa.array([used])],
                        ["x", "y", "pairs", "kinds", "used"])
    return run


def _used(batches):
    """The sets of each of two blocks that their pairs need, as bits by place: two rows for two blocks."""
    for batch in batches:
        for x, y, pairs in zip(*batch.columns):
            pairs = pairs.values.to_numpy(zero_copy_only=False)
            bits = np.zeros((2, 2 * 64), np.uint8)
            bits[0, pairs // BLOCK_SETS] = 1
            bits[1, pairs % BLOCK_SETS] = 1
            words = np.packbits(bits, axis=1, bitorder="little").view("<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.as_py(), y.as_py()], pa.int64()), pa.array(words[:, 0]), pa.array(words[:, 1])],
                ["block", "low", "high"])


def _set_blocks(batches):
    """Blocks of whole sets, from (block, place, row, tokens) in this order."""
    name, places, rows, sizes, parts = None, [], [], [], []

    def block():
        return pa.RecordBatch.from_arrays(
            [pa.array([name], pa.int64()), pa.array([places], pa.list_(pa.int32())), pa.array([rows], pa.list_(pa.int64())),
             pa.array([sizes], pa.list_(pa.int32())), pa.array([b"".join(parts)], pa.binary())],
            ["block", "places", "rows", "sizes", "tokens"])

    for batch in batches:
        for one, place, row, tokens in zip(*batch.columns):
            if one.as_py() != name:
                if places:
                    yield block()
                name, places, rows, sizes, parts = one.as_py(), [], [], [], []
            places.append(place.as_py())
            rows.append(row.as_py())
            parts.append(tokens.as_py())
            sizes.append(len(parts[-1]) // 8)
    if places:
        yield block()


def _needed(batches):
    """The sets of a block that some of the wanted pairs hold, and the pairs numbered by them."""
    for batch in batches:
        for k in range(batch.num_rows):
            y, pairs, kinds, places, rows, sizes, tokens = _arrays(batch, k)
            first, at = np.unique(pairs // BLOCK_SETS, return_inverse=True)
            used = np.searchsorted(places, first)
            sets = np.split(tokens, np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([y], pa.int64()), pa.array([(at * BLOCK_SETS + pairs % BLOCK_SETS).astype(np.int32)]),
                 pa.array([kinds.astype(np.int32)]), pa.array([rows[used]]), pa.array([sizes[used]]),
                 pa.array([b"".join(sets[u].tobytes() for u in used)], pa.binary())],
                ["y", "pairs", "kinds", "rows_x", "sizes_x", "tokens_x"])


def _grid_counts(left, left_sizes, right, right_sizes) -> np.ndarray:
    """Common tokens of every set of one block with every set of another."""
    shared = np.intersect1d(distinct(left), distinct(right), assume_unique=True)
    sides = []
    for tokens, sizes in ((left, left_sizes), (right, right_sizes)):
        at = np.searchsorted(shared, tokens)
        hit = np.flatnonzero(np.append(shared, np.uint64(0))[at] == tokens) if len(shared) else np.zeros(0, np.int64)
        hit = hit[at[hit] < len(shared)]
        sides.append((np.repeat(np.arange(len(sizes)), sizes)[hit], at[hit], len(sizes)))
    counts = np.zeros((len(left_sizes), len(right_sizes)), np.float32)
    for start in range(0, len(shared), STRIPE):
        grids = []
        for member, at, n in sides:
            inside = (at >= start) & (at < start + STRIPE)
            grid = np.zeros((n, STRIPE), np.float32)
            grid[member[inside], at[inside] - start] = 1
            grids.append(grid)
        counts += grids[0] @ grids[1].T
    return counts.astype(np.int64)


def _links_of_blocks(percent: int):
    """Of the wanted pairs of two blocks, a similar one for every two classes that have one."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                pairs, kinds, rows_a, sizes_a, left, places, rows_b, sizes_b, right = _arrays(batch, k)
                i, j = pairs // BLOCK_SETS, np.searchsorted(places, pairs % BLOCK_SETS)
                if len(pairs) > len(rows_a) + len(rows_b):
                    common = _grid_counts(left, sizes_a, right, sizes_b)[i, j]
                else:
                    a, b = (np.split(t, np.cumsum(n)[:-1]) for t, n in ((left, sizes_a), (right, sizes_b)))
                    common = np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j)], np.int64)
                similar = np.flatnonzero(100 * common >= percent * (sizes_a[i].astype(np.int64) + sizes_b[j] - common))
                one = similar[np.unique(kinds[similar], return_index=True)[1]]
                yield pa.RecordBatch.from_arrays([pa.array(rows_a[i[one]]), pa.array(rows_b[j[one]])], ["a", "b"])
    return run


class JaccardJoin:
    """The join over one pinned table; the parts are kept in the workspace."""

    def __init__(self, ws: Workspace, docs: DataFrame, id_col: str, text_col: str, length: int, percent: int):
        self.ws, self.docs, self.length, self.percent = ws, docs, length, percent
        self.texts = keyed(docs, F.col(text_col).cast("string").alias("text"))
        self.profile = ws.keep(keyed(docs, F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string")).mapInArrow(
            _profile(length), f"{ROW} long, id long, n long, f1 long, f2 long"), "profile")

    def lists(self) -> DataFrame:
        """token, __tidegate_row, n, place: entries of the tokens shared by different sets."""
        ws = self.ws
        buckets = max(32, 4 * self.docs.rdd.getNumPartitions())
        counted = self.texts.select("text").mapInArrow(_low_tokens(self.length, buckets), "bucket int, tokens binary")
        frequent = ws.keep(counted.groupBy("bucket").applyInArrow(_frequent, "token long, n long"), "frequent")
        top = frequent.orderBy(F.desc("n"), "token").limit(HOT_TOKENS).select("token").collect()
        ws.release()
        hot = np.sort(np.array([r["token"] for r in top], dtype=np.int64).view(np.uint64))
        entries = self.texts.mapInArrow(
            _postings(self.length, self.percent, hot, buckets),
            "bucket int, tokens binary, rows binary, sizes binary, places binary")
        entries = entries.groupBy("bucket").applyInArrow(_repeated, f"token long, {ROW} long, n int, place int")
        # Of equal sets the first stands for all.
        first = self.profile.where("n > 0").groupBy("n", "f1", "f2").agg(F.min(ROW).alias(ROW)).select(ROW)
        entries = ws.keep(entries, "entries")
        ws.release()
        lists = ws.keep(entries.join(first, ROW, "left_semi"), "lists", like=entries)
        ws.drop(entries)
        return lists

    def sets(self, wanted: DataFrame) -> DataFrame:
        """The tokens of the wanted rows, with the other columns of ``wanted``."""
        rest = [c for c in wanted.columns if c != ROW]
        # Nothing bounds the wanted rows, so they are never sent to all tasks.
        kept = self.texts.join(wanted.hint("merge"), ROW).select(ROW, "text", *rest).mapInArrow(
            _set_bytes(self.length), f"{ROW} long, tokens binary, leader long, leads boolean")
        return self.ws.keep(kept, "sets")

    def with_leaders(self, chosen: DataFrame) -> DataFrame:
        """a, b, common, joint for rows a and the one leader b of each."""
        followers = chosen.select(F.col("a").alias(ROW), F.col("b").alias("leader"), F.lit(False).alias("leads"))
        leaders = chosen.select(F.col("b").alias(ROW), F.lit(None).cast("long").alias("leader"), F.lit(True).alias("leads"))
        wanted = followers.unionByName(leaders).groupBy(ROW).agg(
            F.max("leader").alias("leader"), F.max("leads").alias("leads"))
        sets = self.sets(wanted)
        left = sets.where("leader is not null").select(F.col(ROW).alias("a"), F.col("leader").alias("b"), F.col("tokens").alias("left"))
        right = sets.where("leads").select(F.col(ROW).alias("b"), F.col("tokens").alias("right"))
        found = self._counted(left.join(right, "b"))
        self.ws.drop(sets)
        return found

    def between(self, listed: DataFrame) -> DataFrame:
        """a, b: similar pairs that meet in a long list, at least one for every two classes that have one.

        ``listed``: __tidegate_row, n, comp, leader, far, near, tokens, longs. Sets are sorted by the first set they meet
        in a long list, so that those of one group are neighbours, and cut into blocks. Blocks that meet in a
        long list do so once, whatever the number of sets behind it; pairs exist inside a task only, and
        travel as the numbers of a block's sets.
        """
        ws, percent = self.ws, self.percent
        listed, order = ws.keep(listed, "listed"), ["near", "leader", "comp", ROW]
        # A part-filled block ends every partition, and the pairs of blocks grow with the square of their number.
        tasks = 1 + listed.count() // (TASK_BLOCKS * BLOCK_SETS)
        blocks = listed.repartitionByRange(*order).sortWithinPartitions(*order).select(
            ROW, "n", "comp", "leader", "far", "tokens", "longs").coalesce(tasks).mapInArrow(
            _prefix_blocks, "rows array<long>, sizes array<long>, comps array<long>, leaders array<long>, "
                            "fars array<double>, counts array<long>, tokens binary, longs binary")
        blocks = ws.keep(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
        ws.drop(listed)
        held = ws.keep(blocks.select("block", "sizes", "longs").mapInArrow(
            _block_tokens, "token long, block long, low long, high long"), "held")
        x, y = held.alias("x"), held.alias("y")
        met = x.join(y, F.expr(f"""x.token = y.token and x.block < y.block
                                   and {percent} * x.low <= 100 * y.high and {percent} * y.low <= 100 * x.high"""))
        met = met.select(F.col("x.block").alias("x"), F.col("y.block").alias("y")).distinct().unionByName(
            blocks.select(F.col("block").alias("x"), F.col("block").alias("y")))
        columns = ["rows", "sizes", "comps", "leaders", "fars", "counts", "tokens"]
        sides = {side: blocks.hint("merge").select(
            F.col("block").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]) for side in "xy"}
        both = met.join(sides["x"], "x").join(sides["y"], "y").select(
            "x", "y", *[f"{c}_{side}" for side in "xy" for c in columns])
        pairs = ws.keep(both.mapInArrow(
            _candidates(percent), "x long, y long, pairs array<int>, kinds array<int>, used array<long>").drop("used"), "pairs")
        ws.drop(held)
        place = ws.keep(blocks.select("block", F.posexplode("rows").alias("place", ROW)), "place")
        ws.drop(blocks)
        return self.exact(place, pairs)

    def met_shortly(self, open_lists: DataFrame) -> DataFrame:
        """a, b: similar pairs that meet in a short list."""
        ws, percent = self.ws, self.percent
        longs = open_lists.groupBy(ROW).agg(F.count(F.when(F.col("long"), 1)).alias("longs"))
        lists = ws.keep(open_lists.where("not long").join(longs, ROW), "short")
        x, y = lists.alias("x"), lists.alias("y")
        slack = 1 - percent / 100 + 1e-9
        shared = (x.join(y, F.expr(f"""x.token = y.token and x.{ROW} < y.{ROW} and x.comp <> y.comp
                    and {percent} * x.n <= 100 * y.n and {percent} * y.n <= 100 * x.n
                    and (x.leader <> y.leader or abs(x.far - y.far) <= {slack})
                    and x.leader <> y.{ROW} and y.leader <> x.{ROW}"""))
                  .groupBy(F.col(f"y.{ROW}").alias("a"), F.col(f"x.{ROW}").alias("b"))
                  .agg(F.count(F.lit(1)).alias("c"), F.first("x.n").alias("nx"), F.first("y.n").alias("ny"),
                       F.first(F.least("x.longs", "y.longs")).alias("more"), F.first("x.leader").alias("leader")))
        # Up to the end of the prefix that ends first, common tokens are all in both lists.
        enough = F.expr(f"""c + more + ({percent} * greatest(nx, ny) + 99) div 100 - 1
                            >= ({percent} * (nx + ny) + {99 + percent}) div {100 + percent}""")
        pairs = ws.keep(shared.where(enough).select("a", "b", "leader", "nx", "ny"), "few")
        ends = pairs.select(F.col("a").alias(ROW), F.col("ny").alias("n"), "leader").unionByName(
            pairs.select(F.col("b").alias(ROW), F.col("nx").alias("n"), "leader")).groupBy(ROW).agg(
                F.min("leader").alias("leader"), F.first("n").alias("n"))
        numbered = number_rows(ends, [], ["leader", ROW], ws.folder("ends"))
        # A very long set is a block of its own.
        alone = F.col("n") * 8 * 16 > BLOCK_BYTES
        place = ws.keep(numbered.select(
            F.when(alone, -1 - F.col(ROW)).otherwise(F.expr(f"{SEQ} div {BLOCK_SETS}")).alias("block"),
            F.when(alone, 0).otherwise(F.col(SEQ) % BLOCK_SETS).cast("int").alias("place"), ROW), "place")
        sides = {end: place.hint("merge").select(F.col(ROW).alias(end), F.struct("block", "place").alias(f"at_{end}"))
                 for end in "ab"}
        met = pairs.select("a", "b").join(sides["a"], "a").join(sides["b"], "b").select(
            "a", "b", F.least("at_a", "at_b").alias("i"), F.greatest("at_a", "at_b").alias("j"))
        met = met.groupBy(F.col("i.block").alias("x"), F.col("j.block").alias("y")).agg(
            F.collect_list((F.col("i.place") * BLOCK_SETS + F.col("j.place")).cast("int")).alias("pairs"))
        # Every pair counts as one of two classes of its own.
        met = ws.keep(met.select("x", "y", "pairs", F.expr("sequence(0, size(pairs) - 1)").alias("kinds")), "met")
        ws.drop(lists)
        return self.exact(place, met)

    def exact(self, place: DataFrame, pairs: DataFrame) -> DataFrame:
        """a, b: of pairs of blocks (x, y, pairs, kinds), a similar pair of each kind."""
        ws = self.ws
        ws.release()
        used = pairs.select("x", "y", "pairs").mapInArrow(_used, "block long, low long, high long").groupBy("block").agg(
            F.bit_or("low").alias("low"), F.bit_or("high").alias("high"))
        needed = F.expr("getbit(if(place < 64, low, high), place % 64) = 1")
        wanted = place.join(used.hint("merge"), "block").where(needed).select(
            ROW, F.lit(None).cast("long").alias("leader"), F.lit(False).alias("leads"))
        sets = self.sets(wanted)
        whole = ws.keep(sets.select(ROW, "tokens").join(place.hint("merge"), ROW).repartition("block")
                        .sortWithinPartitions("block", "place").select("block", "place", ROW, "tokens").mapInArrow(
                            _set_blocks, "block long, places array<int>, rows array<long>, sizes array<int>, tokens binary"),
                        "whole")
        ws.drop(sets)
        sides = {side: whole.hint("merge").select(
            F.col("block").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in whole.columns[1:]]) for side in "xy"}
        # Only the sets that a pair of the two blocks needs travel on to the other block.
        near = pairs.join(sides["x"], "x").select(
            "y", "pairs", "kinds", "places_x", "rows_x", "sizes_x", "tokens_x").mapInArrow(
            _needed, "y long, pairs array<int>, kinds array<int>, rows_x array<long>, sizes_x array<int>, tokens_x binary")
        found = near.join(sides["y"], "y").select(
            "pairs", "kinds", "rows_x", "sizes_x", "tokens_x", "places_y", "rows_y", "sizes_y", "tokens_y").mapInArrow(
            _links_of_blocks(self.percent), "a long, b long")
        found = ws.keep(found, "between")
        for df in (whole, place, pairs):
            ws.drop(df)
        ws.release()
        return found

    def _counted(self, both: DataFrame) -> DataFrame:
        return self.ws.keep(both.select("a", "b", "left", "right").mapInArrow(
            _common, "a long, b long, common long, joint long"), "compared")

    @staticmethod
    def most_votes(votes: DataFrame) -> DataFrame:
        """a, b: the leader that shares most tokens with each set, if not too few."""
        best = votes.groupBy(ROW).agg(F.min(F.struct((-F.col("votes")).alias("v"), F.col("leader"))).alias("best"),
                                      F.first("n").alias("n"))
        return best.where(-20 * F.col("best.v") >= F.col("n")).select(F.col(ROW).alias("a"), F.col("best.leader").alias("b"))

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Links (a, b) that connect all similar sets, and the classes they make (node, comp)."""
        ws, percent = self.ws, self.percent
        # A block: entries of one token whose sizes lie within one power of 100 / percent.
        width = float(np.log(100 / percent))
        lists = self.lists().withColumn("block", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)))
        # The leader of a block is the set that shares most with all others, as the original of copies does.
        tokens = lists.groupBy("token").agg(F.count(F.lit(1)).alias("m"))
        weights = lists.join(tokens, "token").groupBy(ROW).agg(F.sum("m").alias("weight"), F.first("n").alias("n"))
        found = lists
        lists = ws.keep(lists.join(weights.select(ROW, "weight"), ROW), "weighted", like=lists)
        ws.drop(found)
        best = F.max(F.struct("weight", (-F.col(ROW)).alias("row")))
        leaders = lists.groupBy("token", "block").agg(best.alias("best"), F.count(F.lit(1)).alias("m")).where("m > 1")
        votes = (lists.join(leaders.select("token", "block", (-F.col("best.row")).alias("leader")), ["token", "block"])
                 .where(F.col(ROW) != F.col("leader")).groupBy(ROW, "leader").agg(F.count(F.lit(1)).alias("votes"),
                                                                                   F.first("n").alias("n")))
        # Few common tokens are left to the second round, which has an exact bound for them.
        chosen = ws.keep(self.most_votes(votes), "chosen", like=lists)
        ws.release()
        first = self.with_leaders(chosen)
        ws.release()
        similar = F.expr(f"100 * common >= {percent} * joint")
        edges = first.where(similar).select("a", "b")
        classes = components(ws, edges)
        compared = first.select("a", "b")
        for turn in range(ROUNDS):
            # Sets outside the largest class of a block try another member of it.
            named = lists.join(classes.withColumnRenamed("node", ROW), ROW, "left").withColumn("comp", F.coalesce("comp", ROW))
            counts = named.groupBy("token", "block", "comp").agg(
                F.count(F.lit(1)).alias("m"), F.min(F.struct(F.xxhash64(ROW, F.lit(turn)).alias("h"), F.col(ROW))).alias("one"))
            largest = counts.groupBy("token", "block").agg(
                F.max(F.struct("m", "one", "comp")).alias("top"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
            tries = (named.join(largest.where("top.m > 1").select("token", "block", "top"), ["token", "block"])
                     .where(F.col("comp") != F.col("top.comp"))
                     .groupBy(ROW, F.col(f"top.one.{ROW}").alias("leader"))
                     .agg(F.count(F.lit(1)).alias("votes"), F.first("n").alias("n")))
            chosen = ws.keep(self.most_votes(tries).join(compared, ["a", "b"], "left_anti"), "chosen", like=lists)
            if chosen.isEmpty():
                break
            ws.release()
            more = self.with_leaders(chosen)
            compared = compared.unionByName(more.select("a", "b"))
            compared = ws.keep(compared, "compared", like=compared)
            new = more.where(similar).select("a", "b")
            if new.isEmpty():
                break
            edges = edges.unionByName(new)
            edges = ws.keep(edges, "links", like=edges)
            classes = components(ws, edges)

        known = first.select(F.col("a").alias(ROW), F.col("b").alias("leader"), (1 - F.col("common") / F.col("joint")).alias("far"))
        marked = (lists.join(classes.withColumnRenamed("node", ROW), ROW, "left").join(known, ROW, "left")
                  .select("token", "block", ROW, "n", "place", F.coalesce("comp", ROW).alias("comp"),
                          F.coalesce("leader", ROW).alias("leader"), F.coalesce("far", F.lit(0.0)).alias("far")))
        # Only lists with several classes can hold a link that isn't implied yet.
        marked = ws.keep(marked, "marked", like=lists)
        mixed = marked.groupBy("token").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(ROW).alias("first"),
            (F.count(F.lit(1)) > SHORT_LIST).alias("long")).where("lo <> hi").select("token", "first", "long")
        open_lists = ws.keep(marked.join(mixed, "token"), "open", like=marked)
        for df in (lists, marked):
            ws.drop(df)
        listed = open_lists.groupBy(ROW).agg(
            *[F.first(c).alias(c) for c in ("n", "comp", "leader", "far")],
            F.min(F.when(F.col("long"), F.col("first"))).alias("near"), F.collect_list("token").alias("tokens"),
            F.collect_list(F.when(F.col("long"), F.col("token"))).alias("longs")).where("near is not null")
        edges = ws.keep(edges.unionByName(self.between(listed)).unionByName(self.met_shortly(open_lists)), "links")
        return edges, components(ws, edges)

    def classes(self) -> DataFrame:
        """__tidegate_row, id, n, comp: the class of every row (NULL for sets without words)."""
        _, classes = self.links()
        same = self.profile.where("n > 0").groupBy("n", "f1", "f2").agg(F.min(ROW).alias("first"))
        same = same.join(classes.withColumnRenamed("node", "first"), "first", "left").select(
            "n", "f1", "f2", F.coalesce("comp", "first").alias("comp"))
        return self.ws.keep(self.profile.join(same, ["n", "f1", "f2"], "left").select(ROW, "id", "n", "comp"), "classes", like=self.profile)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    ws = Workspace(docs.sparkSession, "jaccard")
    classes = JaccardJoin(ws, pinned(ws, docs), id_col, text_col, length, percent).classes()
    names = classes.where("comp is not null").groupBy("comp").agg(F.min("id").alias("least"))
    return classes.join(names, "comp", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                length: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents without later members of each class; those without words stay."""
    ws = Workspace(docs.sparkSession, "jaccard")
    docs = pinned(ws, docs)
    classes = JaccardJoin(ws, docs, id_col, text_col, length, percent).classes()
    first = classes.where("comp is not null").groupBy("comp").agg(F.min(F.struct("id", ROW)).alias("first"))
    kept = ws.keep(first.select(F.col(f"first.{ROW}").alias(ROW))
                   .unionByName(classes.where("comp is null").select(ROW)), "kept", like=classes)
    return docs.join(kept.hint("merge"), ROW, "left_semi").drop(ROW)
