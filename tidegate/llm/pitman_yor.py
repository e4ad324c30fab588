"""Scoring texts by a hierarchical Pitman-Yor language model.

Every word is drawn from the restaurant of its context, the word before it (the end token
for the first); the restaurants of all contexts share one parent, the restaurant of words without
context, whose base is uniform over the words and one unknown word. Customers are the
words of the training texts. In each restaurant the customers of a word sit at tables, and
each table sends one customer to the parent. Seating is sampled by Gibbs sweeps: the
customers of a word leave a restaurant and come back one by one, opening a table with the
probability that the other seats and the parent give (long queues in blocks, within which
it is held). Predictive probabilities are averaged over the sweeps after the first.

The words are dealt to buckets by hash, so a word's seats in all contexts, and hence its
share of the parent, are in one bucket, whatever its frequency. The customers and tables of
a restaurant are summed over the buckets between sweeps: each bucket reports what it holds of a context to
the bucket of that word, and gets the total back. Texts are cut into chunks; a chunk asks each
bucket once for the distinct words and (word, context) pairs it holds and gets seats, counts and
totals back in the same order. All that is gathered grows with the corpus, nothing of it
meets in one task or the driver.

Defined results: NULL texts are empty, and every text ends in one end token; A-Z are folded;
without training texts all counts are 0; repeated rows are scored alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import storage
from .common import Workspace
from .toxicity import held_out
from .words import distinct, words_of

#: Sweeps before the first sample, and samples.
BURN, SAMPLES, SEED = 1, 3, 5
STRENGTH = 1.0
CHUNK_TOKENS, BUCKET_PAIRS = 1_000_000, 500_000
#: Shares of the buckets that are asked, and of the chunks that are scored, one after the other: bounds what is shuffled at a time.
TURNS = 3
#: Customers seated one by one; then blocks of a sixteenth of those that sit.
SINGLE = 64
#: Contexts are told apart, and words dealt, by as many leading bytes of their hash.
CONTEXT_BYTES = 5
_SHIFT, _HIGH = np.uint64(64 - 8 * CONTEXT_BYTES), np.uint64(8 * CONTEXT_BYTES)

_END = np.uint64(0x7F4A7C15F39CC060)
_CHUNK = "chunk long, ids binary, held binary, ends binary, names binary, tokens binary, n_pairs long, n_train long"
_ASKED = "bucket int, chunk long, names binary, sizes binary, contexts binary"
_STATE = ("bucket int, names binary, sizes binary, contexts binary, counts binary, seats binary, roots binary, "
          "stats array<double>")
_TOTALS = "bucket int, target int, heads binary, customers binary, tables binary"
_ANSWERS = "chunk long, bucket int, own binary, known binary, customers binary, sent binary, roots binary, tables binary"


def _rows(table):
    """The rows of a batch or table as dictionaries, made one at a time and without copies: a row holds tens of megabytes."""
    for k in range(table.num_rows):
        row = table.slice(k, 1)
        cells = zip(row.schema, (column[0] for column in row.columns))
        yield {f.name: cell.as_buffer() if pa.types.is_binary(f.type) or pa.types.is_large_binary(f.type) else cell.as_py()
               for f, cell in cells}


def _planes(values: np.ndarray) -> bytes:
    """Bytes of 32-bit numbers by significance, which compress better."""
    return np.ascontiguousarray(values.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.int32).ravel()


def _short(heads: np.ndarray) -> bytes:
    """Bytes of contexts, the leading bytes of hashes."""
    return np.ascontiguousarray(heads.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CONTEXT_BYTES]).tobytes()


def _from_short(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // CONTEXT_BYTES, 8), np.uint8)
    wide[:, :CONTEXT_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, CONTEXT_BYTES)
    return wide.view("<u8").ravel()


def tokens_of(words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the tokens of a slice, number of tokens of each text): the words, and an end after each text."""
    counts = words.counts()
    tokens = np.full(len(words.hashes) + len(counts), _END, np.uint64)
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(counts + 1) - 1] = False
    tokens[inside] = words.hashes
    return tokens, counts + 1


def _codes(names: np.ndarray, token: np.ndarray) -> np.ndarray:
    code = token.astype(np.uint64) << np.uint64(32)
    code[1:] |= token[:-1].astype(np.uint64)
    code[:1] |= np.uint64(np.searchsorted(names, _END))
    return code


def _split_codes(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (code >> np.uint64(32)).astype(np.int64), (code & np.uint64(0xFFFFFFFF)).astype(np.int64)


def pairs_of(names: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, contexts, pair) of the tokens of whole texts, given as places in ascending ``names``.

    ``words`` and ``contexts`` place the distinct pairs of a token and the one before it in ``names``, by word; ``pair`` is
    the pair of each token. A text follows the end of the one before it.
    """
    code, pair = np.unique(_codes(names, token), return_inverse=True)
    return *_split_codes(code), pair


def _chunks(batches):
    import pyspark

    held, parts, number = 0, [], 0
    task = pyspark.TaskContext.get()
    base = task.partitionId() << 32

    def chunk(parts, number):
        ids, out, counts, tokens = (np.concatenate(p) for p in zip(*parts))
        names, token = np.unique(tokens, return_inverse=True)
        del tokens
        n_pairs = len(distinct(_codes(names, token)))
        n_train = int(counts[out % 2 == 0].sum())
        return pa.RecordBatch.from_arrays(
            [pa.array([base + number]), pa.array([ids.tobytes()], pa.binary()), pa.array([out.tobytes()], pa.binary()),
             pa.array([np.cumsum(counts).astype(np.int64).tobytes()], pa.binary()), pa.array([names.tobytes()], pa.binary()),
             pa.array([_planes(token)], pa.binary()), pa.array([n_pairs]), pa.array([n_train])],
            ["chunk", "ids", "held", "ends", "names", "tokens", "n_pairs", "n_train"])

    for batch in batches:
        ids = np.asarray(batch.column(0))
        out = np.asarray(batch.column(1)).astype(np.uint8)
        for row, words in words_of(batch.column(2), fold=True):
            tokens, counts = tokens_of(words)
            parts.append((ids[row:row + len(counts)], out[row:row + len(counts)], counts, tokens))
            held += len(tokens)
            if held >= CHUNK_TOKENS:
                yield chunk(parts, number)
                held, parts, number = 0, [], number + 1
    if parts:
        yield chunk(parts, number)


def _bounds(heads: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, a range of leading bytes, starts in ascending ones."""
    size = (1 << 8 * CONTEXT_BYTES) // buckets + 1
    return np.searchsorted(heads, np.arange(buckets + 1, dtype=np.uint64) * np.uint64(size))


def _asked(buckets: int, turn: int | None = None):
    """A row for each bucket a chunk asks: with the counts of the pairs, or of the buckets whose ``turn`` it is without."""
    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                names = np.frombuffer(row["names"], np.uint64)
                at, token = _bounds(names >> _SHIFT, buckets), _from_planes(row["tokens"])
                used = np.diff(at) > 0
                if turn is None:
                    words, contexts, pair = pairs_of(names, token)
                else:
                    mine = np.arange(buckets) % TURNS == turn
                    used &= mine
                    words, contexts = _split_codes(distinct(_codes(names, token)[np.repeat(mine, np.diff(at))[token]]))
                sizes, contexts = np.bincount(words, minlength=len(names)), (names >> _SHIFT)[contexts]
                if turn is None:
                    ends, out = np.frombuffer(row["ends"], np.int64), np.frombuffer(row["held"], np.uint8)
                    counts = np.bincount(pair[np.repeat(out % 2 == 0, np.diff(ends, prepend=0))], minlength=len(words))
                pairs = np.append(0, np.cumsum(sizes, dtype=np.int64))[at]
                used = np.flatnonzero(used)
                columns = [pa.array(used.astype(np.int32)), pa.array([row["chunk"]] * len(used), pa.int64()),
                           pa.array([names[at[b]:at[b + 1]].tobytes() for b in used], pa.binary()),
                           pa.array([_planes(sizes[at[b]:at[b + 1]]) for b in used], pa.binary()),
                           pa.array([_short(contexts[pairs[b]:pairs[b + 1]]) for b in used], pa.binary())]
                if turn is None:
                    columns.append(pa.array([_planes(counts[pairs[b]:pairs[b + 1]]) for b in used], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    columns, ["bucket", "chunk", "names", "sizes", "contexts", "counts"][:len(columns)])
    return run


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes, dtype=np.int64) - sizes


def _stats(counts, sent, roots) -> list[float]:
    """Customers, tables and words of the parent, then what the discounts follow from."""
    return [float(sent.sum()), float(roots.sum()), float(len(sent)), float((counts == 1).sum()), float((counts == 2).sum()),
            float((sent == 1).sum()), float((sent == 2).sum())]


def _merged(key, group):
    """The training pairs of a bucket with their counts; one table each to begin with."""
    rows = group.to_pylist()
    counts = np.concatenate([_from_planes(r["counts"]) for r in rows])
    names = [np.frombuffer(r["names"], np.uint64) for r in rows]
    every = distinct(np.concatenate(names))
    words = np.concatenate([np.repeat(np.searchsorted(every, n), _from_planes(r["sizes"])) for n, r in zip(names, rows)])
    # A word's place and the bytes of a context fill 64 bits.
    code = words.astype(np.uint64) << _HIGH | np.concatenate([_from_short(r["contexts"]) for r in rows])
    del rows, names, words
    order = np.flatnonzero(counts > 0)
    order = order[np.argsort(code[order])]
    code, counts = code[order], counts[order].astype(np.int64)
    new = np.ones(len(order), bool)
    new[1:] = code[1:] != code[:-1]
    first = np.flatnonzero(new)
    counts = np.add.reduceat(counts, first) if len(first) else counts
    code = code[first]
    contexts = code & ((np.uint64(1) << _HIGH) - np.uint64(1))
    sizes = np.bincount((code >> _HIGH).astype(np.int64), minlength=len(every))
    names, sizes = every[sizes > 0], sizes[sizes > 0]
    seats, roots = np.ones(len(code), np.int64), np.ones(len(names), np.int64)
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "names": pa.array([names.tobytes()], pa.binary()),
                     "sizes": pa.array([_planes(sizes)], pa.binary()), "contexts": pa.array([_short(contexts)], pa.binary()),
                     "counts": pa.array([_planes(counts)], pa.binary()), "seats": pa.array([_planes(seats)], pa.binary()),
                     "roots": pa.array([_planes(roots)], pa.binary()),
                     "stats": pa.array([_stats(counts, sizes, roots)], pa.list_(pa.float64()))})


def _reports(buckets: int):
    """What a bucket holds of each context, for the buckets of the contexts."""
    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                heads, back = np.unique(_from_short(row["contexts"]), return_inverse=True)
                customers, tables = (np.bincount(back, _from_planes(row[c]), minlength=len(heads)) for c in ("counts", "seats"))
                at = _bounds(heads, buckets)
                used = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["bucket"]] * len(used), pa.int32()), pa.array(used.astype(np.int32)),
                     *[pa.array([packed(a[at[b]:at[b + 1]]) for b in used], pa.binary())
                       for packed, a in ((_short, heads), (_planes, customers), (_planes, tables))]],
                    ["bucket", "target", "heads", "customers", "tables"])
    return run


def _summed(key, group):
    """The totals of the contexts of a bucket (without ``bucket``), and the tables for each bucket that reported."""
    rows = sorted(group.to_pylist(), key=lambda r: r["bucket"])
    heads, back = np.unique(np.concatenate([_from_short(r["heads"]) for r in rows]), return_inverse=True)
    customers, tables = (np.bincount(back, np.concatenate([_from_planes(r[c]) for r in rows]), minlength=len(heads))
                         for c in ("customers", "tables"))
    ends = np.cumsum([len(r["heads"]) // CONTEXT_BYTES for r in rows])
    told = [_planes(tables[part]) for part in np.split(back, ends[:-1])]
    n = len(rows) + 1
    return pa.table({"bucket": pa.array([None, *[r["bucket"] for r in rows]], pa.int32()),
                     "target": pa.array([key[0].as_py()] * n, pa.int32()),
                     "heads": pa.array([_short(heads), *[None] * (n - 1)], pa.binary()),
                     "customers": pa.array([_planes(customers), *[None] * (n - 1)], pa.binary()),
                     "tables": pa.array([_planes(tables), *told], pa.binary())})


def seat(counts: np.ndarray, weight: np.ndarray, discount: float, rng) -> np.ndarray:
    """Tables of ``counts`` customers that come one by one, by the weight of a new table."""
    tables, seated = np.ones(len(counts), np.int64), np.ones(len(counts), np.int64)
    on = np.flatnonzero(counts > 1)
    while len(on):
        n, t = seated[on], tables[on]
        step = np.minimum(np.where(n < SINGLE, 1, n // 16), counts[on] - n)
        chance = weight[on] / (weight[on] + n - discount * t)
        one = step == 1
        opened = np.empty(len(on), np.int64)
        opened[one] = rng.random(int(one.sum())) < chance[one]
        opened[~one] = rng.binomial(step[~one], chance[~one])
        tables[on], seated[on] = t + opened, n + step
        on = on[seated[on] < counts[on]]
    return tables


class Totals:
    """Sums over all buckets: what a sweep or a score needs besides its own bucket and the contexts' totals."""

    def __init__(self, stats: list[float]):
        self.sent, self.roots, self.words, *ones = stats
        # Discounts from the numbers of pairs, and of words in the parent, seen once and twice.
        pairs, parent = (min(max(a / (a + 2 * b), 0.05), 0.95) if a + b else 0.5 for a, b in (ones[:2], ones[2:]))
        self.discount, self.root_discount = float(pairs), float(parent)

    def root(self, sent, roots):
        """Probability of words in the parent."""
        base = (STRENGTH + self.root_discount * self.roots) / (self.words + 1)
        return (np.maximum(sent - self.root_discount * roots, 0) + base) / (STRENGTH + self.sent)

    def open(self, tables):
        """Weight of a new table in restaurants with so many."""
        return STRENGTH + self.discount * tables


def _sweep(totals: Totals, number: int):
    def run(key, state, told):
        row = state.to_pylist()[0]
        rng = np.random.default_rng((SEED, number, row["bucket"]))
        sizes, counts, seats, roots = (_from_planes(row[c]).astype(np.int64) for c in ("sizes", "counts", "seats", "roots"))
        sent = np.zeros(0, np.int64)
        if len(counts):
            # The contexts come in ascending ranges.
            tables = np.concatenate([_from_planes(r["tables"]) for r in sorted(told.to_pylist(), key=lambda r: r["target"])])
            _, context = np.unique(_from_short(row["contexts"]), return_inverse=True)
            starts = _starts(sizes)
            root = totals.root(np.add.reduceat(seats, starts), roots)
            seats = seat(counts, totals.open(tables[context]) * np.repeat(root, sizes), totals.discount, rng)
            sent = np.add.reduceat(seats, starts)
            new = (STRENGTH + totals.root_discount * totals.roots) / (totals.words + 1)
            roots = seat(sent, np.full(len(sent), new), totals.root_discount, rng)
        return pa.table({"bucket": pa.array([row["bucket"]], pa.int32()),
                         **{c: pa.array([row[c]], pa.binary()) for c in ("names", "sizes", "contexts", "counts")},
                         "seats": pa.array([_planes(seats)], pa.binary()), "roots": pa.array([_planes(roots)], pa.binary()),
                         "stats": pa.array([_stats(counts, sent, roots)], pa.list_(pa.float64()))})
    return run


def _placed(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether there) of the wanted among ascending known ones."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _taken(values: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    return np.where(there, values[at], 0) if len(values) else np.zeros(len(at), values.dtype)


def _answers(samples: list[Totals]):
    """For every asked pair the mean share of its own seats. For every asked word its count and, as a context, its customers;
    by sample, its customers and tables in the parent, and the tables of its restaurant."""
    def run(key, asked, held):
        rows = held.to_pylist()
        nothing = np.zeros(0, np.int64)
        base = next((r for r in rows if r["counts"] is not None), None)
        names, sizes, contexts, counts = (nothing.view(np.uint64), nothing, nothing.view(np.uint64), nothing)
        if base is not None:
            names, contexts = np.frombuffer(base["names"], np.uint64), _from_short(base["contexts"])
            sizes, counts = (_from_planes(base[c]).astype(np.int64) for c in ("sizes", "counts"))
        starts = _starts(sizes)
        total = np.add.reduceat(counts, starts) if len(counts) else counts
        code = np.repeat(np.arange(len(names)), sizes).astype(np.uint64) << _HIGH | contexts
        seats = {r["sample"]: [_from_planes(r[c]).astype(np.int64) for c in ("seats", "roots")]
                 for r in rows if r["seats"] is not None}
        totals = next((r for r in rows if r["heads"] is not None), None)
        heads, customers = nothing.view(np.uint64), nothing
        if totals is not None:
            heads, customers = _from_short(totals["heads"]), _from_planes(totals["customers"])
        tables = {r["sample"]: _from_planes(r["tables"]) for r in rows if r["tables"] is not None}
        own = np.zeros(len(counts))
        for s, t in enumerate(samples):
            if s in seats:
                own += np.maximum(counts - t.discount * seats[s][0], 0) / len(samples)
        sent = {s: np.add.reduceat(sitting, starts) if len(sitting) else sitting for s, (sitting, _) in seats.items()}
        out = {c: [] for c in ("own", "known", "customers", "sent", "roots", "tables")}
        for row in _rows(asked.select(["names", "sizes", "contexts"])):
            want = np.frombuffer(row["names"], np.uint64)
            at, there = _placed(names, want)
            wanted = _from_planes(row["sizes"])
            pair, hit = _placed(code, np.repeat(at, wanted).astype(np.uint64) << _HIGH | _from_short(row["contexts"]))
            hit &= np.repeat(there, wanted)
            place, known = _placed(heads, want >> _SHIFT)
            out["own"].append(_planes(_taken(own, pair, hit).astype(np.float32).view(np.int32)))
            out["known"].append(_planes(_taken(total, at, there)))
            out["customers"].append(_planes(_taken(customers, place, known)))
            # Numbers of seats are small: their bytes shrink as those of the probabilities made of them would not.
            for c, of, k, found in (("sent", sent, at, there), ("tables", tables, place, known)):
                out[c].append(_planes(np.concatenate([_taken(of.get(s, nothing), k, found) for s in range(len(samples))])))
            out["roots"].append(_planes(np.concatenate(
                [_taken(seats[s][1] if s in seats else nothing, at, there) for s in range(len(samples))])))
        chunks = asked.column("chunk")
        return pa.table({"chunk": chunks, "bucket": pa.array([key[0].as_py()] * len(chunks), pa.int32()),
                         **{c: pa.array(v, pa.binary()) for c, v in out.items()}})
    return run


def _scores(train: int, words: int, samples: list[Totals]):
    """The texts of a chunk, from what the buckets answer about it."""
    def run(key, chunk, told):
        told = told.sort_by("bucket")
        column = lambda c, read: [read(v.as_buffer()) for v in told.column(c)]
        p = np.concatenate(column("own", _from_planes)).view(np.float32).astype(np.float64)
        known, customers = (np.concatenate(column(c, _from_planes)) for c in ("known", "customers"))
        sent, roots, tables = (np.concatenate([a.reshape(len(samples), -1) for a in column(c, _from_planes)], axis=1)
                               for c in ("sent", "roots", "tables"))
        del told
        ids, held, ends, names, tokens = (chunk.column(c)[0].as_buffer() for c in ("ids", "held", "ends", "names", "tokens"))
        word, context, pair = pairs_of(np.frombuffer(names, np.uint64), _from_planes(tokens))
        for s, t in enumerate(samples):
            parent, opens = t.root(sent[s], roots[s]).astype(np.float32), t.open(tables[s]).astype(np.float32)
            p += opens[context].astype(np.float64) * parent[word] / len(samples)
        p = np.log10(p / (STRENGTH + customers[context]))
        held, ends = np.frombuffer(held, np.uint8), np.frombuffer(ends, np.int64)
        starts = np.append(0, ends[:-1])
        base = np.log10((known + 1.0) / (train + words + 1.0))[word]
        return pa.table(
            [pa.array(np.frombuffer(ids, np.int64), mask=held > 1), pa.array(held % 2 == 1), pa.array(ends - starts),
             pa.array(np.add.reduceat((known > 0)[word][pair].astype(np.int64), starts)),
             pa.array(np.full(len(ends), train)), pa.array(np.add.reduceat(base[pair], starts)),
             pa.array(np.add.reduceat(p[pair], starts))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ws = Workspace(docs.sparkSession, "pitman-yor")
    spark = ws.spark
    out = held_out(docs[id_col], 7, 2)
    # Held-out flag in bit 0, NULL id in bit 1.
    flags = F.when(out, 1).otherwise(0) + F.when(docs[id_col].isNull(), 2).otherwise(0)
    narrow = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(0).cast("long")).alias("id"),
                         flags.cast("byte").alias("held"), docs[text_col].cast("string").alias("text"))
    chunks = ws.keep(narrow.mapInArrow(_chunks, _CHUNK), "chunks")
    sums = chunks.agg(F.sum("n_pairs"), F.sum("n_train"), F.max("chunk")).first()
    n_train = int(sums[1] or 0)
    buckets = max(1, int((sums[0] or 0) // BUCKET_PAIRS) + 1)
    asked = chunks.select("chunk", "held", "ends", "names", "tokens").mapInArrow(
        _asked(buckets), f"{_ASKED}, counts binary")
    path = ws.folder("state")
    state = ws.at(asked.groupBy("bucket").applyInArrow(_merged, _STATE), path)
    ws.release()

    def totals() -> Totals:
        rows = state.select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("v")).collect()
        values = dict((r["pos"], r["v"]) for r in rows)
        return Totals([values.get(k, 0.0) for k in range(7)])

    def contexts() -> DataFrame:
        reports = state.select("bucket", "contexts", "counts", "seats").mapInArrow(_reports(buckets), _TOTALS)
        return ws.keep(reports.groupBy("target").applyInArrow(_summed, _TOTALS), "contexts")

    now, told, samples, parts = totals(), contexts(), [], []
    for number in range(BURN + SAMPLES):
        new = ws.folder("state")
        replies = told.where("bucket is not null").select("bucket", "target", "tables")
        state = ws.at(state.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(_sweep(now, number), _STATE), new)
        storage.remove(spark, path)
        ws.drop(told)
        ws.release()
        path, now, told = new, totals(), contexts()
        if number >= BURN:
            sample = F.lit(len(samples)).alias("sample")
            parts.append(ws.keep(state.select("bucket", sample, "seats", "roots"), "sample"))
            # Which contexts a bucket holds, and their customers, are the same in every sample.
            named = ["heads", "customers"] if not samples else []
            parts.append(ws.keep(told.where("bucket is null").select(
                F.col("target").alias("bucket"), sample, *named, "tables"), "sums"))
            samples.append(now)
    ws.drop(told)
    ws.release()
    held = state.select("bucket", "names", "sizes", "contexts", "counts")
    for part in parts:
        held = held.unionByName(part, allowMissingColumns=True)
    again = chunks.select("chunk", "names", "tokens")
    # The chunks of whole tasks are scored together, so that few files of chunks are read in several turns.
    tasks, answers = 1 + (int(sums[2] or 0) >> 32), None
    bounds = [tasks * t // TURNS << 32 for t in range(TURNS + 1)]
    scored_in = sum((F.col("chunk") >= b).cast("int") for b in bounds[1:-1])
    for turn in range(TURNS):
        mine = F.col("bucket") % TURNS == turn
        found = again.mapInArrow(_asked(buckets, turn), _ASKED).groupBy("bucket").cogroup(held.where(mine).groupBy("bucket"))
        found = found.applyInArrow(_answers(samples), _ANSWERS).withColumn("turn", scored_in)
        found = ws.at(found, ws.folder("answers"), "turn")
        answers = found if answers is None else answers.unionByName(found)
        del found
        ws.release()
    for part in parts:
        ws.drop(part)
    storage.remove(spark, path)
    # Every chunk meets its answers alone: several of them in one batch would not fit the memory of a task.
    texts = chunks.select("chunk", "ids", "held", "ends", "names", "tokens")
    out = None
    for turn in range(TURNS):
        mine = (F.col("chunk") >= bounds[turn]) & (F.col("chunk") < bounds[turn + 1])
        told = answers.where(F.col("turn") == turn).drop("turn")
        scored = texts.where(mine).groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
            _scores(n_train, int(now.words), samples),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
        if turn < TURNS - 1:
            scored = ws.keep(scored, "scored")
        out = scored if out is None else out.unionByName(scored)
        del scored
        ws.release()
    return out
