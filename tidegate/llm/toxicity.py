"""Toxicity by a gapped-subsequence string kernel with Nystroem landmarks and a linear SVM.

The kernel of two words counts common subsequences of three symbols, each weighted by
LAMBDA to the power of the length it spans on either side, and is normalised; letters put
between others widen the span and lower, but don't lose, the match. Symbols are folded
bytes: digits and signs that stand for letters count as those, other signs as gaps. Runs
of single characters are read as one word too.

Training takes a bounded sample of labelled documents. Words over-represented in toxic
documents give candidates; landmarks are taken from them and from frequent neutral words.
Sentences are the labelled instances: a toxic sentence is represented by its witness, its
strongest word, a clean one by all its words. A squared-hinge SVM on the Nystroem features
is fitted and the witnesses are chosen anew a few times. As the kernel's feature map is
explicit, the machine folds into one table of weights by symbol triple, which scores a
word in a few hundred look-ups, exactly as the landmarks would. A document's score is a
logistic function of its strongest words, so that neither length nor position matters.

Defined results: labels that contradict each other count as toxic; NULL and empty texts
get the score of a document without words; without labels of both classes every score
is 0; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import words_of

#: Bound of the training sample, by label: the documents with the smallest hash of their id.
SAMPLE = {1: 1500, 0: 3000}
LAMBDA, LONGEST = 0.6, 24
LANDMARKS = {"toxic": 64, "neutral": 32}
ROUNDS = 3
TOP = 3
#: Scores of words below this are all alike.
LOWEST = -0.5
CACHE_WORDS = 400_000

_ALPHABET = 64
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27 + np.arange(128) % 36
# Characters that commonly stand for letters.
for _sign, _letter in {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}.items():
    _CLASS[ord(_sign)] = _CLASS[ord(_letter)]


@lru_cache(maxsize=None)
def _triples(length: int) -> tuple[np.ndarray, ...]:
    i, j, k = (x.ravel() for x in np.meshgrid(*[np.arange(length)] * 3, indexing="ij"))
    ok = (i < j) & (j < k)
    return i[ok], j[ok], k[ok], (LAMBDA ** (k - i + 1)[ok]).astype(np.float32)


def _codes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triple numbers and weights of each row; 0 where a gap symbol takes part."""
    i, j, k, weight = _triples(symbols.shape[1])
    a, b, c = symbols[:, i], symbols[:, j], symbols[:, k]
    return np.where((a > 0) & (b > 0) & (c > 0), (a * _ALPHABET + b) * _ALPHABET + c, 0).astype(np.int32), weight


def _norms(symbols: np.ndarray) -> np.ndarray:
    """Root of the kernel of each row with itself."""
    n, length = symbols.shape
    lam2 = np.float32(LAMBDA * LAMBDA)
    same = (symbols[:, :, None] == symbols[:, None, :]) & (symbols[:, :, None] > 0)
    prefix = np.ones((length + 1, length + 1, n), dtype=np.float32)
    for _ in range(2):
        new = np.zeros_like(prefix)
        for x in range(1, length + 1):
            along = np.zeros(n, dtype=np.float32)
            for y in range(1, length + 1):
                along = along * np.float32(LAMBDA) + np.where(same[:, x - 1, y - 1], lam2 * prefix[x - 1, y - 1], 0)
                new[x, y] = np.float32(LAMBDA) * new[x - 1, y] + along
        prefix = new
    total = np.zeros(n, dtype=np.float32)
    for x in range(1, length + 1):
        for y in range(1, length + 1):
            total += np.where(same[:, x - 1, y - 1], lam2 * prefix[x - 1, y - 1], 0)
    return np.sqrt(np.maximum(total, 1e-12))


def _matrices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(rows, symbols) by length; longer words give overlapping windows."""
    rows = np.arange(len(starts))
    sizes = ends - starts
    long = np.flatnonzero(sizes > LONGEST)
    if len(long):
        extra = [(r, s) for r in long.tolist()
                 for s in range(int(starts[r]), int(ends[r]) - LONGEST // 2, LONGEST // 2)]
        rows = np.concatenate([rows[sizes <= LONGEST], np.array([r for r, _ in extra])])
        starts = np.concatenate([starts[sizes <= LONGEST], np.array([s for _, s in extra])])
        sizes = np.minimum(ends[rows] - starts, LONGEST)
    for low, high in ((2, 6), (6, 9), (9, 12), (12, 16), (16, LONGEST)):
        of = np.flatnonzero((sizes > low) & (sizes <= high))
        for part in np.array_split(of, -(-len(of) // 4096)) if len(of) else ():
            at = starts[part][:, None] + np.arange(high)
            inside = np.arange(high) < sizes[part][:, None]
            yield rows[part], np.where(inside, _CLASS[data[np.minimum(at, len(data) - 1)]], 0)


def _from_strings(units: list[str]):
    parts = [u.encode() for u in units]
    ends = np.cumsum([len(p) for p in parts])
    return np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends


class Machine:
    """A table of triple weights with a bias, and the logistic document model."""

    def __init__(self, table: np.ndarray, bias: float, document: np.ndarray):
        self.table, self.bias, self.document = table.astype(np.float32), np.float32(bias), document

    def words(self, data, starts, ends) -> np.ndarray:
        out = np.full(len(starts), LOWEST, dtype=np.float32)
        for rows, symbols in _matrices(data, starts, ends):
            codes, weight = _codes(symbols)
            raw = self.table[codes] @ weight
            # The norm is at least that of distinct triples; below LOWEST a word counts as LOWEST.
            least = np.sqrt((codes > 0) @ (weight * weight)) + 1e-6
            hit = np.flatnonzero(raw / least + self.bias > LOWEST)
            value = np.full(len(rows), LOWEST, dtype=np.float32)
            if len(hit):
                value[hit] = np.maximum(raw[hit] / _norms(symbols[hit]) + self.bias, LOWEST)
            np.maximum.at(out, rows, value)
        return out

    def documents(self, tops: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Scores from each document's TOP word scores and its number of words above 0."""
        x = np.column_stack([np.ones(len(tops)), tops, np.log1p(hits)])
        return 1 / (1 + np.exp(-np.clip(x @ self.document, -30, 30)))


def _kernel(units: list[str], landmarks: list[str]) -> np.ndarray:
    out = np.zeros((len(units), len(landmarks)))
    tables = [_table([m], [1.0]) for m in landmarks]
    for rows, symbols in _matrices(*_from_strings(units)):
        codes, weight = _codes(symbols)
        norms = _norms(symbols)
        for m, table in enumerate(tables):
            value = (table[codes] @ weight) / norms
            np.maximum.at(out[:, m], rows, value)
    return out


def _table(landmarks: list[str], weights) -> np.ndarray:
    """Weights by triple of a sum of normalised landmarks."""
    table = np.zeros(_ALPHABET ** 3, dtype=np.float32)
    for rows, symbols in _matrices(*_from_strings(landmarks)):
        codes, weight = _codes(symbols)
        norms = _norms(symbols)
        for r, code, norm in zip(rows, codes, norms):
            np.add.at(table, code, (weight * (weights[r] / norm)).astype(np.float32))
    table[0] = 0
    return table


def units_of(text: str) -> list[list[str]]:
    """Sentences of a text as lists of folded words."""
    out = []
    for sentence in re.split(r"(?<=[.!?])\s+|\n+", text or ""):
        found = [w.lower().strip(".,;:!?\"'()[]") for w in sentence.split()]
        run = []
        for w in [*found, "--"]:
            if len(w) == 1:
                run.append(w)
                continue
            if len(run) >= 3:
                found.append("".join(run))
            run = []
        if found:
            out.append([w for w in found if 3 <= len(w) <= LONGEST])
    return out


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Primal L2-SVM by Newton's method; the last column of x is the bias."""
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge
    keep[-1, -1] = 1e-6
    for _ in range(50):
        on = y * (x @ w) < 1
        xs = x[on] * weight[on][:, None]
        new = np.linalg.solve(keep + x[on].T @ xs, xs.T @ y[on])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(x.shape[1]) * 1e-2
        step = np.linalg.solve(slope, x.T @ (weight * (y - p)) - 1e-2 * w)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(texts: list[str], labels: list[int], toxic_share: float) -> Machine | None:
    """Fit the machine to labelled texts; None without texts of both classes."""
    n_toxic = sum(labels)
    n_clean = len(labels) - n_toxic
    if not n_toxic or not n_clean:
        return None
    split = [units_of(t) for t in texts]
    seen = {0: Counter(), 1: Counter()}
    for sentences, label in zip(split, labels):
        seen[label].update({u for s in sentences for u in s})
    odds = {u: np.log((c + 0.5) / n_toxic) - np.log((seen[0][u] + 0.5) / n_clean) for u, c in seen[1].items()}
    ranked = sorted(odds, key=lambda u: (-seen[1][u] * max(odds[u], 0.0), u))
    ranked = [u for u in ranked if odds[u] > np.log(4) and seen[1][u] >= 3][:4 * LANDMARKS["toxic"]] or ranked[:8]
    landmarks: list[str] = []
    similar = _kernel(ranked, ranked)
    taken: list[int] = []
    for i in range(len(ranked)):
        if len(taken) < LANDMARKS["toxic"] and all(similar[i, j] < 0.9 for j in taken):
            taken.append(i)
    landmarks = [ranked[i] for i in taken]
    landmarks += [u for u, _ in sorted(seen[0].items(), key=lambda e: (-e[1], e[0]))
                  if len(u) >= 4 and u not in landmarks][:LANDMARKS["neutral"]]

    # The Nystroem map from kernel values to features.
    values, vectors = np.linalg.eigh(_kernel(landmarks, landmarks) + 1e-6 * np.eye(len(landmarks)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    clean = sorted(seen[0], key=lambda u: (-seen[0][u], u))
    clean = clean[:6000] + [u for u in clean[6000:] if hash_rank(u) < 6000 / max(len(clean), 1)]
    x_clean = _kernel(clean, landmarks) @ root
    strong = {u: odds[u] * np.log1p(seen[1][u]) for u in odds if odds[u] > np.log(4) and seen[1][u] >= 3}
    witness = []
    for sentences, label in zip(split, labels):
        if label:
            best = [max(s, key=lambda u: strong.get(u, 0.0)) for s in sentences if s]
            witness += [u for u in best if strong.get(u, 0.0) > 0]
    machine = None
    for _ in range(ROUNDS):
        counts = Counter(witness)
        names = sorted(counts)
        if not names:
            break
        x = np.vstack([_kernel(names, landmarks) @ root, x_clean])
        x = np.column_stack([x, np.ones(len(x))])
        y = np.concatenate([np.ones(len(names)), -np.ones(len(clean))])
        weight = np.concatenate([np.log1p([counts[u] for u in names]), np.log1p([seen[0][u] for u in clean])])
        w = _squared_hinge(x, y, weight)
        machine = Machine(_table(landmarks, root @ w[:-1]), w[-1], np.zeros(TOP + 2))
        # The strongest word of each toxic document's sentences, if the machine finds one.
        witness = []
        flat = sorted(seen[1])
        score = dict(zip(flat, machine.words(*_from_strings(flat)).tolist()))
        for sentences, label in zip(split, labels):
            if label:
                best = [max(s, key=lambda u: score[u]) for s in sentences if s]
                witness += [u for u in best if score[u] > 0]
    if machine is None:
        return None
    found = list(_scored(pa.array(texts, pa.string()), machine, {}))
    tops, hits = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    x = np.column_stack([np.ones(len(tops)), tops, np.log1p(hits)])
    y = np.array(labels, dtype=float)
    balance = np.where(y == 1, toxic_share * len(y) / n_toxic, (1 - toxic_share) * len(y) / n_clean)
    machine.document = _logistic(x, y, balance)
    return machine


def hash_rank(unit: str) -> float:
    """A fixed number from 0 to 1 for a word."""
    import zlib

    return zlib.crc32(unit.encode()) / 2**32


def _spelled(words) -> list[tuple[int, bytes]]:
    """(text, joined bytes) of runs of three or more single characters."""
    single = (words.ends - words.starts) == 1
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    doc = words.doc_of()
    out = []
    long = np.flatnonzero(edge[1::2] - edge[::2] >= 3)
    for a, b in zip(edge[::2][long].tolist(), edge[1::2][long].tolist()):
        for d in np.unique(doc[a:b]).tolist():
            lo, hi = max(a, int(words.first[d])), min(b, int(words.first[d + 1]))
            if hi - lo >= 3:
                out.append((d, words.data[words.starts[lo:hi]].tobytes()))
    return out


def _scored(texts: pa.Array, machine: Machine, cache: dict):
    """(top word scores, number of words above 0) for slices of the texts."""
    for _, words in words_of(texts, fold=True):
        n = len(words.first) - 1
        distinct, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        keys, known = cache.get("keys", np.zeros(0, np.uint64)), cache.get("known", np.zeros(0, np.float32))
        if len(keys) > CACHE_WORDS:
            keys, known = keys[:0], known[:0]
        at = np.searchsorted(keys, distinct)
        at[at == len(keys)] = 0
        new = keys[at] != distinct if len(keys) else np.ones(len(distinct), bool)
        if new.any():
            places = first[new]
            keys = np.concatenate([keys, distinct[new]])
            known = np.concatenate([known, machine.words(words.data, words.starts[places], words.ends[places])])
            order = np.argsort(keys)
            keys, known = keys[order], known[order]
            cache["keys"], cache["known"] = keys, known
            at = np.searchsorted(keys, distinct)
        score, doc = known[at][back] if len(distinct) else np.zeros(0, np.float32), words.doc_of()
        spelled = _spelled(words)
        if spelled:
            joined = b"".join(s for _, s in spelled)
            ends = np.cumsum([len(s) for _, s in spelled])
            extra = machine.words(np.frombuffer(joined, np.uint8), ends - [len(s) for _, s in spelled], ends)
            score, doc = np.append(score, extra), np.append(doc, [d for d, _ in spelled])
        tops = np.full((n, TOP), LOWEST)
        above = np.flatnonzero(score > LOWEST)
        score, doc = score[above], doc[above]
        order = np.lexsort((-score, doc))
        start = np.searchsorted(doc[order], np.arange(n))
        size = np.diff(np.append(start, len(order)))
        for k in range(TOP):
            has = size > k
            tops[has, k] = score[order[start[has] + k]]
        yield tops, np.bincount(doc[score > 0], minlength=n)[:n]


def _score(machine: Machine | None):
    def run(batches):
        cache: dict = {}
        for batch in batches:
            if machine is None:
                score = np.zeros(batch.num_rows)
            else:
                parts = list(_scored(batch.column(2), machine, cache))
                score = np.concatenate([machine.documents(t, h) for t, h in parts]) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    return run


def held_out(doc_id, modulus: int, remainder: int):
    """Whether crc32 of the id as text leaves the remainder; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def fit(docs: DataFrame, labels: DataFrame, sample: dict[int, int] = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Machine | None:
    """Train on the labelled documents outside the held-out fold."""
    marked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))
              .where(~held_out(F.col("_id"), 5, 0)).where("_label in (0, 1)"))
    counts = {r["_label"]: r["n"] for r in marked.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    chosen = None
    for label, most in sample.items():
        part = marked.where(F.col("_label") == label).orderBy(F.xxhash64("_id"), "_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
            .join(F.broadcast(chosen), "_id").orderBy(F.xxhash64("_id"), "_id").limit(sum(sample.values())).collect())
    return train([r["_text"] or "" for r in rows], [r["_label"] for r in rows], counts[1] / (counts[0] + counts[1]))


def score_documents(docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), held_out(docs[id_col], 5, 0).alias("held_out"),
                         docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(_score(machine), "doc_id long, held_out boolean, score double, predicted int")
