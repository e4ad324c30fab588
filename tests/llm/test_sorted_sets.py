"""Distinct values by sorting, rows taken one at a time, and scratch tables that go when they were read."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegate import storage
from tidegate.llm import jaccard_join, pitman_yor, substring_dedup, words
from tidegate.llm.common import Workspace, pinned


@pytest.fixture
def no_hash_tables(monkeypatch):
    """numpy's own distinct values, where it puts them in a hash table."""
    unique = np.unique

    def refuse(*arrays, **options):
        raise AssertionError("a hash table of hashes")

    monkeypatch.setattr(np, "union1d", refuse)
    monkeypatch.setattr(np, "unique", lambda a, **options: unique(a, **options) if options else refuse())


def test_cuts_at_marks(no_hash_tables):
    texts = pa.array(["a,b c", "x", ",y", None, "", "don't (see) it."])
    (_, found), = words.words_of(texts)
    cut = words.cut_at_marks(found)
    pieces = [[bytes(cut.data[a:b]).decode() for a, b in zip(cut.starts[i:j], cut.ends[i:j])]
              for i, j in zip(cut.first[:-1], cut.first[1:])]
    assert pieces == [["a", ",", "b", "c"], ["x"], [",", "y"], [], [], ["don't", "(", "see", ")", "it", "."]]


def test_sets_of_texts(no_hash_tables):
    texts = ["b a b a b a b a", "", "one two", "a b c d e f g h a b c d e f g h", None, "b a b a b a"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for below in (1 << 64, 1 << 63):
        (row, n, doc, value), = jaccard_join._sets(batch, 0, 2, below)
        (_, found), = words.words_of(batch.column(0), fold=True)
        pairs = {(d, v) for d, v in zip(*(a.tolist() for a in words.shingles(found, 2))) if v < below}
        assert (row, n) == (0, 6) and list(zip(doc.tolist(), value.tolist())) == sorted(pairs)


def test_common_tokens_of_blocks(no_hash_tables):
    rng = np.random.default_rng(4)
    sets = [[np.sort(rng.choice(60, k, replace=False)).astype(np.uint64) for k in (5, 0, 30, 17)] for _ in range(2)]
    flat = [np.concatenate(s) for s in sets]
    counts = jaccard_join._grid_counts(flat[0], np.array([5, 0, 30, 17]), flat[1], np.array([5, 0, 30, 17]))
    assert counts.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[1]] for a in sets[0]]


def test_one_row_of_a_batch_is_made_at_a_time(monkeypatch):
    made = []

    class Watched:
        num_rows = 3

        def slice(self, k, n):
            made.append((k, n))
            return pa.table({"v": [k]})

    for want, row in enumerate(pitman_yor._rows(Watched())):
        assert row == {"v": want} and made[-1] == (want, 1) and len(made) == want + 1


def test_scratch_tables_of_removed_repeats_are_dropped(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(k, f"{k} {passage} {k}") for k in range(3)], "doc_id long, text string")
    ws = Workspace(spark, "test-substrings")
    spans = substring_dedup.repeated_windows(ws, pinned(ws, docs))
    left = [name for name in storage.children(spark, ws.path) if not name.endswith(("files", "input"))]
    assert [name.partition("-")[2] for name in left] == ["spans"]
    assert spans.select(F.size("spans")).count() == 3


@pytest.mark.parametrize("size", [3, 400])
def test_sets_come_in_slices_that_fit_a_cache(size):
    rng = np.random.default_rng(size)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 50, rng.integers(0, 2 * size))) for _ in range(2_000_000 // (size * 4))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    (first, *more), n = list(jaccard_join._sets(batch, 0, 5)), 0
    assert more and (sum(map(len, texts[:first[1]])) <= jaccard_join.SLICE)
    for row, texts_of_slice, doc, value in (first, *more):
        order = np.lexsort((value, doc))
        assert (order == np.arange(len(doc))).all()
        assert row == n
        n += texts_of_slice
    assert n == len(texts)
    doc, value = (np.concatenate(a) for a in zip(*((row + doc, value) for row, _, doc, value in (first, *more))))
    (_, found), = words.words_of(pa.array(texts), fold=True, size=1 << 40)
    whole = sorted(set(zip(*(a.tolist() for a in words.shingles(found, 5)))))
    assert list(zip(doc.tolist(), value.tolist())) == whole


@pytest.mark.parametrize("n", [1, 5, 3000])
def test_frequent_tokens_are_told_apart(n):
    rng = np.random.default_rng(n)
    known = words.distinct(np.append(rng.integers(0, 2**64, n, dtype=np.uint64), np.uint64(2**64 - 1)))
    values = np.concatenate([known, known + np.uint64(1), known - np.uint64(1), rng.integers(0, 2**64, 5000, dtype=np.uint64)])
    assert (jaccard_join._among(known)(values) == np.isin(values, known)).all()
