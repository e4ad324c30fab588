"""The stage that looks at pairs of different classes, block against block."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import jaccard_join
from tidegate.llm.common import Workspace
from tidegate.llm.components import components


def test_common_tokens_of_blocks():
    rng = np.random.default_rng(5)
    near = rng.integers(0, 2**63, 9000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    sets = [np.sort(rng.choice(near, size, replace=False)) for size in (1, 4, 300, 8999, 9000, 9000, 50, 50)]
    sets += [np.sort(rng.integers(0, 2**63, 40).astype(np.uint64)), np.array([0, 2**64 - 1], np.uint64)]
    sizes, tokens = np.array([len(s) for s in sets]), np.concatenate(sets)
    found = jaccard_join._grid_counts(tokens, sizes, tokens, sizes)
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets]


def test_links_of_two_blocks_are_those_of_their_sets():
    """Through the arrays that travel: candidates, the sets they need, a link for every two classes."""
    rng = random.Random(9)
    base = [rng.getrandbits(63) for _ in range(60)]
    sets = [np.sort(np.array(rng.sample(base, rng.randint(40, 60)), np.uint64)) for _ in range(30)]
    comps = [k // 3 for k in range(30)]

    def side(members):
        rows = [100 + k for k in members]
        tokens = b"".join(sets[k].tobytes() for k in members)
        sizes = [len(sets[k]) for k in members]
        lists = [rows, sizes, [comps[k] for k in members], rows, [0.0] * len(members), sizes]
        return [pa.array([v]) for v in lists] + [pa.array([tokens], pa.binary())], rows, sizes, tokens

    (x, *whole_x), (y, *whole_y) = side(range(15)), side(range(15, 30))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), *x, *y], [f"c{k}" for k in range(16)])
    wanted = next(iter(jaccard_join._candidates(75)([batch])))

    def whole(rows, sizes, tokens):
        kept = [k for k, r in enumerate(rows) if r in set(wanted["used"][0].as_py())]
        sets_of = np.split(np.frombuffer(tokens, np.uint64), np.cumsum(sizes)[:-1])
        return [pa.array([kept], pa.list_(pa.int32())), pa.array([[rows[k] for k in kept]]),
                pa.array([[sizes[k] for k in kept]], pa.list_(pa.int32())),
                pa.array([b"".join(sets_of[k].tobytes() for k in kept)], pa.binary())]

    given = pa.RecordBatch.from_arrays([wanted["y"], wanted["pairs"], wanted["kinds"], *whole(*whole_x)], list("ypkprst"))
    trimmed = next(iter(jaccard_join._needed([given])))
    both = pa.RecordBatch.from_arrays([*trimmed.columns[1:], *whole(*whole_y)], list("pkrstabcd"))
    found = next(iter(jaccard_join._links_of_blocks(75)([both]))).to_pydict()
    links = defaultdict(list)
    for i in range(15):
        for j in range(15, 30):
            common = len(np.intersect1d(sets[i], sets[j]))
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                links[comps[i], comps[j]].append((100 + i, 100 + j))
    got = list(zip(found["a"], found["b"]))
    assert len(got) == len(links) > 0
    assert all(any(pair in got for pair in pairs) for pairs in links.values())


@pytest.mark.parametrize("short", [1, 8])
def test_many_classes_just_apart(spark, monkeypatch, short):
    """A group of near copies whose pairs lie on both sides of the bound, over many small blocks."""
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 1)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for _ in range(40):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(60)] = f"x{rng.randrange(30)}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k:k + 5]) for k in range(56)} for t in texts]
    least = list(range(40))
    for _ in range(40):
        for i in range(40):
            for j in range(40):
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    least[i] = min(least[i], least[j])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(df).collect()}
    assert got == dict(enumerate(least))


def test_pairs_of_blocks_name_the_sets_they_need_in_two_rows():
    size = jaccard_join.BLOCK_SETS
    pairs = [0 * size + 5, 63 * size + 64, 64 * size + 127, 127 * size + 5]
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([9]), pa.array([pairs], pa.list_(pa.int32()))], list("xyp"))
    found = [r for b in jaccard_join._used([batch]) for r in b.to_pylist()]
    named = {r["block"]: {k for k in range(128) if (r["low"], r["high"])[k // 64] >> k % 64 & 1} for r in found}
    assert len(found) == 2 and named == {7: {0, 63, 64, 127}, 9: {5, 64, 127}}


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_few_blocks_are_part_filled_however_many_partitions(spark, monkeypatch, many_partitions):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 1)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    places, exact = [], jaccard_join.JaccardJoin.exact

    def spied(self, place, pairs):
        places.append(sorted(r["count"] for r in place.groupBy("block").count().collect()))
        return exact(self, place, pairs)

    monkeypatch.setattr(jaccard_join.JaccardJoin, "exact", spied)
    rng = random.Random(6)
    texts = [" ".join([f"w{k}" for k in range(20)] + [f"x{rng.randrange(10**6)}" for _ in range(60)]) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicates(df).collect()} == {(k, k) for k in range(50)}
    assert sum(places[0]) > 16 and sum(n < 8 for n in places[0]) <= 2


def test_rounds_of_components_pass_few_files_on(spark, many_partitions):
    ws = Workspace(spark, "test-components")
    edges = ws.keep(spark.createDataFrame([(k, k + 1) for k in range(300) if k % 10 != 9], "a long, b long"), "given")
    found = components(ws, edges)
    assert sorted(map(tuple, found.collect())) == [(k, k - k % 10) for k in range(300)]
    assert len(found.inputFiles()) == 1
