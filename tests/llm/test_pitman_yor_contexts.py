"""The restaurants of single words: each previous word has one of its own."""

import zlib
from itertools import count

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import pitman_yor


def _ids(held_out):
    return (i for i in count() if (zlib.crc32(str(i).encode()) % 7 == 2) == held_out)


@pytest.mark.parametrize("pairs", [500_000, 40])
def test_words_that_end_alike_have_contexts_of_their_own(spark, monkeypatch, pairs):
    monkeypatch.setattr(pitman_yor, "BUCKET_PAIRS", pairs)
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 300)
    train, out = _ids(False), _ids(True)
    rows = [(next(train), f"{a}ing {b}") for _ in range(40) for a, b in (("sail", "boats"), ("read", "books"))]
    rows += [(next(train), f"w{k} v{k}ing x{k}") for k in range(100)]
    asked = {text: next(out) for text in ("sailing boats", "sailing books", "reading books", "reading boats")}
    rows += [(i, text) for text, i in asked.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    score = {r.doc_id: r.score for r in pitman_yor.score_texts(df).collect()}
    score = {text: score[i] for text, i in asked.items()}
    assert score["sailing boats"] > score["sailing books"] + 1
    assert score["reading books"] > score["reading boats"] + 1


def test_pairs_of_tokens():
    rng = np.random.default_rng(2)
    tokens = rng.choice(np.append(rng.integers(0, 2**63, 20).astype(np.uint64), pitman_yor._END), 500)
    tokens[-1] = pitman_yor._END
    names, token = np.unique(tokens, return_inverse=True)
    words, contexts, pair = pitman_yor.pairs_of(names, token)
    assert (np.diff(words) >= 0).all()
    found = list(zip(names[words[pair]].tolist(), names[contexts[pair]].tolist()))
    assert found == list(zip(tokens.tolist(), [int(pitman_yor._END), *tokens[:-1].tolist()]))
    assert len(words) == len(set(found))


def test_leading_bytes_of_hashes():
    heads = np.array([0, 1, 255, 2**40 - 1, 2**39 + 7], np.uint64)
    assert pitman_yor._from_short(pitman_yor._short(heads)).tolist() == heads.tolist()


def test_a_chunk_meets_its_answers_alone(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 5)
    df = spark.createDataFrame([(i, f"some words of text {i}") for i in range(30)], "doc_id long, text string").coalesce(1)
    found = pitman_yor.score_texts(df)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan
    assert sorted(r.doc_id for r in found.collect()) == list(range(30))


def test_each_turn_asks_its_buckets_once():
    rng = np.random.default_rng(4)
    tokens = np.append(rng.choice(rng.integers(0, 2**64, 90, dtype=np.uint64), 600), pitman_yor._END)
    names, token = np.unique(tokens, return_inverse=True)
    chunk = pa.RecordBatch.from_pydict({
        "chunk": [7], "held": [np.zeros(1, np.uint8).tobytes()], "ends": [np.array([len(tokens)], np.int64).tobytes()],
        "names": [names.tobytes()], "tokens": [pitman_yor._planes(token)]})
    rows = lambda *turn: [r for b in pitman_yor._asked(7, *turn)([chunk]) for r in b.to_pylist()]
    whole = {r["bucket"]: {c: r[c] for c in ("names", "sizes", "contexts")} for r in rows()}
    asked = [rows(turn) for turn in range(pitman_yor.TURNS)]
    assert [{r["bucket"] % pitman_yor.TURNS for r in part} for part in asked] == [{t} for t in range(pitman_yor.TURNS)]
    asked = [r for part in asked for r in part]
    assert len(asked) == len(whole)
    assert {r["bucket"]: {c: r[c] for c in ("names", "sizes", "contexts")} for r in asked} == whole


def test_chunks_are_scored_in_turns(spark, monkeypatch):
    kept, keep = [], pitman_yor.Workspace.keep

    def seen(ws, df, name, **options):
        kept.append((name, df))
        return keep(ws, df, name, **options)

    monkeypatch.setattr(pitman_yor.Workspace, "keep", seen)
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 50)
    df = spark.range(300).selectExpr("id doc_id", "concat('a b ', id % 7, ' c ', id) text").repartition(6)
    found = pitman_yor.score_texts(df).collect()
    assert [name for name, _ in kept].count("scored") == pitman_yor.TURNS - 1
    assert sorted(r.doc_id for r in found) == list(range(300))
