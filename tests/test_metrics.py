"""Counters and insert times against a direct model."""

import random

import pytest

from tidegate.operators import metrics
from tidegate.operators.metrics import insert_times_final, insert_times_running, write_counters


def model(durations, span=10_001):
    """(min, max, average) after every non-zero duration."""
    out, lo, hi, kept, total = [], None, None, [], 0
    for d in durations:
        if d == 0:
            continue
        if lo is None:
            lo = hi = d
            out.append((lo, hi, d))
            continue
        lo, hi = min(lo, d), max(hi, d)
        kept.append(d)
        total += d
        if len(kept) > span:
            total -= kept[-span - 1]
        out.append((lo, hi, total // min(len(kept), span)))
    return out


def check(spark, per_channel, span=10_001):
    rows = [(c, i, d) for c, ds in per_channel.items() for i, d in enumerate(ds)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "channel bigint, seq bigint, duration_ms bigint")
    got = {}
    for r in insert_times_running(df).collect():
        got.setdefault(r.channel, []).append((r.seq, r.t_min, r.t_max, r.t_avg))
    final = {r.channel: (r.t_min, r.t_max, r.t_avg) for r in insert_times_final(df).collect()}
    expected = {c: model(ds, span) for c, ds in per_channel.items() if any(ds)}
    assert {c: [x[1:] for x in sorted(v)] for c, v in got.items()} == expected
    assert final == {c: v[-1] for c, v in expected.items()}


def test_long_series_exceeds_the_span(spark):
    rnd = random.Random(42)
    check(spark, {0: [rnd.choice([0, rnd.randint(1, 5000)]) for _ in range(40_000)],
                  1: [rnd.randint(1, 9) for _ in range(10_003)]})


@pytest.mark.parametrize("span", [1, 2, 5])
def test_short_spans(spark, monkeypatch, span):
    monkeypatch.setattr(metrics, "AVERAGE_SPAN", span)
    rnd = random.Random(span)
    check(spark, {c: [rnd.randint(0, 7) for _ in range(rnd.randint(1, 60))] for c in range(6)}, span)


def test_edges(spark):
    check(spark, {0: [0, 0, 7], 1: [0], 2: [5, 1], 3: [1, 2, 2], 4: [10 ** 12, 10 ** 12 - 1, 10 ** 12 - 2]})


def test_counters(spark):
    log = spark.createDataFrame(
        [(0, True, 50), (0, False, 50), (0, True, 5), (1, False, 7)],
        "channel bigint, ok boolean, n_rows bigint")
    assert {tuple(r) for r in write_counters(log).collect()} == {(0, 2, 1, 55, 50), (1, 0, 1, 0, 7)}
