"""The operators against brute force on small tables with NULLs, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import (ann, host_rules, jaccard_join, line_dedup, mixing, packing, pitman_yor, sharding,
                          substring_dedup, toxicity)
from tidegate.llm.queries import TOKENIZER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, gap string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    names = [a + b for a in "ka lo mi tu re".split() for b in "nar sel tib vox".split()]
    line = lambda n: " ".join(rng.choice(names) + rng.choice(["", ",", "."]) for _ in range(n))
    base = "\n".join(line(30) for _ in range(8))
    near = base.split(" ")
    near[40] = "CHANGED"
    passage = line(60)
    texts = [base, base, " ".join(near), None, "", " \n\t ", "one", "one", "a b c d", "A b c d"]
    texts += [line(10) + " " + passage + "\n" + line(rng.randint(5, 90)) for _ in range(8)]
    texts += [line(rng.randint(1, 200)) for _ in range(10)] + [" ".join(["la"] * 90), line(6000), "x" * 5000]
    texts += ["\n".join(line(4) for _ in range(12)) + "\n" + base.split("\n")[3]]
    out = [(i, t, "en", ["s", "ß", None, "t"][i % 4], len(t or ""), i, "g") for i, t in enumerate(texts)]
    return out + [out[0], (None, "null id text with seven words here", None, None, 3, 1, None)]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def test_permutation_is_a_bijection_with_an_inverse():
    for n in (1, 2, 3, 5, 64, 1000):
        there = sharding.permute(np.arange(n), n)
        assert sorted(there) == list(range(n))
        assert (sharding.invert(there, n) == np.arange(n)).all()


def test_shards(docs, rows, none):
    found = sharding.shard_rows(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in rows)
    sizes = Counter(r.shard for r in found)
    assert max(sizes.values()) - min(sizes[s] for s in range(16)) <= 1
    for s in range(16):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))
    assert sharding.shard_rows(none).count() == 0


def test_row_keys_hold_however_a_scan_is_split(spark, rows, docs, tmp_path):
    from tidegate.llm.common import ROW, Workspace, keyed, pinned

    texts = docs.select("doc_id", "text")
    path = str(tmp_path / "t")
    docs.write.json(path)
    twice = spark.read.parquet(*docs.inputFiles(), *docs.inputFiles())
    for given in (docs, texts.distinct(), spark.read.schema(docs.schema).json(path), twice):
        table, found = pinned(Workspace(spark, "keys"), given), []
        for size, least in (("128m", "1"), ("1k", "64")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            spark.conf.set("spark.sql.files.minPartitionNum", least)
            try:
                found.append(sorted(map(tuple, keyed(table, F.col("doc_id"), F.col("text")).collect()), key=lambda r: r[0]))
            finally:
                for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
                    spark.conf.unset(f"spark.sql.files.{name}")
        assert found[0] == found[1] and len({r[0] for r in found[0]}) == len(found[0]) == given.count()


def test_host_rules(docs, rows, none):
    found = host_rules.judge(docs).collect()
    expected = []
    for d in rows:
        w = words_of(d[1])
        twice = Counter(zip(w, w[1:], w[2:]))
        covered = {j for k in range(len(w) - 2) if twice[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)}
        lines = [s for s in (d[1] or "").split("\n") if words_of(s)]
        expected.append((d[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", d[1] or "")),
                         len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in found) == Counter(expected)
    assert all(r.kept == (not r.base_failed and r.host_ok) for r in found)
    assert host_rules.keep_good(docs).columns == docs.columns
    assert host_rules.judge(none).count() == host_rules.keep_good(none).count() == 0


def test_a_bad_host_loses_its_good_documents_and_small_ones_are_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good if i % 10 else "short", "clean") for i in range(200)] + [(1000 + i, "short" if i % 10 else good, "bad")
                                                                              for i in range(200)]
    rows += [(2000, "short", "tiny"), (2001, good, "tiny")]
    found = {r.doc_id: r for r in host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert found[1].kept and not found[1000].kept and found[1000].base_failed is False


def test_junk_goes_from_mixed_hosts_and_their_clean_documents_stay(spark):
    good = " ".join(f"word{i}" for i in range(60))
    signs, long = good + " #$%&" * 5, good.replace("word", "w" * 20)
    lines = "\n".join([good, *["the same line again"] * 4])
    rows = [(i, good, "mixed") for i in range(200)]
    rows += [(300, signs, "mixed"), (301, long, "mixed"), (302, lines, "mixed"), (303, signs, "tiny"), (304, good, "tiny")]
    rows += [(400 + i, signs if i % 5 < 2 else good, "code") for i in range(200)] + [(700, long, "code"), (701, lines, None)]
    judged = host_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    found = {r.doc_id: r for r in judged}
    assert all(r.host_ok and not r.base_failed for r in judged)
    assert all(found[i].kept for i in (*range(200), 304, *range(400, 600)))   # signs are normal for the host code
    assert not any(found[i].kept for i in (300, 301, 302, 303, 700, 701))


def test_mixing_meets_the_targets(docs, rows, none):
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows) and all(r.taken <= 3 * r.size for r in found)
    assert mixing.mix(none).count() == 0
    again = mixing.mix(docs).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.size, r.taken)
    assert sorted(map(key, found), key=repr) == sorted(map(key, again), key=repr)
    taken, target = Counter(), {}
    for r in found:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    largest = max(r.size for r in found)
    assert all(abs(taken[s] - t) <= largest for s, t in target.items())
    total = sum(len(words_of(d[1])) for d in rows)
    assert math.isclose(sum(target.values()), total)


def test_line_alignment():
    assert line_dedup.patience([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]
    assert line_dedup.patience([1, None, 2], [1, None, 2]) == [(0, 0), (2, 2)]
    assert line_dedup.patience([1, 2, 3], [3, 1, 2]) == [(0, 1), (1, 2)]
    assert line_dedup.patience([], [1]) == []


def test_line_dedup(docs, none):
    kept = line_dedup.without_repeated_lines(docs)
    assert kept.columns == docs.columns
    texts = defaultdict(list)
    for r in kept.collect():
        texts[r.doc_id].append(r.text)
    assert len(texts[0]) == 1 and texts[0][0].count("\n") == 7    # first copy whole, repeated row gone
    assert 1 not in texts and texts[3] == [None] and texts[4] == [""]
    assert texts[2][0].count("\n") == 0                          # only the changed line is left
    assert line_dedup.dedup_lines(none).count() == 0


def brute_line_dedup(rows):
    """(doc_id, lines, deleted, text left): every document aligned with all earlier ones that share a line."""
    split = [(d[1] or "").split("\n") for d in rows]
    named = [[s if words_of(s) else None for s in lines] for lines in split]
    out = []
    for k, lines in enumerate(named):
        gone = {j for e in range(k) if set(named[e]) & set(lines) - {None} for _, j in line_dedup.patience(named[e], lines)}
        left = "\n".join(s for j, s in enumerate(split[k]) if j not in gone)
        out.append((rows[k][0], len(lines), len(gone), left))
    return Counter(out)


def test_lines_are_aligned_with_every_earlier_holder(spark):
    rng = random.Random(7)
    rows = [(1, "x\ny"), (2, "q\ny"), (3, "y\nx"), (4, "z\ny"), (5, "y\nx\nz")]     # x goes from 3 by 1, y by 2
    rows += [(10 + i, "\n".join(rng.choice("abcdefghijklmnopqrstuv ") for _ in range(rng.randint(1, 12)))) for i in range(60)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r.doc_id, r["__tidegate_lines"], r["__tidegate_gone"], r.text) for r in found) == brute_line_dedup(rows)
    assert {r.doc_id: r.text for r in found}[3] == ""


def test_ranges_without_unique_lines_are_aligned():
    assert line_dedup.patience([7, 1, 2, 1, 2, 8], [9, 2, 1, 2, 6]) == [(2, 1), (3, 2), (4, 3)]
    assert [i for i, _ in line_dedup.patience([5, None, 5, None], [None, 5, 6, None, 5, 5])] == [0, 2]


def brute_sets(rows):
    fold = lambda t: re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    out = []
    for d in rows:
        w = words_of(fold(d[1]))
        out.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def test_jaccard_join(docs, rows, none):
    sets, parent = brute_sets(rows), list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    names = defaultdict(list)
    for i, d in enumerate(rows):
        names[find(i)].append(d[0])
    least = {k: min((v for v in ids if v is not None), default=None) for k, ids in names.items()}
    expected = Counter((d[0], len(sets[i]), least[find(i)]) for i, d in enumerate(rows))
    assert Counter(map(tuple, jaccard_join.near_duplicates(docs).collect())) == expected
    stay = jaccard_join.one_of_each(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len({find(i) for i in range(len(rows))})
    assert jaccard_join.near_duplicates(none).count() == 0


def brute_removed(rows, window):
    split = [words_of(d[1]) for d in rows]
    seen = Counter(tuple(w[k:k + window]) for w in split for k in range(len(w) - window + 1))
    out = []
    for d, w in zip(rows, split):
        gone = {j for k in range(len(w) - window + 1) if seen[tuple(w[k:k + window])] > 1 for j in range(k, k + window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hot", [2000, 1])
def test_substring_dedup(docs, rows, none, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    found = substring_dedup.remove_repeats(docs).select("id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert Counter(map(tuple, found)) == brute_removed(rows, 35)
    assert substring_dedup.remove_repeats(none).count() == 0


def test_matching_statistics_find_every_repeated_window():
    rng = np.random.default_rng(1)
    for _ in range(20):
        segments = [rng.integers(0, 3, rng.integers(4, 30)).astype(np.uint64) for _ in range(12)]
        seen = Counter(tuple(s[k:k + 4]) for s in segments for k in range(len(s) - 3))
        found = substring_dedup.repeated_starts(segments, 4)
        assert [list(f) for f in found] == [[k for k in range(len(s) - 3) if seen[tuple(s[k:k + 4])] > 1] for s in segments]


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    found = packing.pack_documents(docs, TOKENIZER).collect()
    expected = Counter()
    for d in rows:
        ids = np.array([*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, s in enumerate(range(0, len(ids), 2048)):
            expected[d[0], k, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(bins) <= -(-sum(r.length for r in found) // 2048) + 2
    assert packing.pack_documents(none, TOKENIZER).count() == 0


def test_pitman_yor(docs, rows, none):
    found = pitman_yor.score_texts(docs).collect()
    fold = lambda t: re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    split = [[*words_of(fold(d[1])), None] for d in rows]
    held = [zlib.crc32(("" if d[0] is None else str(d[0])).encode()) % 7 == 2 for d in rows]
    counts = Counter(w for s, h in zip(split, held) if not h for w in s)
    n, v = sum(counts.values()), len(counts)
    expected = Counter((d[0], h, len(s), sum(counts[w] > 0 for w in s), n,
                        round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in s), 6))
                       for d, s, h in zip(rows, split, held))
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in found) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert pitman_yor.score_texts(none).count() == 0


def test_seating_keeps_its_bounds():
    counts = np.array([1, 2, 50, 5000, 200_000])
    tables = pitman_yor.seat(counts, np.full(5, 0.5), 0.7, np.random.default_rng(1))
    assert tables[0] == 1 and (tables >= 1).all() and (tables <= counts).all()
    assert (pitman_yor.seat(counts, np.full(5, 1e-12), 0.5, np.random.default_rng(1)) == 1).all()


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 16)).astype(np.float32)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(400, rows[0][1]), (401, None), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [1.0]), (None, rows[1][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = ann.neighbours(table, F.col("vec_id") % 20 == 0).collect()
    data = {i: np.array(v, np.float32).astype(float) for i, v in rows[:401]}
    hits = wanted = 0
    for q in range(0, 401, 20):
        score = {i: float((v * data[q]).sum()) for i, v in data.items() if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:20]
        got = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        assert all(math.isclose(r.score, score[r.vec_id], abs_tol=1e-9) for r in got)
        hits, wanted = hits + len(set(best) & {r.vec_id for r in got}), wanted + 20
    assert hits >= 0.9 * wanted
    assert ann.neighbours(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_every_code_within_the_radius_is_found():
    codes = np.random.default_rng(2).integers(0, 256, (500, 4), dtype=np.uint8)
    index = ann.SubstringIndex(codes)
    for radius in (0, 5, 9, 14):
        for code in codes[:20]:
            assert list(index.within(code, radius)) == list(np.flatnonzero(ann.distances(codes, code) <= radius))


def test_string_kernel_is_the_gapped_subsequence_kernel():
    from itertools import combinations

    def features(word):
        out = Counter()
        for t in combinations(range(len(word)), 3):
            out["".join(word[k] for k in t)] += toxicity.LAMBDA ** (t[2] - t[0] + 1)
        return out

    def kernel(a, b):
        fa, fb = features(a), features(b)
        dot = lambda x, y: sum(v * y[u] for u, v in x.items())
        return dot(fa, fb) / math.sqrt(dot(fa, fa) * dot(fb, fb))

    units = ["stupid", "stuupid", "loser", "banana", "idiot"]
    found = toxicity._kernel(units, units)
    assert np.allclose(found, [[kernel(a, b) for b in units] for a in units], atol=1e-4)


def test_toxicity_tolerates_gaps(spark, none):
    rng = random.Random(1)
    plain = ["tree", "house", "walking", "number", "seven", "garden", "window", "paper", "stone", "river"]
    text = lambda bad: " ".join([*rng.choices(plain, k=20), *bad]) + "."
    rows = [(i, text([rng.choice(["wretch", "vermin"])] if i % 4 == 0 else [])) for i in range(400)]
    tests = [(1000, text(["wrxetch"])), (1001, text(["v.e.r.m.i.n"])), (1002, text([])), (1003, None), (1004, "v e r m i n")]
    docs = spark.createDataFrame(rows + tests, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    scored = {r.doc_id: r for r in toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()}
    assert all(scored[i].predicted == int(i % 4 == 0) for i in range(400))
    assert [scored[i].predicted for i in range(1000, 1005)] == [1, 1, 0, 0, 1]
    assert all(0 <= r.score <= 1 for r in scored.values())
    blank = toxicity.fit(docs, labels.where("toxic = 0"))
    assert blank is None and {r.score for r in toxicity.score_documents(docs, blank).collect()} == {0.0}
    assert toxicity.score_documents(none, None).count() == 0
