"""Columns that an operator doesn't read stay as they are, whatever their names, and change no result."""

import pytest
from pyspark.sql import functions as F

from tidegate.llm import host_rules, jaccard_join, line_dedup, mixing, substring_dedup

NAMES = ["__row", "__file", "__place", "__gone", "__places", "__split", "__lines", "__copies", "__copy", "id", "size",
         "n", "token", "comp", "block", "rows", "_metadata", "_seq", "host", "_text", "idx"]
STAGES = {"quality": host_rules.keep_good, "lines": line_dedup.without_repeated_lines,
          "near": jaccard_join.one_of_each, "mix": mixing.repeat_by_mix}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The same documents without and with the other columns."""
    folder = tmp_path_factory.mktemp("clash")
    line = "the quick brown fox jumps over the lazy dog while the small grey cat sleeps on number"
    texts = ["\n".join(f"{line} {i % 4} {k} {i * k % 7}" for k in range(6)) for i in range(12)] + [None, "", "short"]
    plain = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    plain.repartition(2, "doc_id").write.parquet(str(folder / "plain"))
    extra = plain.select("*", *[F.concat(F.lit(name), F.col("doc_id").cast("string")).alias(name) for name in NAMES])
    extra.repartition(2, "doc_id").write.parquet(str(folder / "extra"))
    return [spark.read.parquet(str(folder / kind)) for kind in ("plain", "extra")]


@pytest.mark.parametrize("stage", sorted(STAGES))
def test_stages_keep_other_columns(tables, stage):
    plain, extra = (STAGES[stage](t) for t in tables)
    assert extra.columns == plain.columns + NAMES
    rows = extra.collect()
    assert all(r[name] == f"{name}{r.doc_id}" for r in rows for name in NAMES)
    key = ["doc_id", "text"]
    assert sorted([(r.doc_id, r.text) for r in rows], key=repr) == sorted(
        [(r.doc_id, r.text) for r in plain.select(*key).collect()], key=repr)


@pytest.mark.parametrize("operator", [host_rules.judge, line_dedup.dedup_lines, jaccard_join.near_duplicates, mixing.mix,
                                      substring_dedup.remove_repeats])
def test_operators_ignore_other_columns(tables, operator):
    plain, extra = (operator(t) for t in tables)
    same = [c for c in plain.columns if not c.startswith("__tidegate_row")]
    assert sorted(map(tuple, extra.select(*same).collect()), key=repr) == sorted(
        map(tuple, plain.select(*same).collect()), key=repr)
