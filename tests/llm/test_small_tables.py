"""Small tables between the steps of an operator are written by few tasks, whatever the number of partitions."""

import os

import pytest

from tidegate.llm import line_dedup, packing
from tidegate.llm.common import Workspace, pinned


@pytest.fixture
def kept(spark, monkeypatch):
    """(name, files) of the tables that are kept while 40 partitions are shuffled to."""
    found, keep = [], Workspace.keep

    def seen(ws, df, name, **options):
        out = keep(ws, df, name, **options)
        found.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(Workspace, "keep", seen)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    yield found
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rounds_of_packing(spark, kept):
    ws = Workspace(spark, "test")
    pieces = spark.range(400).selectExpr("id key", "(id * 37) % 2048 + 1 length")
    placed = packing.pack(ws, pieces).groupBy("sequence_id").count().agg({"count": "sum"}).first()[0]
    assert placed == 400
    assert {files for name, files in kept if name in ("matched", "bins")} <= {1}
    assert not [f for f in os.listdir(ws.path.removeprefix("file:")) if f.endswith("-sorted")]


def test_rounds_of_line_dedup(spark, kept):
    ws = Workspace(spark, "test")
    # Lines whose first holders differ, in changing order: some are left for further holders.
    docs = spark.range(60).selectExpr("id doc_id", r"""concat_ws('\n', concat('own ', id), concat('line ', id % 5),
        concat('line ', id % 3), concat('line ', 4 - id % 5), concat('line ', id % 7)) text""")
    gone = line_dedup.removed_lines(ws, pinned(ws, docs)).count()
    assert gone > 0
    small = {"shared", "claims", "first-gone", "unsettled", "further-pairs", "further-gone", "left", "gone"}
    assert small <= {name for name, _ in kept}
    assert {files for name, files in kept if name in small} <= {0, 1}
