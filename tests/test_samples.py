"""The sample and test applications: as many success rows as input rows."""

import pytest
from pyspark.sql import functions as F

import tidegate as tg
from tidegate.sources.counters import (counter, counter_over, labelled, sample_stream,
                                       sample_stream_optional)

SAMPLE = "int32 id, int64 id2, rstring name"
OPTIONAL = ("int32 ID, optional<int64> ID2, rstring NAME, optional<rstring> LNAME, "
            "optional<int32> OPT")


def ok_rows(done):
    return done.results.where("_Inserted_").select(F.lit("ok").alias("result")).count()


@pytest.mark.parametrize("rows, channels", [(105, 1), (100, 1), (100, 3)])
def test_insert_sample(spark, name, rows, channels):
    done = tg.insert(sample_stream(counter(spark, rows)), name, schema=SAMPLE, batch_size=50,
                     channels=channels, primary_key="id", partitioning_key="id")
    assert ok_rows(done) == rows
    assert spark.table(name).agg(F.sum("id"), F.max("name")).first() == (sum(range(rows)), "SAMPLE")


def test_optional_sample(spark, name):
    done = tg.insert(sample_stream_optional(counter(spark, 100)), name, schema=OPTIONAL, batch_size=50,
                     primary_key="ID", partitioning_key="ID")
    assert ok_rows(done) == 100
    assert spark.table(name).where("LNAME is null and OPT is null and ID2 = 2 * ID").count() == 100


def test_list_source_in_two_channels(spark, name):
    done = tg.insert(labelled(spark.range(1, 21), "id"), name, channels=2, primary_key="id",
                     partitioning_key="id")
    assert ok_rows(done) == 20
    assert {(r.id, r.name) for r in spark.table(name).collect()} == {(x, f"X{2 * x}") for x in range(1, 21)}


def test_named_configuration(spark, name):
    spark.conf.set("tidegate.config.sample.table", name)
    done = tg.insert(labelled(spark.range(1, 21), "id"), primary_key="id", config="sample")
    assert ok_rows(done) == 20 and spark.table(name).count() == 20


def test_counter_over_a_table(spark):
    df = spark.range(50, 0, -1)
    assert sorted(r.iteration for r in counter_over(df, ["id"]).collect()) == list(range(50))


def test_results_may_omit_the_flag(spark, target):
    done = tg.insert(labelled(spark.range(3), "id"), path=target)
    assert done.results.select("name", "id").columns == ["name", "id"]
