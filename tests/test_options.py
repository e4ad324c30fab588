"""Options: layering, limits and refusals."""

import warnings

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import tidegate as tg
from tidegate.errors import OptionError
from tidegate.options import resolve


@pytest.mark.parametrize("bad", [
    {}, {"table": "t", "path": "/p"}, {"path": "/p", "database": "d"}, {"table": "a b"},
    {"table": "t", "batch_size": 0}, {"table": "t", "batch_size": -5},
    {"table": "t", "channels": 0}, {"table": "t", "shards": 0},
    {"table": "t", "on_failure": "retry"}, {"table": "t", "optional_mode": "empty"},
    {"table": "t", "timestamp_precision": "ns"}, {"table": "t", "match": "fuzzy"},
    {"table": "t", "writer": "a/b"}, {"table": "t", "epoch": -1}, {"table": "t", "color": "red"},
])
def test_refused(spark, bad):
    with pytest.raises(OptionError):
        resolve(spark, **bad)


def test_batch_size_is_clamped(spark):
    assert resolve(spark, table="t", batch_size=200_001).batch_size == 200_001


def test_named_configuration_overrides_arguments(spark):
    spark.conf.set("tidegate.config.prod.table", "configured")
    spark.conf.set("tidegate.config.prod.batch_size", "77")
    options = resolve(spark, table="argument", batch_size=5, database="d", config="prod")
    assert (options.table, options.batch_size, options.database) == ("configured", 77, "d")
    options = resolve(spark, table="t", config={"database": "x", "user": "ignored"})
    assert (options.table, options.database) == ("t", "x")


def test_empty_configuration_warns(spark):
    with pytest.warns(UserWarning, match="sets no option"):
        resolve(spark, table="t", config="missing")
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        resolve(spark, table="t")


def test_dry_run_needs_no_target(spark):
    assert resolve(spark, dry_run=True).table is None


def test_dry_run_converts_and_writes_nothing(spark, target):
    df = spark.range(1000).select(F.col("id").alias("v"))
    done = tg.insert(df, path=target, schema="uint8 v", dry_run=True, batch_size=100)
    assert done.metrics == {"rows_converted": 1000, "rows_written": 0}
    assert done.results.where("_Inserted_").count() == 1000
    assert sorted(r.n_rows for r in done.log.collect()) == [100] * 10
    assert not tg.sources.tables.TableStore(spark, path=target).exists()


@pytest.mark.parametrize("query", [
    "select 1 _channel", "select 1 _Inserted_", "select 1 _epoch", "select 1 _o0", "select 1 a, 2 a"])
def test_reserved_and_repeated_names(spark, target, query):
    with pytest.raises((OptionError, tg.SchemaMismatch)):
        tg.insert(spark.sql(query), path=target)


def test_a_stream_needs_attributes(spark, target):
    with pytest.raises(OptionError, match="no attributes"):
        tg.insert(spark.range(1).select(), path=target)


def test_dedupe_needs_a_primary_key(spark, target):
    with pytest.raises(OptionError, match="primary key"):
        tg.insert(spark.range(1), path=target, dedupe_on_key=True)
    assert not tg.sources.tables.TableStore(spark, path=target).exists()


@pytest.mark.parametrize("option", [
    {"order_by": "nope"}, {"channels": "nope % 3"}, {"reject_when": "nope > 1"}])
def test_unknown_columns_leave_no_table(spark, target, option):
    with pytest.raises(AnalysisException):
        tg.insert(spark.range(1), path=target, **option)
    assert not tg.sources.tables.TableStore(spark, path=target).exists()
