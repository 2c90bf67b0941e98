"""State that outlives a run: merges, bucketed tables, streaming totals, stream sources."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators.history import apply_changes_scd2
from tidemark.operators.merge import cdc_apply, conditional_update
from tidemark.sinks.tables import create_or_merge
from tidemark.sources.files import parquet_stream
from tidemark.streaming.sinks import TotalsTable

LOG = "k string, seq int, op string, v string"


def test_changes_without_a_key_are_left_out(rows):
    log = rows([(None, 1, "insert", "a"), ("x", 1, "insert", "b")], LOG)
    once = cdc_apply(None, log, "k", "seq")
    assert values(cdc_apply(once, log, "k", "seq")) == [("x", "b")]
    timed = log.withColumn("seq", F.timestamp_seconds("seq").cast("timestamp_ntz"))
    assert apply_changes_scd2(timed, "k", "seq", ["v"]).filter("k IS NULL").count() == 0


def test_a_repeated_source_key_updates_one_row(rows):
    target = rows([("x", 1), ("y", 2)], "k string, v int")
    source = rows([("x", 5), ("x", 7), (None, 9)], "k string, v int")
    done = conditional_update(target, source, "k", F.lit(True), {"v": F.col("s.v")})
    assert values(done) == [("x", 7), ("y", 2)]


def test_a_merge_may_empty_a_bucket(rows, tmp_path):
    path = str(tmp_path / "t")

    def merge(before, log):
        return cdc_apply(before, log, "k", "seq")

    create_or_merge(rows([("x", 1, "insert", "a"), ("y", 1, "insert", "b")], LOG), path, "k", merge, buckets=64)
    left = create_or_merge(rows([("x", 2, "delete", None)], LOG), path, "k", merge, buckets=64)
    assert values(left) == [("y", "b")]
    back = create_or_merge(rows([("x", 3, "insert", "c")], LOG), path, "k", merge, buckets=64)
    assert values(back) == [("x", "c"), ("y", "b")]
    with pytest.raises(ValueError, match="64 buckets"):
        create_or_merge(rows([("z", 1, "insert", "d")], LOG), path, "k", merge, buckets=8)


def test_totals_refuse_an_older_batch(rows, tmp_path):
    totals = TotalsTable(str(tmp_path), ["k"], ["n"])
    batch = rows([("a", 1)], "k string, n long")
    totals.upsert(batch, 0)
    totals.upsert(batch, 3)
    totals.upsert(batch, 3)
    assert values(totals.read(batch.sparkSession)) == [("a", 2)]
    with pytest.raises(ValueError, match="checkpoint"):
        totals.upsert(batch, 0)


def test_a_stream_reads_its_own_path_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(5).write.parquet(str(tmp_path / "events.parquet_old"))
    stream = parquet_stream(spark, str(tmp_path / "events.parquet"), "id long")
    query = stream.writeStream.format("memory").queryName("own_path").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("own_path").count() == 3
