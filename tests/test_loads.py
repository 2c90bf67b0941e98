"""Resumable loads, validated batches, watermark losses, bucketed tables, overlapping histories."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, values
from tidemark.operators.temporal import point_in_time_overlapping
from tidemark.plans.domain import Domain
from tidemark.sinks.increments import ResumableLoad
from tidemark.streaming import orders, sinks

LOG = "k string, seq int, op string, v string"
START = dt.datetime(2024, 1, 1)


def hour(n):
    return START + dt.timedelta(hours=n)


@pytest.fixture
def log(rows):
    return rows([("a", 1, "upsert", "a1"), ("b", 2, "upsert", "b2"), ("c", 3, "upsert", "c3"), ("b", 4, "delete", None),
                 ("a", 5, "upsert", "a5"), ("c", 6, "delete", None), ("c", 7, "upsert", "c7"), (None, 8, "upsert", "x"), ("d", None, "upsert", "y")], LOG)


def test_a_load_that_crashed_before_its_mark_is_repeated(spark, log, rows, tmp_path):
    once = ResumableLoad(spark, str(tmp_path / "once"), "k", "seq", buckets=4)
    assert once.load(log) == 7
    steps = ResumableLoad(spark, str(tmp_path / "steps"), "k", "seq", buckets=4)
    assert steps.load(log.filter("seq <= 2")) == 2 and steps.mark() == 2
    staged = steps.stage(log.filter("seq <= 5"))  # crash after the state was written, before the mark
    steps.apply(staged)
    assert steps.mark() == 2
    assert steps.load(log.filter("seq <= 5")) == 3 and steps.load(log) == 2 and steps.load(log) == 0
    assert values(steps.read()) == values(once.read()) == [("a", "a5"), ("c", "c7")]


def test_late_sequence_numbers_do_not_bring_keys_back(spark, log, rows, tmp_path):
    load = ResumableLoad(spark, str(tmp_path / "t"), "k", "seq", late=4, buckets=4)
    load.load(log.filter("seq IN (1, 4, 5)"))  # the delete of b came before its insert
    assert load.load(log.filter("seq < 6")) == 4  # 2 to 5 are in the window; 2 and 3 are late
    assert values(load.read()) == [("a", "a5"), ("c", "c3")]


def flagged(batch):
    return batch.withColumn("_ok", F.coalesce(F.col("v") > 0, F.lit(False)))


def test_a_batch_repeated_after_a_failure_changes_nothing(spark, rows, tmp_path):
    sink = sinks.ValidatedSink(str(tmp_path / "t"), flagged, "id", "ts")
    kinds = "id int, ts timestamp, v int"
    first = rows([(1, hour(0), 5), (1, hour(0), 5), (2, hour(1), -1), (None, hour(1), None)], kinds)
    second = rows([(1, hour(2), 9), (2, hour(2), 3), (2, hour(2), -4)], kinds)
    sink.write(first, 0)
    sink.write(second, 1)

    def state():
        return values(sink.read(spark, True)), values(sink.read(spark, False))

    want = ([(1, hour(0), 5), (2, hour(2), 3)], sorted([(2, hour(1), -1), (None, hour(1), None), (2, hour(2), -4)],
                                                       key=lambda r: [(v is not None, str(v)) for v in r]))
    assert state() == want
    # a failure between the outputs of the second batch, then its repetition
    (tmp_path / "t" / "_batch=1" / "_ok=false").rename(tmp_path / "lost")
    sink.write(second, 1)
    sink.write(second, 1)
    assert state() == want


def test_rows_dropped_by_the_watermark_are_counted(spark, rows, tmp_path):
    """A last batch of 500 days-late ids: all but one are new to the stream and behind its watermark."""
    path, schema = str(tmp_path / "events"), "id int, ts timestamp"
    batches = [[(i, hour(i)) for i in range(24)], [(i, hour(i)) for i in range(100, 124)],
               [(1000 + i, hour(i % 24)) for i in range(499)] + [(2000, hour(300))]]
    found = {}
    for delay in ("15 minutes", "60 days"):
        found[delay] = 0
        for n, batch in enumerate(batches):
            if delay == "15 minutes":
                rows(batch, schema).write.parquet(f"{path}/{n}")
            stream = spark.readStream.schema(schema).parquet(f"{path}/*" if delay != "15 minutes" else f"{path}/[0-9]")
            once = orders.stream_dedup(stream, "id", "ts", delay)
            table, dropped = sinks.run_counted(once, str(tmp_path / f"out-{delay}"), str(tmp_path / f"state-{delay}"))
            found[delay] += dropped
        assert table.count() + found[delay] == 548
    assert found == {"15 minutes": 499, "60 days": 0}


def test_bucketed_facts_are_counted_without_a_shuffle(spark):
    d = Domain(spark, SF_DIR)
    facts = d.catalog_table("orders-by-customer", lambda: d.fct_orders.select("order_id", "customer_id"), "customer_id")
    counted = facts.groupBy("customer_id").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    returns = d.catalog_table("returns-by-customer", lambda: d.fct_returns.select("return_id", "customer_id"), "customer_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = counted.join(returns.groupBy("customer_id").agg(F.count("*").alias("r")), "customer_id", "left")
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["count"] for r in counted.collect()) == sorted(
        r["count"] for r in d.fct_orders.groupBy("customer_id").count().collect())


@pytest.mark.parametrize("closed", [False, True])
def test_overlapping_versions_by_brute_force(rows, closed):
    source = random.Random(closed)
    facts = [(i, source.choice(["a", "b", None]), hour(source.randrange(4000)) if i % 9 else None) for i in range(150)]
    dims = []
    for n in range(40):
        start = hour(source.randrange(-500, 4200))
        dims.append((source.choice(["a", "b", "c"]), f"v{n}", start, source.choice([None, start, start + dt.timedelta(hours=source.randrange(3000))])))
    dims.append(("a", "exact", facts[1][2], facts[1][2]))
    fact = rows(facts, "id int, k string, ts timestamp_ntz")
    dim = rows(dims, "k string, v string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    want = Counter(
        (i, k, t, v) for i, k, t in facts for d, v, a, b in dims
        if k is not None and t is not None and k == d and a <= t and (b is None or t < b or (closed and t == b)))
    for days in (1, 30, 5000):
        got = point_in_time_overlapping(fact, dim, "k", "ts", ["v"], closed=closed, days=days)
        assert Counter(tuple(r) for r in got.collect()) == want
    assert point_in_time_overlapping(fact.limit(0), dim, "k", "ts", ["v"]).count() == 0
