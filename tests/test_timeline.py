"""Chunked ordered operators against plain windows and brute-force range joins."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators import temporal, timeline
from tidemark.operators.temporal import leakage_audit, point_in_time
from tidemark.operators.timeline import last_version, with_neighbour

START = dt.datetime(2024, 1, 1)


@pytest.fixture(autouse=True, params=["all hot", "one hot", "none hot"])
def hot(request, monkeypatch):
    """Run every test with all keys cut into chunks, with the largest only, and with none."""
    monkeypatch.setattr(timeline, "HOT_ROWS", {"all hot": 0, "one hot": 200, "none hot": 10**6}[request.param])
    return request.param


def at(hours):
    return START + dt.timedelta(hours=hours)


@pytest.fixture
def events(rows):
    """One key holds most rows; some chunks are empty, some times fall on chunk borders."""
    random.seed(7)
    data = []
    for key, n in (("hot", 300), ("warm", 20), ("single", 1)):
        for hour in random.sample(range(0, 900), n):
            data.append((key, at(hour - hour % 3 if key == "warm" else hour), random.choice([None, 1, 2, 3])))
    return rows(data, "k string, ts timestamp_ntz, v int").distinct()


@pytest.mark.parametrize("following", [True, False])
@pytest.mark.parametrize("seconds", [3600, 86_400, 10_000_000])
def test_neighbour_equals_window(events, following, seconds):
    got = with_neighbour(events, ["k"], ["ts", "v"], ["ts", "v"], "n", following=following, seconds=seconds)
    window = W.partitionBy("k").orderBy("ts", "v")
    shift = F.lead if following else F.lag
    want = events.withColumn("n", shift(F.struct("ts", "v")).over(window))
    assert values(got, "k", "ts", "v", "n") == values(want, "k", "ts", "v", "n")


@pytest.fixture
def versions(rows):
    random.seed(3)
    data = []
    for key, n in (("hot", 60), ("warm", 3), ("unused", 2)):
        starts = sorted(random.sample(range(20, 900), n))
        for i, (start, end) in enumerate(zip(starts, starts[1:] + [None])):
            if i % 5 == 4 and end is not None:
                end = max(start + 1, end - 2)  # a gap
            data.append((key, f"{key}{i}", at(start), None if end is None else at(end), end is None))
    return rows(data, "k string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("seconds", [7200, 86_400])
def test_point_in_time_equals_range_join(events, versions, closed, seconds):
    got = point_in_time(events, versions, "k", "ts", ["name"], closed=closed, seconds=seconds)
    end = F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast("timestamp_ntz"))
    within = (F.col("ts") >= F.col("valid_from")) & (F.col("ts") <= end if closed else F.col("ts") < end)
    want = events.join(versions, "k").filter(within)
    assert got.count() > 50
    assert values(got, "k", "ts", "v", "name") == values(want, "k", "ts", "v", "name")


def test_boundary_belongs_to_the_later_version_or_to_both(rows):
    dim = rows(
        [("a", "old", at(0), at(10)), ("a", "new", at(10), None)],
        "k string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    fact = rows([("a", at(10)), ("a", at(9)), ("a", at(-1)), ("b", at(10)), (None, at(10)), ("a", None)],
                "k string, ts timestamp_ntz")
    half_open = point_in_time(fact, dim, "k", "ts", ["name"])
    assert values(half_open, "ts", "name") == [(at(9), "old"), (at(10), "new")]
    both = point_in_time(fact, dim, "k", "ts", ["name"], closed=True)
    assert values(both, "ts", "name") == [(at(9), "old"), (at(10), "new"), (at(10), "old")]


def test_seen_counts_started_versions(events, versions):
    got = last_version(events, versions, "k", "ts", "valid_from", ["name"], seen="n", seconds=7200)
    starts = [(r.k, r.valid_from) for r in versions.collect()]
    for row in got.collect():
        assert row.n == sum(k == row.k and start <= row.ts for k, start in starts)


@pytest.mark.parametrize("hot_rows", [1, 7])
def test_crowded_chunks_are_dealt_out_without_changing_the_result(events, versions, hot_rows):
    plain = last_version(events, versions, "k", "ts", "valid_from", ["name"], seen="n", hot_rows=10**6)
    dealt = last_version(events, versions, "k", "ts", "valid_from", ["name"], seen="n", hot_rows=hot_rows)
    assert values(dealt) == values(plain)
    counts = events.withColumn("_chunk", timeline.chunk_of("ts")).groupBy("k", "_chunk").agg(F.count("*").alias("_rows"))
    assert timeline.hot_groups(counts, ["k", "_chunk"], hot_rows).filter("_shares > 1").count() > 0


def test_hot_groups_have_no_upper_number(spark):
    counts = spark.range(6000).selectExpr("concat('k', id) AS k", "id + 10 AS _rows")
    assert timeline.hot_groups(counts, ["k"], hot_rows=1).count() == 6000
    assert timeline.hot_groups(counts, ["k"], hot_rows=10_000) is None


def test_one_key_on_one_day_is_cut(spark):
    day = spark.range(2000).selectExpr("'k' AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 40) AS ts", "id AS v")
    hot = timeline.hot_groups(timeline._count(day, ["k"]), ["k"], 100)
    assert timeline._with_chunk(day, ["k"], "ts", hot, timeline.DAY).select("_chunk").distinct().count() >= 10
    cut = timeline.with_neighbour(day, ["k"], ["ts"], ["v"], "after", following=True, hot_rows=100)
    plain = timeline.with_neighbour(day, ["k"], ["ts"], ["v"], "after", following=True, hot_rows=10**6)
    assert values(cut) == values(plain)


def test_leakage_audit_equals_joins(events, versions):
    dim = versions.withColumn("is_current", F.col("valid_to").isNull())
    row = leakage_audit(events, dim, "k", "ts", seconds=7200).first()
    lower = events.join(dim, "k").filter("ts >= valid_from")
    correct = lower.filter("valid_to IS NULL OR ts < valid_to")
    future = events.join(dim.filter("is_current"), "k").filter("ts < valid_from")
    assert (row.fact_rows, row.lower_bound_rows, row.correct_rows, row.future_rows) == (
        events.count(), lower.count(), correct.count(), future.count(),
    )
    assert row.leaked_rows == row.lower_bound_rows - row.correct_rows > 0


def test_the_audit_counts_facts_of_one_time_before_they_meet_versions(rows, monkeypatch):
    met = []

    def counted(facts, *args, **named):
        met.append(facts.count())
        return last_version(facts, *args, **named)

    monkeypatch.setattr(temporal, "last_version", counted)
    facts = rows([("a", at(5))] * 60 + [("a", at(1)), ("b", at(5)), (None, at(5))], "k string, ts timestamp_ntz")
    dim = rows([("a", at(0), at(3), False), ("a", at(3), None, True)], "k string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    assert values(leakage_audit(facts, dim, "k", "ts")) == [(62, 121, 61, 1, 60)] and met == [3]
    assert values(leakage_audit(facts.limit(0), dim, "k", "ts")) == [(0, 0, 0, 0, 0)]
