"""Change logs from the write: feeds, versions, restores and totals that follow them."""

import glob
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators.changes import signed_totals
from tidemark.operators.validation import RowCountError
from tidemark.sinks.changelog import ChangeTable
from tidemark.streaming.sinks import TotalsTable

ROWS = "k string, v int, w string"


def day(n):
    return f"2024-01-{n:02d} 00:00:00"


@pytest.fixture
def table(spark, rows, tmp_path):
    """0: a b c; 1: b changes, c goes, d comes; 2: a null key and a repeated new key; 3: d goes."""
    t = ChangeTable(spark, str(tmp_path / "t"), "k")
    t.write(rows([("a", 1, None), ("b", 2, "x"), ("c", 3, None)], ROWS), day(1))
    t.merge(rows([("b", 5, "x"), ("d", 4, None), ("a", 1, None), (None, 9, "n")], ROWS), day(2), delete=rows([("c",), ("zz",)], "k string"))
    t.append(rows([(None, 7, "n"), ("e", 1, None), ("e", 1, None)], ROWS), day(3))
    t.delete(F.col("v") == 4, day(4))
    return t


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_a_merge_leaves_the_rows_it_changed(table):
    feed = table.changes(since=1, until=1)
    assert values(feed, "k", "v", "_change_type") == sorted(
        [("b", 2, "update_preimage"), ("b", 5, "update_postimage"), ("c", 3, "delete"), ("d", 4, "insert")],
        key=lambda r: [(True, str(v)) for v in r])
    assert table.changes(since=0, until=0).count() == 3
    assert table.changes(ts=day(3)).groupBy("_commit_version").count().orderBy("_commit_version").collect() == [(2, 3), (3, 1)]
    assert table.changes(ts=day(9)).count() == 0


def test_states_are_a_base_and_its_log(table):
    states = {n: Counter(tuple(r) for r in table.as_of(n).collect()) for n in range(4)}
    assert states[0] == Counter([("a", 1, None), ("b", 2, "x"), ("c", 3, None)])
    assert states[1] == Counter([("a", 1, None), ("b", 5, "x"), ("d", 4, None)])
    assert states[2] == states[1] + Counter([(None, 7, "n"), ("e", 1, None), ("e", 1, None)])
    assert states[3] == states[2] - Counter([("d", 4, None)])
    assert Counter(tuple(r) for r in table.as_of(ts=day(2)).collect()) == states[1]
    assert table.as_of(ts="2020-01-01 00:00:00").count() == 0
    history = {r.version: (r.operation, r.row_count, r.changed_rows) for r in table.history().collect()}
    assert history == {0: ("WRITE", 3, None), 1: ("MERGE", 3, 4), 2: ("APPEND", 6, 3), 3: ("DELETE", 5, 1)}


def test_a_restore_writes_what_later_versions_changed(table):
    before = Counter(tuple(r) for r in table.as_of(2).collect())
    with pytest.raises(RowCountError):
        table.restore(day(5), version=2, min_rows=7)
    assert table.restore(day(5), after=day(2), before=day(4)) == 4
    assert Counter(tuple(r) for r in table.as_of().collect()) == before
    assert table.changes(since=4).count() == 1
    with pytest.raises(ValueError, match="no version"):
        table.restore(day(6), after=day(20))


def test_random_histories_read_alike_from_any_base(spark, rows, tmp_path):
    source = random.Random(1)
    plain = ChangeTable(spark, str(tmp_path / "plain"), "k", base_every=100)
    based = ChangeTable(spark, str(tmp_path / "based"), "k", base_every=2)
    want = {f"k{i}": (f"k{i}", i, None) for i in range(10)}
    for t in (plain, based):
        t.write(rows(list(want.values()), ROWS), day(1))
    for step in range(3):
        changed = [(f"k{source.randrange(14)}", source.randrange(4), source.choice([None, "x"])) for _ in range(3)]
        gone = [f"k{source.randrange(14)}" for _ in range(2)]
        for r in sorted(changed, key=lambda r: (r[0], r[1], r[2] is not None)):
            want[r[0]] = r
        for k in gone:
            want.pop(k, None)
        for t in (plain, based):
            t.merge(rows(changed, ROWS), day(2 + step), delete=rows([(k,) for k in gone], "k string"))
            assert sorted(tuple(r) for r in t.as_of().collect()) == sorted(want.values())
    assert plain.history().filter("operation = 'REBASE'").count() == 0
    assert based.history().filter("operation = 'REBASE'").count() >= 2


def test_a_version_costs_its_changed_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    t = ChangeTable(spark, path, "id")
    t.write(spark.range(200_000).withColumn("v", F.rand(1)), day(1))
    before = size(path)
    t.merge(spark.range(20).withColumn("v", F.lit(0.5)), day(2))
    t.append(spark.range(200_000, 200_020).withColumn("v", F.lit(0.5)), day(3))
    t.restore(day(4), version=1)
    assert size(path) - before < before / 20
    assert t.as_of().count() == 200_000


def test_a_feed_reads_the_folders_of_its_versions(table):
    feed = table.changes(since=2)
    plan = feed._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert "_commit_version" in filters and ">= 2" in filters and "<= 3" in filters
    read = {f.split("_commit_version=")[1][0] for f in feed.select(F.col("_metadata.file_path")).distinct().toPandas()["file_path"]}
    assert read == {"2", "3"}


def test_a_commit_that_failed_half_way_is_invisible(table, rows):
    rows([("q", 1, None, "insert", None)], ROWS + ", _change_type string, _commit_timestamp timestamp_ntz").write.parquet(
        f"{table.path}/changes/_commit_version=4")
    assert table.find().version == 3 and table.as_of().filter("k = 'q'").count() == 0
    assert table.append(rows([("r", 1, None)], ROWS), day(5)) == 4
    assert table.as_of().filter("k IN ('q', 'r')").count() == 1


def test_totals_follow_the_feed_and_leave_other_parts(spark, rows, tmp_path):
    lines = rows([(i, None, i) for i in range(60)], "id int, day string, amount int").select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id")).alias("day"), F.col("amount").cast("decimal(18,2)").alias("amount"))
    t = ChangeTable(spark, str(tmp_path / "t"), "id")
    t.write(lines, day(1))
    path = str(tmp_path / "totals")
    totals = TotalsTable(path, ["day"], ["revenue", "lines"], F.trunc("day", "month"))
    totals.upsert(signed_totals(t.changes(until=0), ["day"], "amount"), 0)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*2024-02*/**/*.parquet", recursive=True)}
    assert before
    t.merge(lines.filter("id = 3").withColumn("amount", F.lit(100).cast("decimal(18,2)")), day(2), delete=rows([(4,)], "id int"))
    for _ in range(2):  # a repeated batch counts once
        totals.upsert(signed_totals(t.changes(since=1), ["day"], "amount"), 1)
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*2024-02*/**/*.parquet", recursive=True)} == before
    got = totals.read(spark).filter("lines <> 0")
    want = t.as_of().groupBy("day").agg(F.sum("amount").cast("decimal(28,2)").alias("revenue"), F.count("*").alias("lines"))
    assert values(got, "day", "revenue", "lines") == values(want, "day", "revenue", "lines")
    assert got.count() == 59


def test_states_of_sort_merge_joins_can_be_united(spark, tmp_path):
    """Re-planning gives the sides of a state's union different numbers of partitions."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = spark.range(400).select("id", (F.col("id") % 7).alias("v"))
        t = ChangeTable(spark, str(tmp_path / "joined"), "id")
        t.write(items.filter("id < 200"), day(1))
        t.append(items.filter("id >= 200"), day(2))
        t.delete(F.col("id") % 2 == 0, day(3))
        t.restore(day(4), version=1)
        assert values(t.as_of()) == values(items)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_state_after_appends_needs_no_join(spark, rows, tmp_path):
    t = ChangeTable(spark, str(tmp_path / "appended"), "k")
    t.write(rows([("a", 1, None)], ROWS), day(1))
    t.append(rows([("a", 2, None), ("b", 2, None), (None, 2, None)], ROWS), day(2))
    assert "Join" not in t.as_of()._jdf.queryExecution().executedPlan().toString()
    t.delete(F.col("v") == 1, day(3))
    assert values(t.as_of(), "k", "v") == [(None, 2), ("b", 2)]
    t.delete(F.col("v") == 2, day(4))
    assert values(t.as_of(), "k", "v") == [(None, 2)]
