import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators import changes, keys, merge
from tidemark.operators.validation import RowCountError
from tidemark.sinks import tables

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
SCHEMA = "id string, name string, price int, seq int"
COLUMNS = ["name", "price"]


@pytest.fixture
def target(rows):
    return merge.scd1_upsert(None, rows([("a", "A", 1, 1), ("b", "B", 2, 1)], SCHEMA), "id", COLUMNS, D1)


def test_scd1_overwrites_inserts_and_keeps(target, rows):
    source = rows([("b", "B", 2, 1), ("c", "C", 3, 1), ("c", "C2", 4, 2), (None, "N", 0, 1)], SCHEMA)
    result = merge.scd1_upsert(target, source, "id", COLUMNS, D2, order=["seq"])
    assert values(result) == [("a", "A", 1, D1), ("b", "B", 2, D2), ("c", "C2", 4, D2)]
    assert keys.duplicate_keys(result, "id").count() == 0


def test_staged_upsert_checks_before_it_merges(target, rows):
    staged = rows([("c", "C", 3, 1), (None, "N", 0, 1)], SCHEMA)
    with pytest.raises(RowCountError):
        merge.staged_upsert(target, staged, "id", COLUMNS, 2, D2)
    assert merge.staged_upsert(target, staged, "id", COLUMNS, 1, D2).count() == 3


def test_truncate_load_leaves_target_when_source_is_short(spark, rows, tmp_path):
    path = str(tmp_path / "regions")
    tables.overwrite_table(rows([("a",), ("b",)], "code string"), path)
    with pytest.raises(RowCountError):
        tables.overwrite_table(merge.truncate_load(rows([("c",)], "code string"), 2), path)
    assert values(spark.read.parquet(path)) == [("a",), ("b",)]


def test_cdc_newest_change_wins_and_deletes_remove(rows):
    log = rows(
        [("a", "A", 1, 5, "upsert"), ("a", "A0", 0, 4, "upsert"), ("b", "B", 2, 6, "delete"), ("c", "C", 3, 6, "insert"),
         ("d", "D", 1, 1, "insert"), ("d", "D", 1, 2, "delete")],
        SCHEMA + ", op string",
    )
    state = rows([("a", "old", 9), ("b", "old", 9), ("z", "Z", 9)], "id string, name string, price int")
    assert values(merge.cdc_apply(state, log, "id", "seq")) == [("a", "A", 1), ("c", "C", 3), ("z", "Z", 9)]
    assert values(merge.cdc_apply(None, log, "id", "seq"), "id") == [("a",), ("c",)]


def test_conditional_update_ignores_null_conditions(rows):
    state = rows([("a", 1), ("b", None), ("c", 3)], "id string, n int")
    source = rows([("a", 2), ("b", 2)], "id string, n int")
    result = merge.conditional_update(state, source, "id", F.col("t.n") != F.col("s.n"), {"n": F.col("s.n")})
    assert values(result) == [("a", 2), ("b", None), ("c", 3)]


def test_append_dedup_is_repeatable(rows):
    old = rows([("1", 1), ("1", 1)], "id string, n int")
    fresh = rows([("1", 9), ("2", 5), ("2", 4), (None, 1)], "id string, n int")
    once = keys.append_dedup(old, fresh, "id")
    assert values(once) == [("1", 1), ("1", 1), ("2", 4)]
    assert values(keys.append_dedup(once, fresh, "id")) == values(once)


def test_latest_per_key_breaks_ties_by_the_rest(rows):
    df = rows([("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, t int, v string")
    assert values(keys.latest_per_key(df, ["k"], ["t"])) == [("a", 2, "y"), ("b", None, "z")]
    assert values(keys.latest_per_key(df.select("k"), ["k"], [])) == [("a",), ("b",)]
    assert values(keys.first_per_key(df.select("k"), ["k"])) == [("a",), ("b",)]


def test_orphans_and_fanout(rows):
    child = rows([("a",), ("x",), ("x",), (None,)], "k string")
    parent = rows([("a",), ("a",), ("b",)], "k string")
    assert values(keys.fk_orphans(child, parent, "k")) == [(None, 1), ("x", 2)]
    report = keys.join_fanout(child, parent, "k").first()
    assert (report.fact_rows, int(report.joined_rows), report.duplicated_keys, report.fans_out) == (4, 5, 1, True)
    assert int(report.joined_rows) == child.join(parent, "k", "left").count()


STATE = "id string, day date, amount decimal(18,2)"
DAY = dt.date(2024, 1, 1)


@pytest.fixture
def states(rows):
    old = rows([("a", DAY, Decimal(1)), ("b", DAY, Decimal(2)), ("c", DAY, None), ("d", DAY, Decimal(4))], STATE)
    new = rows([("a", DAY, Decimal(1)), ("b", DAY, Decimal(5)), ("c", DAY, Decimal(3)), ("e", DAY, Decimal(6))], STATE)
    return old, new


def test_change_feed_has_pre_and_post_images(states):
    feed = changes.change_feed(*states, "id", 3, "2024-05-01")
    assert values(feed, "id", "_change_type", "amount") == [
        ("b", "update_postimage", Decimal(5)), ("b", "update_preimage", Decimal(2)),
        ("c", "update_postimage", Decimal(3)), ("c", "update_preimage", None),
        ("d", "delete", Decimal(4)), ("e", "insert", Decimal(6)),
    ]
    assert values(changes.apply_feed(states[0], feed, "id")) == values(states[1])
    assert values(changes.changes_since(feed, version=3), "id") == [("b",), ("c",), ("e",)]
    assert changes.changes_since(feed, version=4).count() == 0
    assert changes.changes_since(feed, ts="2024-05-02").count() == 0


def test_incremental_totals_equal_a_recompute(states):
    def totals(df):
        return df.groupBy("day").agg(F.sum("amount").cast("decimal(28,2)").alias("revenue"), F.count("*").alias("lines"))

    old, new = states
    feed = changes.change_feed(old, new, "id")
    result = changes.incremental_revenue(totals(old), feed, ["day"], "amount")
    assert values(result) == values(totals(new))
    emptied = changes.incremental_revenue(totals(old), changes.change_feed(old, old.limit(0), "id"), ["day"], "amount")
    assert emptied.count() == 0
