import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.operators import validation as v
from tidemark.sinks import tables

def rules():
    return {"id": F.col("id").isNotNull(), "price": F.col("price") > 0}


@pytest.fixture
def flagged(rows):
    return v.flag_rows(rows([(1, 5.0), (2, -1.0), (3, None), (None, 2.0), (None, None)], "id int, price double"), rules())


def test_null_rule_counts_as_failed_and_no_row_is_lost(flagged):
    good, bad = v.good_rows(flagged), v.bad_rows(flagged)
    assert values(good, "id") == [(1,)]
    assert good.count() + bad.count() == flagged.count() == 5


def test_failed_rules_are_named_in_rule_order(flagged):
    named = {(r.id, r.price): r._failed_rules for r in v.bad_rows(flagged).collect()}
    assert named == {(2, -1.0): ["price"], (3, None): ["price"], (None, 2.0): ["id"], (None, None): ["id", "price"]}


def test_mark_known_keeps_rows_and_treats_null_as_unknown(rows):
    facts = rows([("a", 1), ("x", 2), (None, 3), ("a", 4)], "k string, n int")
    dim = rows([("a",), ("a",), ("b",), (None,)], "k string")
    marked = v.mark_known(facts, dim, "k", "known")
    assert values(marked, "n", "known") == [(1, True), (2, False), (3, False), (4, True)]


def test_reports(flagged):
    df = flagged.drop("_ok", "_failed_rules")
    assert values(v.dq_report(df, rules())) == [("id", 3, 2), ("price", 2, 3)]
    assert values(v.dq_score(df, rules())) == [(5, 1, 0.2)]
    assert values(v.load_summary(flagged)) == [(5, 1, 4)]
    assert values(v.dq_score(df.limit(0), rules())) == [(0, 0, None)]


def test_row_count_guard(rows):
    df = rows([(1,), (2,)], "a int")
    assert v.require_rows(df, 2) is df
    with pytest.raises(v.RowCountError):
        v.require_rows(df, 3)
    assert values(v.row_count_check(df, 3)) == [(2, 3, False)]


def test_quarantine_is_written_only_when_needed(spark, rows, tmp_path, flagged):
    path = str(tmp_path / "bad")
    assert not tables.write_quarantine(v.bad_rows(flagged).limit(0), path)
    assert tables.read_if_exists(spark, path) is None
    assert tables.write_quarantine(v.bad_rows(flagged), path)
    assert {"_quarantine_reason", "_loaded_at"} <= set(spark.read.parquet(path).columns)


def test_order_rules(rows):
    raw = rows(
        [
            ("o1", "c1", "p1", 2, 10, "2024-01-01T10:00:00"),
            ("o2", "c9", "p1", 1, 10, "2024-01-01T10:00:00"),
            ("o3", "c1", "p9", 1, 10, "2024-01-01T10:00:00"),
            ("o4", "c1", "p1", 1, 0, "2024-01-01T10:00:00"),
            ("o5", "c1", "p1", 1, None, "2024-01-01T10:00:00"),
            ("o6", "c1", "p1", 1, 10, "01/02/2024"),
            (None, None, None, 1, 10, None),
        ],
        "order_id string, customer_id string, product_id string, quantity int, unit_price int, order_ts string",
    ).withColumn("unit_price", F.col("unit_price").cast("decimal(12,2)"))
    flagged = v.flag_orders(raw, rows([("c1",)], "customer_id string"), rows([("p1",)], "product_id string"))
    assert values(v.fct_orders(flagged), "order_id", "line_total")[0][0] == "o1"
    reasons = {r.order_id: r._failed_rules for r in v.bad_rows(flagged).collect()}
    assert reasons == {
        "o2": ["customer_known"], "o3": ["product_known"], "o4": ["price_positive"], "o5": ["price_positive"],
        "o6": ["order_ts_valid"], None: ["order_id_present", "customer_known", "product_known", "order_ts_valid"],
    }
