import datetime as dt
from decimal import Decimal

import pytest

from tests.conftest import values
from tidemark.operators import gold

AS_OF = "2024-03-31"
ORDERS = "order_id string, customer_id string, product_id string, quantity int, line_total decimal(18,2), order_ts timestamp_ntz"


def day(month, n):
    return dt.datetime(2024, month, n, 12)


@pytest.fixture
def orders(rows):
    return rows(
        [
            ("o1", "c1", "p1", 3, Decimal("10.00"), day(3, 30)),
            ("o2", "c1", "p1", 1, Decimal("0.01"), day(3, 20)),
            ("o3", "c1", "p2", 1, Decimal("10.00"), day(1, 1)),
            ("o4", "c2", "p2", 1, Decimal("7.00"), dt.datetime(2023, 1, 1)),
        ],
        ORDERS,
    )


@pytest.fixture
def returns(rows):
    return rows(
        [("r1", "c1", "p1", dt.date(2024, 3, 30), Decimal("4.00")), ("r2", "c1", "p1", dt.date(2024, 2, 2), Decimal("1.00"))],
        "return_id string, customer_id string, product_id string, return_date date, refund_amount decimal(12,2)",
    )


@pytest.fixture
def customers(rows):
    return rows([("c1", "vip"), ("c2", "vip"), ("c3", "standard")], "customer_id string, segment string")


def test_customer_metrics_fill_and_round(orders, returns, customers):
    found = {r.customer_id: r for r in gold.customer_metrics(orders, returns, customers, AS_OF).collect()}
    one, none = found["c1"], found["c3"]
    assert (one.total_orders, one.total_spend, one.avg_order_value) == (3, Decimal("20.01"), Decimal("6.67"))
    assert (one.days_since_last_order, one.total_returns, one.total_refunded) == (1, 2, Decimal("5.00"))
    assert (none.total_orders, none.total_spend, none.avg_order_value) == (0, 0, 0)
    assert none.last_order_ts is None and none.days_since_last_order is None


def test_average_rounds_halves_away_from_zero(rows):
    df = rows([("c", Decimal("0.01"), i) for i in range(1)] + [("c", Decimal("0.00"), 1)], "customer_id string, line_total decimal(18,2), n int")
    df = df.selectExpr("customer_id", "line_total", "cast(n AS string) AS order_id", "timestamp_ntz'2024-01-01' AS order_ts")
    assert gold.order_metrics(df, AS_OF).first().avg_order_value == Decimal("0.01")


def test_rfm_counts_only_recent_orders(orders, customers):
    found = {r.customer_id: r for r in gold.customer_rfm_90d(orders, customers, AS_OF).collect()}
    assert (found["c1"].order_count_90d, found["c1"].total_spend_90d) == (3, Decimal("20.01"))
    assert found["c1"].clv_estimate == Decimal("80.04")
    assert (found["c2"].order_count_90d, found["c2"].clv_estimate) == (0, 0) and found["c2"].last_order_at is not None
    assert found["c3"].last_order_at is None and found["c3"].avg_order_value_90d == 0


def test_churn_counts_silent_and_new_customers(orders, returns, customers):
    metrics = gold.customer_metrics(orders, returns, customers, AS_OF)
    assert values(gold.segment_churn_risk(metrics)) == [
        ("standard", 1, 1, Decimal("100.0")), ("vip", 2, 1, Decimal("50.0")),
    ]


def test_product_performance_counts_lines_and_guards_zero(orders, returns, rows):
    products = rows([("p1", "One", 5), ("p3", "Three", None)], "product_id string, product_name string, unit_price int")
    found = {r.product_id: r for r in gold.product_performance(orders, returns, products).collect()}
    assert (found["p1"].total_units_sold, found["p1"].avg_quantity_per_order) == (2, 2.0)
    assert found["p1"].return_rate_pct == Decimal("100.0")
    assert (found["p3"].total_units_sold, found["p3"].return_rate_pct, found["p3"].unit_price) == (0, 0, 0)


def test_trend_windows_are_half_open(rows):
    as_of = dt.datetime(2024, 1, 15)
    at = [(as_of, 1), (dt.datetime(2024, 1, 8), 30), (dt.datetime(2024, 1, 7, 23), 10), (dt.datetime(2024, 1, 1), 10), (dt.datetime(2023, 12, 31), 99)]
    orders = rows([(f"o{i}", "c", "p", 1, Decimal(v), t) for i, (t, v) in enumerate(at)], ORDERS)
    trend = gold.product_trend_7d(orders, rows([("p",), ("q",)], "product_id string"), as_of)
    assert values(trend) == [
        ("p", Decimal("30.00"), 1, Decimal("20.00"), Decimal("50.00")), ("q", Decimal(0), 0, Decimal(0), Decimal(0)),
    ]
    assert values(gold.trending_products(trend, 5), "direction", "product_id") == [("rising", "p")]


def test_revenue_keeps_order_days_only(orders, returns):
    found = values(gold.revenue_daily(orders, returns), "order_date", "num_orders", "total_refunds", "net_revenue")
    assert (dt.date(2024, 3, 30), 1, Decimal("4.00"), Decimal("6.00")) in found
    assert dt.date(2024, 2, 2) not in [f[0] for f in found] and len(found) == 4


def test_reconcile_shows_one_sided_keys(rows):
    left = rows([("a", Decimal(1)), ("b", Decimal(2))], "k string, v decimal(18,2)")
    right = rows([("a", Decimal(1)), ("c", Decimal(3))], "k string, v decimal(18,2)")
    assert values(gold.reconcile(left, right, "k", "v"), "k", "difference", "matches") == [
        ("a", Decimal(0), True), ("b", Decimal(2), False), ("c", Decimal(-3), False),
    ]
