import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.session import use_disk_state
from tidemark.streaming import orders, sinks

ENVELOPE = "value binary, partition int, offset long, timestamp timestamp"
GOOD = b'{"order_id": "o1", "customer_id": "c1", "product_id": "p1", "quantity": 2, "unit_price": 1.5, "order_ts": "2024-01-01T10:00:00"}'
START = dt.datetime(2024, 1, 1)


def folder_stream(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def drop(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_parse_keeps_broken_payloads(rows):
    data = [(GOOD, 0, 1, START), (b"garbage", 1, 2, START), (b'{"order_id": "o2", "quantity": "many"}', 0, 3, START), (None, 0, 4, START)]
    parsed = orders.parse_orders(rows(data, ENVELOPE))
    assert values(parsed, "kafka_offset", "order_id", "quantity", "unit_price") == [
        (1, "o1", 2, 1.5), (2, None, None, None), (3, "o2", None, None), (4, None, None, None),
    ]
    assert parsed.filter("raw_payload = 'garbage' AND _ingested_at IS NOT NULL").count() == 1


@pytest.fixture
def late_source(rows, tmp_path):
    """Three ordered files: early rows, later rows, then rows that arrive days late."""
    path = str(tmp_path / "events")
    schema = "id int, ts timestamp, region string, amount decimal(12,2)"

    def hour(n):
        return START + dt.timedelta(hours=n)

    for batch in (
        [(i, hour(i), "eu", Decimal(1)) for i in range(24)],
        [(i, hour(i), "eu", Decimal(1)) for i in range(100, 124)],
        [(i, hour(i), "eu", Decimal(10)) for i in range(200, 201)] + [(5, hour(5), "eu", Decimal(50))],
        [(300, hour(300), "eu", Decimal(1)), (6, hour(6), "eu", Decimal(50))],
    ):
        drop(rows(batch, schema), path)
    return path, schema


@pytest.mark.parametrize("delay, first_day", [("15 minutes", Decimal(74)), ("60 days", None)])
def test_rows_behind_the_watermark_are_dropped(spark, tmp_path, late_source, delay, first_day):
    # The watermark acts one batch later: the late row of the third file still
    # counts towards the first day (24 + 50), the one of the fourth is dropped.
    path, schema = late_source
    stream = orders.stream_daily_revenue(folder_stream(spark, path, schema), "ts", "region", "amount", delay)
    table = sinks.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    found = dict(values(table, F.col("window_start").cast("timestamp_ntz").alias("d"), "daily_revenue"))
    assert found.get(START) == first_day
    assert bool(found) == (first_day is not None)


def test_batch_form_of_the_same_aggregation(rows):
    static = rows([(START, "eu", Decimal(1)), (START, "eu", Decimal(2))], "ts timestamp, region string, amount decimal(12,2)")
    assert values(orders.windowed_revenue(static, "ts", "region", "amount"), "daily_revenue") == [(Decimal(3),)]


@pytest.mark.parametrize("on_disk", [False, True])
def test_dedup_across_batches(spark, rows, tmp_path, on_disk):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    if on_disk:
        use_disk_state(spark)
    path, schema = str(tmp_path / "in"), "id int, ts timestamp"
    for _ in range(3):
        drop(rows([(1, START), (2, START)], schema), path)
    once = orders.stream_dedup(folder_stream(spark, path, schema), "id", "ts")
    try:
        assert values(sinks.run_to_table(once, str(tmp_path / "out"), str(tmp_path / "state")), "id") == [(1,), (2,)]
    finally:
        spark.conf.set(provider, before)


def test_restart_continues_from_the_checkpoint(spark, rows, tmp_path):
    path, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for n in range(2):
        drop(rows([(n,)], "id int"), path)
        table = sinks.run_to_table(folder_stream(spark, path, "id int"), out, state)
    assert values(table) == [(0,), (1,)]


def test_totals_count_each_batch_once(spark, rows, tmp_path):
    totals = sinks.TotalsTable(str(tmp_path / "totals"), ["day"], ["revenue", "lines"])
    assert totals.read(spark) is None

    def batch(day, amount):
        return rows([(day, Decimal(amount), 1)], "day string, revenue decimal(28,2), lines long")

    totals.upsert(batch("mon", 1), 0)
    totals.upsert(batch("mon", 2), 1)
    totals.upsert(batch("mon", 2), 1)  # repeated after a failure
    totals.upsert(batch("tue", 4), 2)
    assert values(totals.read(spark)) == [("mon", Decimal(3), 2), ("tue", Decimal(4), 1)]
    for n in range(3, 12):
        totals.upsert(batch("wed", 1), n)
    assert values(totals.read(spark)) == [("mon", Decimal(3), 2), ("tue", Decimal(4), 1), ("wed", Decimal(9), 9)]


def test_totals_rewrite_touched_days_only(spark, rows, tmp_path):
    path = tmp_path / "totals"
    totals = sinks.TotalsTable(str(path), ["day"], ["revenue", "lines"])
    schema = "day string, revenue decimal(28,2), lines long"
    totals.upsert(rows([("mon", Decimal(1), 1), (None, Decimal(2), 1), ("", Decimal(4), 1), ("null", Decimal(8), 1)], schema), 0)
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    totals.upsert(rows([("tue", Decimal(1), 1), (None, Decimal(16), 1)], schema), 1)
    after = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) == len(before) + 2  # tue, and the other slot of null
    found = {r["day"]: int(r["revenue"]) for r in totals.read(spark).collect()}
    assert found == {"mon": 1, "tue": 1, None: 18, "": 4, "null": 8}


def test_totals_after_a_batch_that_got_through_in_part(spark, rows, tmp_path):
    schema = "day string, revenue decimal(28,2), lines long"
    totals = sinks.TotalsTable(str(tmp_path / "totals"), ["day"], ["revenue", "lines"])
    totals.upsert(rows([("mon", Decimal(1), 1), ("tue", Decimal(1), 1)], schema), 0)
    totals.upsert(rows([("mon", Decimal(2), 1)], schema), 1)  # tuesday's part of the batch was lost
    totals.upsert(rows([("mon", Decimal(2), 1), ("tue", Decimal(3), 1)], schema), 1)
    assert values(totals.read(spark)) == [("mon", Decimal(3), 2), ("tue", Decimal(4), 2)]


def test_stream_upsert_over_several_batches(spark, rows, tmp_path):
    path, schema = str(tmp_path / "in"), "day string, revenue decimal(28,2), lines long"
    for amount in (1, 2, 3):
        drop(rows([("mon", Decimal(amount), 1)], schema), path)
    totals = sinks.TotalsTable(str(tmp_path / "totals"), ["day"], ["revenue", "lines"])
    query = sinks.upsert_stream(folder_stream(spark, path, schema), totals, str(tmp_path / "state"))
    query.awaitTermination()
    assert values(totals.read(spark)) == [("mon", Decimal(6), 3)]


def test_stream_validation_against_static_dimensions(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    schema = "order_id string, customer_id string, product_id string, quantity int, unit_price decimal(12,2), order_ts string"
    ts = "2024-01-01T10:00:00"
    drop(rows([("o1", "c1", "p1", 2, Decimal(3), ts), ("o2", "c9", "p1", 2, Decimal(3), ts), ("o3", "c1", "p1", 2, None, ts)], schema), path)
    dims = rows([("c1",)], "customer_id string"), rows([("p1",)], "product_id string")
    valid = orders.stream_valid_orders(folder_stream(spark, path, schema), *dims)
    table = sinks.run_to_table(valid, str(tmp_path / "out"), str(tmp_path / "state"))
    assert values(table, "order_id", "line_total") == [("o1", Decimal(6))]


def test_streaming_fact_is_valid_and_unique(spark, rows, tmp_path):
    path = str(tmp_path / "in")
    schema = "order_id string, customer_id string, product_id string, quantity int, unit_price decimal(12,2), order_ts string"
    ts = "2024-01-01T10:00:00"
    for amount in (None, Decimal(3), Decimal(3)):  # the invalid copy comes first and must not win
        drop(rows([("o1", "c1", "p1", 2, amount, ts), (None, "c1", "p1", 1, Decimal(1), ts)], schema), path)
    dims = rows([("c1",)], "customer_id string"), rows([("p1",)], "product_id string")
    fact = orders.stream_fct_orders(folder_stream(spark, path, schema), *dims)
    table = sinks.run_to_table(fact, str(tmp_path / "out"), str(tmp_path / "state"))
    assert values(table, "order_id", "line_total") == [("o1", Decimal(6))]


def test_late_audit_counts_strictly_later_rows(rows):
    minutes = [0, 5, 6, 15, 16]
    data = [(START, START + dt.timedelta(minutes=m)) for m in minutes]
    audit = orders.late_data_audit(rows(data, "ts timestamp_ntz, arrival timestamp_ntz"), "ts", "arrival", [5, 15])
    assert values(audit) == [(15, 5, 1), (5, 5, 3)]
