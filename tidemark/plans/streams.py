"""Streaming queries.  Each runs over what is available, stops, and reads its table back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import validation
from tidemark.plans.domain import Domain, padded
from tidemark.plans.registry import query
from tidemark.streaming import orders, sinks

MONEY = "decimal(12,2)"


def order_events(events):
    """Events as raw order rows (works on static and streaming frames)."""
    return events.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("order_id"),
        F.when(F.col("event_id") % 89 == 0, "C-UNKNOWN").otherwise(padded("C", "user_id", 6)).alias("customer_id"),
        padded("P", "user_id", 5).alias("product_id"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
        F.col("value").cast(MONEY).alias("unit_price"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("order_ts"),
    )


def envelopes(events):
    """Events as broker rows; some payloads are garbage, some carry a wrong type."""
    payload = F.to_json(
        F.struct(
            F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("order_id"),
            padded("C", "user_id", 6).alias("customer_id"),
            padded("P", "user_id", 5).alias("product_id"),
            (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
            F.col("value").alias("unit_price"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("order_ts"),
        )
    )
    text = (
        F.when(F.col("event_id") % 97 == 0, F.lit("garbage"))
        .when(F.col("event_id") % 83 == 0, F.lit('{"order_id": "BROKEN", "quantity": "many"}'))
        .otherwise(payload)
    )
    return events.select(
        text.cast("binary").alias("value"),
        (F.col("user_id") % 2).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def ltz(events):
    """Watermarks need zoned timestamps; the files hold zone-less ones."""
    return events.withColumns(
        {"ts": F.col("ts").cast("timestamp"), "amount": F.col("value").cast(MONEY)}
    )


_EVENT_ORDERS = """
    SELECT event_id, ts, 'E' || event_id AS order_id,
           'C' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(6, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') AS customer_id,
           'P' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(5, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') AS product_id,
           CAST(event_id % 5 + 1 AS INTEGER) AS quantity, value AS unit_price, user_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') AS order_ts
    FROM events"""


@query(
    "orders_stream",
    f"""SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 'BROKEN' ELSE order_id END AS order_id,
               CASE WHEN event_id % 97 = 0 OR event_id % 83 = 0 THEN NULL ELSE customer_id END AS customer_id,
               CASE WHEN event_id % 97 = 0 OR event_id % 83 = 0 THEN NULL ELSE product_id END AS product_id,
               CASE WHEN event_id % 97 = 0 OR event_id % 83 = 0 THEN NULL ELSE quantity END AS quantity,
               CASE WHEN event_id % 97 = 0 OR event_id % 83 = 0 THEN NULL ELSE unit_price END AS unit_price,
               CASE WHEN event_id % 97 = 0 OR event_id % 83 = 0 THEN NULL ELSE order_ts END AS order_ts,
               CAST(user_id % 2 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, ts AS event_time
        FROM ({_EVENT_ORDERS})""",
)
def orders_stream(d: Domain):
    """Broker rows parsed and appended to the raw order table."""
    parsed = orders.parse_orders(envelopes(d.stream("events")))
    table = sinks.run_to_table(parsed, d.scratch("orders_raw"), d.scratch("orders_raw_state"))
    return table.drop("raw_payload", "_ingested_at").withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz")
    )


@query(
    "stream_daily_revenue",
    """SELECT date_trunc('day', ts) AS window_start, event_type,
              CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS daily_revenue
       FROM events GROUP BY 1, 2
       HAVING date_trunc('day', ts) + INTERVAL 1 DAY <=
              (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 15 MINUTE""",
)
def stream_daily_revenue(d: Domain):
    """Daily sums; a day is emitted once the watermark has passed its end."""
    totals = orders.stream_daily_revenue(ltz(d.stream("events")), "ts", "event_type", "amount")
    table = sinks.run_to_table(totals, d.scratch("daily_revenue"), d.scratch("daily_revenue_state"))
    return table.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "late_data_audit",
    """SELECT d AS delay_minutes, count(*) AS total_rows,
              count(*) FILTER (event_id % 20 > d) AS late_rows
       FROM events, (VALUES (5), (15)) v(d) GROUP BY 1""",
)
def late_data_audit(d: Domain):
    """How many rows a 5- or a 15-minute delay would miss."""
    lag = F.make_dt_interval(mins=(F.col("event_id") % 20).cast("int"))
    arrived = d.table("events").withColumn("arrival", F.col("ts") + lag)
    return orders.late_data_audit(arrived, "ts", "arrival", [5, 15])


_VALID_EVENT_ORDERS = f"""
    SELECT o.order_id, o.customer_id, o.product_id, quantity, CAST(o.unit_price AS DECIMAL(12,2)) AS unit_price,
           CAST(quantity * CAST(o.unit_price AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS line_total,
           date_trunc('second', ts) AS order_ts
    FROM ({_EVENT_ORDERS}) o
    WHERE event_id % 89 <> 0 AND CAST(o.unit_price AS DECIMAL(12,2)) > 0
      AND customer_id IN (SELECT customer_id FROM customers)
      AND product_id IN (SELECT product_id FROM products)"""


@query("stream_dedup", _VALID_EVENT_ORDERS)
def stream_dedup(d: Domain):
    """Every order event delivered twice; the fact holds each valid order once."""
    twice = d.stream("events").unionByName(d.stream("events"))
    once = orders.stream_fct_orders(order_events(twice), d.customer_keys, d.products)
    return sinks.run_to_table(once, d.scratch("orders_once"), d.scratch("orders_once_state"))


@query(
    "stream_quarantine",
    f"""SELECT o.order_id, o.customer_id, ok, copies FROM (
          SELECT *, event_id % 89 <> 0 AND CAST(unit_price AS DECIMAL(12,2)) > 0
                 AND customer_id IN (SELECT customer_id FROM customers)
                 AND product_id IN (SELECT product_id FROM products) AS ok,
                 CASE WHEN event_id % 89 = 0 THEN 'C-UNKNOWN' ELSE customer_id END AS cid
          FROM ({_EVENT_ORDERS})) x
        JOIN (SELECT order_id, CASE WHEN event_id % 89 = 0 THEN 'C-UNKNOWN' ELSE customer_id END AS customer_id FROM ({_EVENT_ORDERS})) o
          USING (order_id), (VALUES (1), (2)) v(copies)
        WHERE copies = 1 OR NOT ok""",
)
def stream_quarantine(d: Domain):
    """Every order event delivered twice: good ones once, and all bad ones, from the same batches."""
    def flag(batch):
        return validation.flag_orders(batch, d.customer_keys, d.products)

    twice = order_events(d.stream("events").unionByName(d.stream("events")))
    sink = sinks.ValidatedSink(d.scratch("orders_checked"), flag, "order_id", "order_ts")
    sinks.validate_stream(twice, sink, d.scratch("orders_checked_state")).awaitTermination()
    good = sink.read(d.spark, True).select("order_id", "customer_id", F.lit(True).alias("ok"), F.lit(1).alias("copies"))
    bad = sink.read(d.spark, False).groupBy("order_id", "customer_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    each = bad.select("order_id", "customer_id", F.lit(False).alias("ok"), F.explode(F.sequence(F.lit(1), "n")).alias("copies"))
    return good.unionByName(each)


@query(
    "watermark_losses",
    """WITH late AS (SELECT event_id, ts, ts + (event_id % 20) * INTERVAL 1 HOUR AS arrival FROM events),
            ends AS (SELECT min(arrival) AS a, max(arrival) AS b FROM late),
            parts AS (SELECT event_id, ts, CAST(least(2, floor(3 * (epoch_us(arrival) - epoch_us(a)) / (epoch_us(b) - epoch_us(a)))) AS INTEGER) AS part
                      FROM late, ends),
            tops AS (SELECT part, max(ts) AS top FROM parts GROUP BY 1)
       SELECT hours AS delay_hours, count(*) AS total_rows,
              count(*) FILTER (ts <= (SELECT max(top) FROM tops WHERE tops.part < parts.part) - hours * INTERVAL 1 HOUR) AS dropped_rows
       FROM parts, (VALUES (5), (15)) v(hours) GROUP BY 1""",
)
def watermark_losses(d: Domain):
    """Rows that a stream over three arriving parts loses to a watermark of 5 and of 15 hours."""
    lag = F.make_dt_interval(hours=(F.col("event_id") % 20).cast("int"))
    late = d.table("events").select("event_id", "ts", (F.col("ts") + lag).alias("arrival"))
    at = F.unix_micros(F.col("arrival").cast("timestamp"))
    low, high = late.agg(F.min(at), F.max(at)).first()
    part = F.least(F.lit(2), F.floor(3 * (at - F.lit(low)) / F.lit(max(high - low, 1)))).cast("int")
    source = d.scratch("late_events")
    parts = late.select("event_id", F.col("ts").cast("timestamp").alias("ts"), part.alias("part"))
    states = {hours: (d.scratch(f"late_{hours}"), d.scratch(f"late_{hours}_state")) for hours in (5, 15)}
    dropped = dict.fromkeys(states, 0)
    for n in range(3):
        parts.filter(F.col("part") == n).drop("part").write.mode("append").parquet(source)
        for hours, (path, state) in states.items():
            arriving = d.spark.readStream.schema("event_id long, ts timestamp").parquet(source)
            once = orders.stream_dedup(arriving, "event_id", "ts", f"{hours} hours")
            dropped[hours] += sinks.run_counted(once, path, state)[1]
    total = d.table("events").count()
    losses = [(hours, total, n) for hours, n in dropped.items()]
    return d.spark.createDataFrame(losses, "delay_hours int, total_rows long, dropped_rows long")


@query(
    "stream_upsert_revenue",
    """SELECT CAST(ts AS DATE) AS order_date, event_type,
              CAST(sum(CAST(value AS DECIMAL(12,2))) AS DECIMAL(28,2)) AS revenue, count(*) AS lines
       FROM events GROUP BY 1, 2""",
)
def stream_upsert_revenue(d: Domain):
    """Running daily totals, folded in batch by batch."""
    rows = d.stream("events").select(
        F.col("ts").cast("date").alias("order_date"),
        "event_type",
        F.col("value").cast("decimal(28,2)").alias("revenue"),
        F.lit(1).cast("long").alias("lines"),
    )
    totals = sinks.TotalsTable(d.scratch("totals"), ["order_date", "event_type"], ["revenue", "lines"])
    sinks.upsert_stream(rows, totals, d.scratch("totals_state")).awaitTermination()
    return totals.read(d.spark)


@query("stream_static_join", _VALID_EVENT_ORDERS)
def stream_static_join(d: Domain):
    """A stream of orders validated against static dimensions."""
    valid = orders.stream_valid_orders(order_events(d.stream("events")), d.customer_keys, d.products)
    return sinks.run_to_table(valid, d.scratch("orders_valid"), d.scratch("orders_valid_state"))


@query(
    "stream_quality_drop",
    """SELECT event_id, event_type, value FROM events
       WHERE value > 5 AND event_type IN ('click', 'purchase', 'view')""",
)
def stream_quality_drop(d: Domain):
    rules = {
        "amount_in_bounds": (F.col("value") > 5) & (F.col("value") < 1_000_000),
        "type_known": F.col("event_type").isin("click", "purchase", "view"),
    }
    kept = orders.stream_quality_drop(d.stream("events"), rules).select("event_id", "event_type", "value")
    return sinks.run_to_table(kept, d.scratch("events_kept"), d.scratch("events_kept_state"))
