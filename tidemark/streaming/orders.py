"""Order event streams.  The stateless functions also accept a static frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.gold import windowed_revenue
from tidemark.operators.validation import Rules, fct_orders, flag_orders, keep_valid
from tidemark.sources import schemas


def parse_orders(envelopes: DataFrame, schema: str = schemas.ORDER_EVENT, delay: str = "10 minutes") -> DataFrame:
    """``value, partition, offset, timestamp`` to typed order columns plus the raw payload.

    A payload that is not JSON gives NULL columns; a field of the wrong type
    gives NULL in that field.  Nothing is dropped here.
    """
    rows = envelopes.select(
        F.col("value").cast("string").alias("raw_payload"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.col("timestamp").cast("timestamp").alias("event_time"),
    )
    if rows.isStreaming:
        rows = rows.withWatermark("event_time", delay)
    parsed = rows.withColumn("_order", F.from_json("raw_payload", schema))
    return parsed.select(
        "_order.*",
        "raw_payload",
        "kafka_partition",
        "kafka_offset",
        "event_time",
        F.current_timestamp().alias("_ingested_at"),
    )


def stream_daily_revenue(
    stream: DataFrame, ts: str, dimension: str, amount: str, delay: str = "15 minutes"
) -> DataFrame:
    """Watermarked tumbling-day sums; state is bounded by the open days."""
    return windowed_revenue(stream.withWatermark(ts, delay), ts, dimension, amount)


def stream_dedup(stream: DataFrame, key: str, ts: str, delay: str = "10 minutes") -> DataFrame:
    """First row per key; a key is remembered only for the length of the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_valid_orders(stream: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Validate a stream of raw orders against static dimensions (stream-static joins)."""
    return fct_orders(flag_orders(stream, customers, products))


def stream_fct_orders(
    stream: DataFrame, customers: DataFrame, products: DataFrame, delay: str = "10 minutes"
) -> DataFrame:
    """The streaming order fact: validated, then one row per order id.

    Validation comes first, because rows without an id would all count as
    duplicates of each other.
    """
    valid = stream_valid_orders(stream, customers, products)
    timed = valid.withColumn("order_ts", F.col("order_ts").cast("timestamp"))
    once = stream_dedup(timed, "order_id", "order_ts", delay)
    return once.withColumn("order_ts", F.col("order_ts").cast("timestamp_ntz"))


def stream_quality_drop(stream: DataFrame, rules: Rules) -> DataFrame:
    """Drop stream rows that fail a rule, before they reach a table."""
    return keep_valid(stream, rules)


def late_data_audit(events: DataFrame, ts: str, arrival: str, delays: list[int]) -> DataFrame:
    """Rows arriving more than each delay (minutes) after their own time, in one pass."""
    lag = F.timestamp_diff("SECOND", F.col(ts), F.col(arrival))
    counts = events.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(lag > 60 * d).alias(f"_late_{d}") for d in delays],
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(d).alias("delay_minutes"),
                        F.col("_rows").alias("total_rows"),
                        F.col(f"_late_{d}").alias("late_rows"),
                    )
                    for d in delays
                ]
            )
        )
    )
