"""Parsing and bucketing of dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the incoming feeds, and the open end of a version.
ORDER_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
RETURN_DATE_FORMAT = "yyyy-MM-dd"
OPEN_END = "9999-12-31 00:00:00"


def parse_timestamp(text: Column, fmt: str = ORDER_TS_FORMAT) -> Column:
    """NULL, not an error, for text that does not fit the format."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def parse_date(text: Column, fmt: str = RETURN_DATE_FORMAT) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def day(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("date")


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp_ntz")


def moment(value: object) -> Column:
    """An ``as_of`` argument (text, date, datetime or Column) as a timestamp column."""
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp_ntz")
