"""Batch windows, day sequences and zone-free epoch conversion."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The first and last millisecond of years 1 to 9999.
CALENDAR_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)


class BatchWindow(NamedTuple):
    """The half-open change-time interval one daily batch covers."""

    start: dt.datetime
    end: dt.datetime
    batch_id: str


def batch_window(as_of: dt.date) -> BatchWindow:
    """The day before ``as_of``: ``[as_of - 1 day, as_of)``."""
    end = dt.datetime(as_of.year, as_of.month, as_of.day)
    return BatchWindow(end - dt.timedelta(days=1), end, as_of.strftime("%Y%m%d"))


def batch_id(day: Column | str) -> Column:
    """``yyyyMMdd`` of a date or timestamp column."""
    return F.date_format(day, "yyyyMMdd")


def batch_window_columns(day: Column | str) -> list[Column]:
    """``batch_window`` as three columns of a frame that holds run dates."""
    day = F.col(day) if isinstance(day, str) else day
    day = day.cast("date")
    return [
        F.date_sub(day, 1).cast("timestamp_ntz").alias("window_start"),
        day.cast("timestamp_ntz").alias("window_end"),
        batch_id(day).alias("batch_id"),
    ]


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def from_epoch_millis(millis: Column) -> Column:
    """Milliseconds since 1970 as a zone-free timestamp, whatever the session zone; NULL outside years 1 to 9999."""
    moment = F.timestamp_add("MILLISECOND", millis, F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"))
    return F.when(millis.between(*CALENDAR_MILLIS), moment)


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970 of a zone-free timestamp, whatever the session zone."""
    days = F.date_diff(ts.cast("date"), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    millis = F.floor(F.extract(F.lit("SECOND"), ts) * 1000).cast("bigint")
    return days * 86400000 + F.hour(ts) * 3600000 + F.minute(ts) * 60000 + millis


def wire_timestamp(text: Column) -> Column:
    """A timestamp sent either as epoch milliseconds or as ISO text; NULL if neither."""
    is_number = text.rlike(r"^-?\d{1,18}$")
    return F.when(is_number, from_epoch_millis(text.cast("bigint"))).otherwise(text.try_cast("timestamp_ntz"))
