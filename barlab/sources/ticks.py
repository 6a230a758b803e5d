"""Ticks to bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bar lengths and the truncation unit of each.
TIMEFRAMES = {"1d": "DAY", "1h": "HOUR", "1min": "MINUTE"}


def _cut_ntz(time: Column, unit: str) -> Column:
    """The start of a zone-free time's day, hour or minute."""
    day = F.to_date(time).cast("timestamp_ntz")
    if unit == "DAY":
        return day
    hours = F.make_dt_interval(F.lit(0), F.hour(time))
    if unit == "HOUR":
        return day + hours
    return day + F.make_dt_interval(F.lit(0), F.hour(time), F.minute(time))


def bars(
    ticks: DataFrame,
    timeframe: str,
    pair: str = "event_type",
    time: str = "ts",
    price: str = "value",
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """OHLCV bars of the given length; buckets without a tick have no bar.

    Ticks of one time are ordered by the columns ``ties``, then by price, so open
    and close do not depend on the order of arrival. Zone-free times are cut as
    they are, whatever the session's zone; others by the session's zone. All
    aggregates combine before the shuffle, so a pair with most of the ticks
    sends one row per bucket and task.
    """
    kind = ticks.schema[time].dataType.typeName()
    # A zone-free time is cut as if it were one of UTC, so no zone has a say in it.
    start = (
        _cut_ntz(F.col(time), TIMEFRAMES[timeframe]) if kind == "timestamp_ntz"
        else F.date_trunc(TIMEFRAMES[timeframe], F.col(time)).cast("timestamp_ntz")
    )
    order = F.struct(time, *ties, price)
    return (
        ticks.groupBy(F.col(pair).alias("Pair"), start.alias("Date"))
        .agg(
            F.min_by(price, order).alias("Open"),
            F.max(price).alias("High"),
            F.min(price).alias("Low"),
            F.max_by(price, order).alias("Close"),
            F.count("*").alias("Volume"),
        )
        .select(
            "Date", "Pair", F.lit(timeframe).alias("Timeframe"),
            "Open", "High", "Low", "Close", "Volume",
        )
    )
