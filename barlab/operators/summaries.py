"""Grouped statistics, top-k and unions over processed bars."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SERIES


def _frame(processed: DataFrame, timeframe: str) -> DataFrame:
    """One time frame: bars of several lengths never enter one figure."""
    return processed.filter(F.col("Timeframe") == timeframe)


def series_stats(processed: DataFrame) -> DataFrame:
    return processed.groupBy(*SERIES).agg(
        F.count("*").alias("records"),
        F.min("Date").alias("start"),
        F.max("Date").alias("end"),
        F.avg("Close").alias("avg_close"),
        F.min("Close").alias("min_close"),
        F.max("Close").alias("max_close"),
        F.avg("ChangePct").alias("avg_change"),
        F.avg("Volume").alias("avg_volume"),
        F.avg("Volatility5").alias("avg_volatility"),
    )


def pair_summary(processed: DataFrame, pair: str, timeframe: str) -> DataFrame:
    return _frame(processed, timeframe).filter(F.col("Pair") == pair).agg(
        F.count("*").alias("records"),
        F.min("Close").alias("min_close"),
        F.max("Close").alias("max_close"),
        F.avg("Close").alias("avg_close"),
        F.avg("ChangePct").alias("avg_change_pct"),
        F.avg("Volatility5").alias("avg_volatility"),
    )


def top_volatile(
    processed: DataFrame, pair: str, timeframe: str, count: int = 10
) -> DataFrame:
    return (
        _frame(processed, timeframe).filter(F.col("Pair") == pair)
        .select("Date", "Close", "ChangePct", "Volatility5")
        .orderBy(F.col("Volatility5").desc_nulls_last(), "Date")
        .limit(count)
    )


def monthly_summary(processed: DataFrame, pair: str, year: int, timeframe: str) -> DataFrame:
    """Monthly averages of one year; the year is a date range, so scans can skip by it."""
    first, beyond = (F.lit(datetime(y, 1, 1)).cast("timestamp_ntz") for y in (year, year + 1))
    return (
        _frame(processed, timeframe)
        .filter((F.col("Pair") == pair) & (F.col("Date") >= first) & (F.col("Date") < beyond))
        .groupBy(F.month("Date").cast("bigint").alias("month"))
        .agg(
            F.avg("Close").alias("avg_close"),
            F.avg("ChangePct").alias("avg_change"),
            F.count("*").alias("trading_days"),
        )
        .orderBy("month")
    )


def cross_pair_latest(processed: DataFrame, timeframe: str) -> DataFrame:
    return _frame(processed, timeframe).groupBy("Pair").agg(
        F.max("Date").alias("latest_date"),
        F.max_by("Close", "Date").alias("latest_close"),
        F.avg("Close").alias("avg_close"),
        F.avg("Volatility5").alias("avg_volatility"),
    )


def union_pairs(tables: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)
