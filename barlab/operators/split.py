"""Chronological train / test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import FEATURES, TIME

# Fixed value: the share of the dates that is trained on.
TRAIN_SHARE = 0.8


def distinct_dates(df: DataFrame) -> DataFrame:
    return df.select(TIME).distinct()


def split_date(df: DataFrame, share: float = TRAIN_SHARE) -> DataFrame:
    """The distinct date at 0-based position ``floor(share * n)``, as one row.

    Dates are first counted per day. The running total over that table, one row
    per calendar day, names the day; only that day's dates are then ranked.
    """
    dates = distinct_dates(df).filter(F.col(TIME).isNotNull())
    per_day = dates.groupBy(F.to_date(TIME).alias("day")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_day.select(
        "day", "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(
            Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ).alias("total"),
    )
    position = F.floor(F.col("total") * F.lit(share))
    day = placed.filter(
        (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
    ).select("day", (position - F.col("before") + 1).alias("place"))
    rank = F.row_number().over(Window.partitionBy("day").orderBy(TIME))
    # At most one day satisfies the filter above, so the broadcast is one row.
    return (
        df.select(TIME, F.to_date(TIME).alias("day"))
        .join(F.broadcast(day), "day")
        .distinct()
        .withColumn("rank", rank)
        .filter(F.col("rank") == F.col("place"))
        .select(F.col(TIME).alias("split_date"))
    )


def _cut(df: DataFrame, at: Column | None, share: float) -> Column:
    return split_date(df, share).scalar() if at is None else at


def split_train(df: DataFrame, at: Column | None = None, share: float = TRAIN_SHARE) -> DataFrame:
    """Rows up to the split date; pass ``at`` when the date is already known."""
    return df.filter(F.col(TIME) <= _cut(df, at, share))


def split_test(df: DataFrame, at: Column | None = None, share: float = TRAIN_SHARE) -> DataFrame:
    return df.filter(F.col(TIME) > _cut(df, at, share))


def split_counts(
    df: DataFrame, at: Column | None = None, share: float = TRAIN_SHARE
) -> DataFrame:
    early = df.select((F.col(TIME) <= _cut(df, at, share)).alias("early"))
    return early.groupBy("early").count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("early"), F.col("count"))), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum(F.when(~F.col("early"), F.col("count"))), F.lit(0)).alias("test_rows"),
    ).withColumn("features", F.lit(len(FEATURES)).cast("bigint"))
