"""Row-wise price arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bar_range() -> Column:
    return F.col("High") - F.col("Low")


def change() -> Column:
    return F.col("Close") - F.col("Open")


def change_pct() -> Column:
    """Percent move within the bar; NULL for a zero Open."""
    return F.try_divide(change(), F.col("Open")) * 100


def gain(move: Column) -> Column:
    return F.when(move > 0, move).otherwise(F.lit(0.0))


def loss(move: Column) -> Column:
    return F.when(move < 0, -move).otherwise(F.lit(0.0))


def ma_ratio(short: Column, long: Column, if_zero: float | None = None) -> Column:
    """Short over long average.

    Training leaves the ratio NULL when the long average is zero; triggers and
    the recursion put 1.0 there (``if_zero``). A NULL average stays NULL.
    """
    ratio = F.try_divide(short, long)
    return ratio if if_zero is None else F.when(long == 0, F.lit(if_zero)).otherwise(ratio)


def percent_of(part: Column, base: Column) -> Column:
    return F.try_divide(part, base) * 100


def signed_percent_text(move: Column, pct: Column) -> Column:
    """Percentage with four decimals, and a plus sign for moves that are not down."""
    sign = F.when(move >= 0, F.lit("+")).otherwise(F.lit(""))
    return F.concat(sign, F.format_string("%.4f%%", pct))
