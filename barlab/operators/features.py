"""Rolling indicators of a bar table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import prices
from ..schemas import PROCESSED_COLUMNS
from .series import over_series

SHORT_ROWS = 5
LONG_ROWS = 20


def _mean(rows: int):
    return lambda w: F.avg("Close").over(w.rowsBetween(1 - rows, 0))


def _spread(rows: int):
    return lambda w: F.stddev_samp("Close").over(w.rowsBetween(1 - rows, 0))


def price_features(bars: DataFrame) -> DataFrame:
    return bars.withColumns({
        "Range": prices.bar_range(),
        "Change": prices.change(),
        "ChangePct": prices.change_pct(),
    })


def gain_loss(bars: DataFrame) -> DataFrame:
    """Split the bar's move into its upward and downward part."""
    return bars.withColumns({
        "Gain": prices.gain(prices.change()),
        "Loss": prices.loss(prices.change()),
    })


def rolling_ma(bars: DataFrame, chunk_days: int | None = None) -> DataFrame:
    builds = {"MA5": _mean(SHORT_ROWS), "MA20": _mean(LONG_ROWS)}
    return over_series(bars, builds, back=LONG_ROWS - 1, chunk_days=chunk_days)


def rolling_volatility(bars: DataFrame, chunk_days: int | None = None) -> DataFrame:
    builds = {"Volatility5": _spread(SHORT_ROWS)}
    return over_series(bars, builds, back=SHORT_ROWS - 1, chunk_days=chunk_days)


def bar_features(
    bars: DataFrame, strict_warmup: bool = False, chunk_days: int | None = None
) -> DataFrame:
    """The processed table: prices, rolling averages, volatility, gain and loss.

    A row is kept when its long average exists, which is already so for the
    first row of a series. ``strict_warmup`` asks for a full frame instead.
    """
    builds = {
        "MA5": _mean(SHORT_ROWS), "MA20": _mean(LONG_ROWS), "Volatility5": _spread(SHORT_ROWS),
    }
    if strict_warmup:
        builds["_frame"] = lambda w: F.count("*").over(w.rowsBetween(1 - LONG_ROWS, 0))
    rolled = over_series(
        gain_loss(price_features(bars)), builds, back=LONG_ROWS - 1, chunk_days=chunk_days
    ).filter(F.col("MA20").isNotNull())
    if strict_warmup:
        rolled = rolled.filter(F.col("_frame") == LONG_ROWS)
    return rolled.select(*PROCESSED_COLUMNS)
