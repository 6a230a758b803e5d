"""Lags, targets and the frame the models are trained on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import prices
from ..functions.fields import number
from ..schemas import HORIZON, NUMERIC_PROCESSED, TARGET_DIRECTION, TARGET_PRICE
from .series import over_series

_LAGS = {
    "Close_lag1": ("Close", 1), "Close_lag2": ("Close", 2), "Close_lag3": ("Close", 3),
    "Change_lag1": ("Change", 1), "Change_lag2": ("Change", 2),
}
_LAG_REACH = max(k for _, k in _LAGS.values())


def _lag_builds():
    return {
        name: lambda w, c=column, k=k: F.lag(c, k).over(w) for name, (column, k) in _LAGS.items()
    }


def _next_close():
    return {TARGET_PRICE: lambda w: F.lead("Close", 1).over(w)}


def _later_close(horizon: int):
    return {"_later": lambda w: F.lead("Close", horizon).over(w)}


def cast_numeric(df: DataFrame, columns=NUMERIC_PROCESSED) -> DataFrame:
    """The named columns as doubles; those that already are stay untouched."""
    others = [c for c in columns if df.schema[c].dataType != DoubleType()]
    return df.withColumns({c: number(c) for c in others}) if others else df


def lag_features(processed: DataFrame, chunk_days: int | None = None) -> DataFrame:
    return over_series(processed, _lag_builds(), back=_LAG_REACH, chunk_days=chunk_days)


def ma_ratio(processed: DataFrame) -> DataFrame:
    return processed.withColumn("MA5_MA20_Ratio", prices.ma_ratio(F.col("MA5"), F.col("MA20")))


def target_h1(bars: DataFrame, chunk_days: int | None = None) -> DataFrame:
    return over_series(bars, _next_close(), ahead=1, chunk_days=chunk_days)


def _label(later, strict: bool):
    up = F.when(later > F.col("Close"), F.lit(1.0))
    if strict:
        return up.when(later <= F.col("Close"), F.lit(0.0))
    return up.otherwise(F.lit(0.0))


def target_direction(
    bars: DataFrame, horizon: int = HORIZON, strict: bool = False, chunk_days: int | None = None
) -> DataFrame:
    """1.0 when the close ``horizon`` rows on is higher, else 0.0.

    A row with no bar that far ahead counts as "not up"; ``strict`` leaves its
    label NULL.
    """
    led = over_series(bars, _later_close(horizon), ahead=horizon, chunk_days=chunk_days)
    return led.withColumn(TARGET_DIRECTION, _label(F.col("_later"), strict)).drop("_later")


def training_frame(
    processed: DataFrame,
    horizon: int = HORIZON,
    strict_label: bool = False,
    chunk_days: int | None = None,
) -> DataFrame:
    """Processed rows with lags, ratio and both targets; rows with a NULL are dropped.

    All window columns come from one pass over the series.
    """
    windowed = over_series(
        cast_numeric(processed),
        {**_lag_builds(), **_next_close(), **_later_close(horizon)},
        back=_LAG_REACH, ahead=horizon, chunk_days=chunk_days,
    )
    labelled = ma_ratio(windowed).withColumn(
        TARGET_DIRECTION, _label(F.col("_later"), strict_label)
    )
    return labelled.drop("_later").na.drop()
