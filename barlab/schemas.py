"""Column orders and types shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ("Pair", "Timeframe")
TIME = "Date"

# Column names and their order in the interchange formats.
PRICES = ("Open", "High", "Low", "Close")
RAW_COLUMNS = ("Date", "Open", "High", "Low", "Close", "Volume")
PROCESSED_COLUMNS = (
    "Date", "Pair", "Timeframe",
    "Open", "High", "Low", "Close", "Volume",
    "Range", "Change", "ChangePct",
    "MA5", "MA20", "Volatility5",
    "Gain", "Loss",
)
LAG_COLUMNS = ("Close_lag1", "Close_lag2", "Close_lag3", "Change_lag1", "Change_lag2")
FEATURES = (
    "Open", "High", "Low", "Close", "Volume",
    "Range", "Change", "ChangePct",
    "MA5", "MA20", "Volatility5",
    "Gain", "Loss",
    "Close_lag1", "Close_lag2", "Close_lag3",
    "Change_lag1", "Change_lag2",
    "MA5_MA20_Ratio",
)
TARGET_PRICE = "Close_h1"
TARGET_DIRECTION = "PriceDirection"
# Fixed value: the steps of a forecast.
HORIZON = 24

NUMERIC_PROCESSED = tuple(c for c in PROCESSED_COLUMNS if c not in ("Date", *SERIES))


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


RAW_SCHEMA = _struct(
    Date=T.TimestampNTZType(),
    **{c: T.DoubleType() for c in PRICES},
    Volume=T.LongType(),
)

PROCESSED_SCHEMA = _struct(**{
    c: T.TimestampNTZType() if c == "Date"
    else T.StringType() if c in SERIES
    else T.LongType() if c == "Volume"
    else T.DoubleType()
    for c in PROCESSED_COLUMNS
})

# Every field of a trigger travels as text and is cast after parsing.
# The field names of trigger and forecast messages, and their order.
TRIGGER_SCHEMA = _struct(**{c: T.StringType() for c in ("Date", "Pair", "Timeframe", *FEATURES)})

FORECAST_SCHEMA = _struct(
    pair=T.StringType(),
    hour=T.IntegerType(),
    predicted_close=T.DoubleType(),
    trigger_date=T.StringType(),
    model=T.StringType(),
    base_close=T.DoubleType(),
    current_close=T.DoubleType(),
    ma5=T.DoubleType(),
    ma20=T.DoubleType(),
    volatility5=T.DoubleType(),
    # Not in older messages: the series a forecast belongs to is (pair, timeframe).
    timeframe=T.StringType(),
)

# What a message looks like to every stream and batch reader of a topic.
ENVELOPE_SCHEMA = _struct(
    key=T.StringType(),
    value=T.StringType(),
    timestamp=T.TimestampType(),
)
