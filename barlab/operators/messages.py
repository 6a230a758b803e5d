"""JSON messages: building, parsing, bridging from CSV, counting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.fields import number, text, text_json
from ..schemas import FEATURES, FORECAST_SCHEMA, TRIGGER_SCHEMA


def row_messages(rows: DataFrame, key: str = "Pair") -> DataFrame:
    """Every row as an object of text fields, keyed by pair; its date is the message time."""
    return rows.select(
        F.col(key).alias("key"),
        text_json(rows.columns).alias("value"),
        F.col("Date").cast("timestamp").alias("timestamp"),
    )


def parse_triggers(messages: DataFrame) -> DataFrame:
    """Triggers out of messages, batch or stream: three text fields and 19 numbers.

    Messages without a close or a first lag are no triggers; that includes
    malformed ones, whose fields are all NULL.
    """
    return (
        _parsed(messages.filter(F.col("value").isNotNull()), TRIGGER_SCHEMA, "timestamp")
        .select(
            F.col("timestamp").alias("kafka_timestamp"), "Date", "Pair", "Timeframe",
            *[number(name).alias(name) for name in FEATURES],
        )
        .filter(F.col("Close").isNotNull() & F.col("Close_lag1").isNotNull())
    )


def _parsed(messages: DataFrame, schema: StructType, *keep: str) -> DataFrame:
    """The fields of the JSON values as columns.

    As a one-element ``inline`` the text is parsed once per message; filters on
    a plain ``from_json`` column would parse it again for every field they test.
    """
    return messages.select(*keep, F.inline(F.array(F.from_json("value", schema))))


def tagged_messages(rows: DataFrame, model: str) -> DataFrame:
    """Rows as text-field objects led by the model name; key is Pair, else the model."""
    key = text("Pair") if "Pair" in rows.columns else F.lit(model)
    value = text_json(rows.columns, first={"model": F.lit(model)})
    return rows.select(key.alias("key"), value.alias("value"))


def bridge_csv_json(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Messages of several prediction tables, keyed by model name, in one table."""
    parts = [tagged_messages(rows, model) for model, rows in tables.items()]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def publish_predictions_json(
    scored: DataFrame, tables: Mapping[str, Mapping[str, Column]], key: str = "Pair"
) -> DataFrame:
    """Messages of several models out of one table that holds what all have scored.

    ``tables`` gives, per model, the fields of its messages as expressions. Each
    row becomes one message per model, so the table is read once.
    """
    def message(model: str, fields: Mapping[str, Column]) -> Column:
        value = F.to_json(F.struct(
            F.lit(model).alias("model"), *(text(c).alias(name) for name, c in fields.items())
        ))
        return F.struct(text(key).alias("key"), value.alias("value"))

    return scored.select(F.inline(F.array(*(message(m, f) for m, f in tables.items()))))


def forecast_messages(forecasts: DataFrame) -> DataFrame:
    """Each forecast step as a keyed JSON object with typed fields."""
    return forecasts.select(
        F.col("pair").alias("key"),
        F.to_json(F.struct(*FORECAST_SCHEMA.names)).alias("value"),
    )


def parse_forecasts(messages: DataFrame) -> DataFrame:
    """The fields of forecast messages; a ``position`` of the messages stays."""
    return _parsed(messages, FORECAST_SCHEMA, *(c for c in messages.columns if c == "position"))


def publish_counts(messages: DataFrame) -> DataFrame:
    """Messages per model, as told by the messages themselves."""
    return messages.groupBy(F.get_json_object("value", "$.model").alias("model")).agg(
        F.count("*").alias("messages")
    )
