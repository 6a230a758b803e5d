"""Messages to typed documents, their collections, and checks on what was stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fields import json_field, number
from .forecast import RECURSIVE_MODEL

# Which model goes to which collection, and the fields kept as text.
COLLECTIONS = {
    "RandomForest": "rf_predictions",
    "GradientBoostedTrees": "gbt_predictions",
    "LogisticRegression": "lr_signals",
}
FORECAST_MODELS = (RECURSIVE_MODEL, "RandomForest_h1_recursive")
TEXT_FIELDS = ("Date", "Pair", "model", "Actual", "Signal")

FORECASTS = "forecasts"
REJECTS = "rejects"

NUMBER_FIELDS = ("Close", "Actual_h1", "RF_Predicted", "GBT_Predicted")


def collection_of(model: Column) -> Column:
    target = F.when(model.isin(*FORECAST_MODELS), F.lit(FORECASTS))
    for name, collection in COLLECTIONS.items():
        target = target.when(model == name, F.lit(collection))
    return target.otherwise(F.lit(REJECTS))


def documents(messages: DataFrame, known_only: bool = False) -> DataFrame:
    """One document per message, with its collection.

    The five text fields stay text. The known numeric fields become doubles;
    one that does not parse, and every further field, is kept in the maps
    ``texts`` or ``numbers`` by the same rule, so no field is lost. Messages of
    an unknown model, or that are no JSON object, go to ``rejects`` with their
    value; ``known_only`` keeps just the three prediction collections.
    """
    if known_only:
        messages = messages.filter(json_field("value", "model").isin(*COLLECTIONS))
    fields = F.from_json("value", "map<string,string>")
    parsed = messages.withColumn("fields", fields)
    get = F.col("fields").getItem
    routed = parsed.withColumn("collection", collection_of(get("model")))

    def is_number(name: Column, value: Column) -> Column:
        return ~name.isin(*TEXT_FIELDS) & number(value).isNotNull()

    extra_numbers = F.map_filter(
        "fields", lambda k, v: is_number(k, v) & ~k.isin(*NUMBER_FIELDS)
    )
    extra_texts = F.map_filter("fields", lambda k, v: ~is_number(k, v) & ~k.isin(*TEXT_FIELDS))
    return routed.select(
        "collection", "key", "value", *[c for c in messages.columns if c == "position"],
        *[get(name).alias(name) for name in TEXT_FIELDS],
        *[number(get(name)).alias(name) for name in NUMBER_FIELDS],
        F.transform_values(extra_numbers, lambda _, v: number(v)).alias("numbers"),
        extra_texts.alias("texts"),
    )


def typed_fields(messages: DataFrame) -> DataFrame:
    """Field by field view of the typing rule: (key, value, field, number, text)."""
    exploded = messages.select(
        "key", "value", F.explode(F.from_json("value", "map<string,string>")).alias("field", "raw")
    )
    as_number = F.when(~F.col("field").isin(*TEXT_FIELDS), number("raw"))
    return exploded.select(
        "key", "value", "field", as_number.alias("number"),
        F.when(as_number.isNull(), F.col("raw")).alias("text"),
    )


def collection_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("collection").agg(F.count("*").alias("documents"))


def sample_documents(docs: DataFrame) -> DataFrame:
    """One whole document per collection, the first by (time, key).

    The earliest time of each collection is found by an aggregation that needs
    no sort; only the documents of that time are then ranked. That table has one
    row per collection, of which there are five, so it is broadcast.
    """
    stamp = F.coalesce("Date", F.col("texts")["trigger_date"]).try_cast("timestamp_ntz")
    stamped = docs.withColumn("_stamp", stamp)
    earliest = stamped.groupBy("collection").agg(F.min("_stamp").alias("_first"))
    near = stamped.join(
        F.broadcast(earliest.withColumnRenamed("collection", "_collection")),
        (F.col("collection") == F.col("_collection")) & F.col("_stamp").eqNullSafe(F.col("_first")),
    )
    order = Window.partitionBy("collection").orderBy("key", "value")
    return (
        near.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select(*docs.columns)
    )


def reconcile(computed: DataFrame, stored: DataFrame) -> DataFrame:
    """Computed forecast rows with the stored close where there is one.

    Of several stored rows of an hour the newest by position counts; without
    positions they are taken to be equal.
    """
    keys = ["pair", "trigger_date", "hour"]
    newest = (
        F.max_by("predicted_close", "position") if "position" in stored.columns
        else F.max("predicted_close")
    )
    known = stored.filter("predicted_close is not null").groupBy(*keys).agg(
        newest.alias("stored_close")
    )
    return computed.join(known, keys, "left").select(
        *keys,
        F.coalesce("stored_close", "predicted_close").alias("close"),
        F.when(F.col("stored_close").isNull(), "computed").otherwise("stored").alias("source"),
    )


def _copies(stored: DataFrame) -> DataFrame:
    """How many documents there are of each position."""
    return stored.groupBy(
        F.col("position.source").alias("_source"), F.col("position.nth").alias("_nth")
    ).agg(F.count("*").alias("copies"))


def ledger_of(published: DataFrame, stored: DataFrame) -> DataFrame:
    """Every message of a topic with ``copies``, the documents a store holds of it.

    Messages and documents are matched by position, so equal messages count one
    by one, and texts are not compared.
    """
    held = _copies(stored)
    same = (F.col("position.source") == F.col("_source")) & (F.col("position.nth") == F.col("_nth"))
    return published.join(held, same, "left").select(
        *published.columns, F.coalesce("copies", F.lit(0)).alias("copies")
    )


def unstored(published: DataFrame, stored: DataFrame) -> DataFrame:
    """The messages of a topic that a store holds no document of."""
    return ledger_of(published, stored).filter("copies = 0").drop("copies")


def sink_summary(published: DataFrame, stored: DataFrame) -> DataFrame:
    """Per collection: messages published, stored, missing, and documents too many."""
    copies = F.col("copies")
    return (
        ledger_of(published, stored)
        .groupBy(collection_of(json_field("value", "model")).alias("collection"))
        .agg(
            F.count("*").alias("published"),
            F.count_if(copies > 0).alias("stored"),
            F.count_if(copies == 0).alias("missing"),
            F.sum(F.greatest(copies - 1, F.lit(0))).alias("repeated"),
        )
    )


def missing_rows(published: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Published rows whose key was never stored; null keys equal each other."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"p.{key}").eqNullSafe(F.col(f"s.{key}"))
    return published.alias("p").join(stored.select(*keys).alias("s"), same, "left_anti")
