"""Keyed messages from a topic, or from files laid out like one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import ENVELOPE_SCHEMA

ORIGIN = "origin"
POSITION = "position"


def _as_text(messages: DataFrame, format: str) -> DataFrame:
    """Text columns, and where a message comes from: a place in a topic, or a part of a file.

    ``origin`` has ``arrived`` and ``source``, and ``nth`` where the source gives
    each message a number, else the ``block`` of the file it lies in.
    """
    if format == "kafka":
        source = F.concat_ws("/", "topic", "partition")
        origin = F.struct(
            F.lit(None).cast("timestamp").alias("arrived"), source.alias("source"),
            F.col("offset").alias("nth"),
        )
    else:
        file = F.col("_metadata")
        origin = F.struct(
            file["file_modification_time"].alias("arrived"), file["file_path"].alias("source"),
            file["file_block_start"].alias("block"),
        )
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
        origin.alias(ORIGIN),
    )


def positioned(messages: DataFrame) -> DataFrame:
    """``origin`` replaced by ``position`` (arrived, source, nth), which names one message.

    Positions compare as messages follow each other: by offset within a topic's
    partition, by time of writing, path and line for files. Lines are counted per
    block of a file, and only these counts are shuffled. Apply this to a topic as
    read, before any filter; inside a stream, to a batch.
    """
    fields = messages.schema[ORIGIN].dataType.fieldNames()
    others = [c for c in messages.columns if c != ORIGIN]
    if "nth" in fields:
        return messages.select(*others, F.col(ORIGIN).alias(POSITION))
    # The rows of a block lie in one task, one after another.
    marked = messages.withColumn("_row", F.monotonically_increasing_id())
    blocks = marked.groupBy(
        F.col(f"{ORIGIN}.source").alias("_source"), F.col(f"{ORIGIN}.block").alias("_block")
    ).agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_source").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    here = (F.col(f"{ORIGIN}.source") == F.col("_source")) & (
        F.col(f"{ORIGIN}.block") == F.col("_block")
    )
    nth = F.col("_before") + F.col("_row") - F.col("_first")
    return marked.join(starts, here).select(*others, F.struct(
        f"{ORIGIN}.arrived", f"{ORIGIN}.source", nth.alias("nth")
    ).alias(POSITION))


def kafka_options(servers: str, topic: str, starting: str = "latest", **extra: str) -> dict:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **extra,
    }


def stream_topic(spark: SparkSession, format: str = "kafka", **options: str) -> DataFrame:
    """An unbounded table (key, value, timestamp, origin).

    For ``kafka`` pass ``kafka_options``; ``maxOffsetsPerTrigger`` bounds a
    batch. Any file format works too, given ``path``; there
    ``maxFilesPerTrigger`` bounds a batch.
    """
    reader = spark.readStream.format(format)
    if format != "kafka":
        reader = reader.schema(ENVELOPE_SCHEMA)
    return _as_text(reader.options(**options).load(), format)


def read_topic(
    spark: SparkSession, format: str = "kafka", positions: bool = False, **options: str
) -> DataFrame:
    """The same table as of now, for batch jobs; with ``positions`` each message has its own."""
    reader = spark.read.format(format)
    if format != "kafka":
        reader = reader.schema(ENVELOPE_SCHEMA)
    messages = _as_text(reader.options(**options).load(), format)
    return positioned(messages) if positions else messages
