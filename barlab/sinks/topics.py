"""Publishing keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish(messages: DataFrame, format: str = "kafka", **options: str) -> None:
    """Append (key, value[, timestamp]) rows to a topic or to topic-like files.

    Kafka needs ``kafka.bootstrap.servers`` and ``topic``; producer settings go
    in as further ``kafka.`` options, e.g. ``{"kafka.acks": "all"}``.
    """
    if format != "kafka" and "timestamp" not in messages.columns:
        messages = messages.withColumn("timestamp", F.current_timestamp())
    messages.write.format(format).mode("append").options(**options).save()
