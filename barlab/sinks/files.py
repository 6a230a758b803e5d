"""Distributed writes of bars, predictions and signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SERIES


def write_processed(processed: DataFrame, path: str, format: str = "parquet") -> None:
    """The processed table, one folder per timeframe and pair.

    ``rebalance`` groups rows by folder but lets adaptive execution cut a folder
    that is too large for one task, so a dominant pair is written by many.
    """
    writer = (
        processed.hint("rebalance", "Timeframe", "Pair")
        .sortWithinPartitions("Timeframe", "Pair", "Date")
        .write.mode("overwrite").partitionBy("Timeframe", "Pair").format(format)
    )
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_bar_grid(bars: DataFrame, path: str, suffix: str = "bars") -> None:
    """Raw bars in one ``{pair}_{timeframe}_….csv`` folder per series."""
    name = F.concat_ws("_", *SERIES, F.lit(f"{suffix}.csv"))
    (
        bars.select("Date", "Open", "High", "Low", "Close", "Volume", name.alias("file"))
        .hint("rebalance", "file")
        .write.mode("overwrite").partitionBy("file").option("header", True).csv(path)
    )


def write_table(rows: DataFrame, path: str, order: tuple[str, ...] = ("Date", "Pair")) -> None:
    """CSV with header; files follow the global order of ``order``."""
    ordered = rows.orderBy(*order) if order else rows
    ordered.write.mode("overwrite").option("header", True).csv(path)
