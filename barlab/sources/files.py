"""CSV and Parquet scans of bars and predictions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PROCESSED_SCHEMA, RAW_SCHEMA
from .ticks import TIMEFRAMES

# The instruments the file grid covers.
PAIRS = (
    "AUDJPY", "AUDUSD", "EURAUD", "EURCHF", "EURGBP",
    "EURJPY", "EURUSD", "GBPAUD", "GBPCAD", "GBPJPY",
    "GBPUSD", "NZDUSD", "USDCAD", "USDCHF", "USDJPY",
)

CORRUPT = "_corrupt_record"

# How an absent value may be spelled in files written by other programs.
NULL_TEXT = "null"


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, **options: str
) -> DataFrame:
    """Header CSV with a given schema, so no pass over the data to infer one."""
    options = {"header": "true", "nullValue": NULL_TEXT, **options}
    return spark.read.schema(schema).options(**options).csv(paths)


def read_bars(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    return read_csv(spark, paths, schema)


def read_processed(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """Processed bars, from CSV files or the Parquet table; both prune by partition folder."""
    if format == "csv":
        return read_csv(spark, path, PROCESSED_SCHEMA).select(*PROCESSED_SCHEMA.names)
    reader = spark.read.schema(PROCESSED_SCHEMA).format(format)
    return reader.load(path).select(*PROCESSED_SCHEMA.names)


def _grid_patterns(base: str, pairs: Iterable[str], timeframes: Iterable[str], prefix: str):
    return f"{base}/{prefix}{{{','.join(pairs)}}}_{{{','.join(timeframes)}}}_*.csv"


def tag_from_path(path) -> dict:
    """Pair and Timeframe out of ``…/{pair}_{timeframe}_….csv``."""
    pattern = rf"([^/_=]+)_({'|'.join(TIMEFRAMES)})_[^/]*\.csv"
    return {
        "Pair": F.regexp_extract(path, pattern, 1),
        "Timeframe": F.regexp_extract(path, pattern, 2),
    }


def read_bar_grid(
    spark: SparkSession,
    base: str,
    pairs: Iterable[str] = PAIRS,
    timeframes: Iterable[str] = tuple(TIMEFRAMES),
    prefix: str = "",
    schema: T.StructType = RAW_SCHEMA,
    mark_corrupt: bool = False,
) -> DataFrame:
    """All existing files of a pairs × timeframes grid in one scan, tagged by file name.

    Files of the grid that do not exist are passed over; if there is none, the
    result is empty. ``mark_corrupt`` adds ``_corrupt_record``, the text of a
    line that does not fit the schema, and ``file``.
    """
    options = {}
    if mark_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}
    try:
        found = read_csv(spark, _grid_patterns(base, pairs, timeframes, prefix), schema, **options)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], schema)
        tags = {"Pair": F.lit(""), "Timeframe": F.lit("")}
        file = F.lit("")
    else:
        empty = found
        file = F.col("_metadata.file_path")
        tags = tag_from_path(file)
    if mark_corrupt:
        tags["file"] = file
    tagged = empty.select("*", *[c.alias(n) for n, c in tags.items()])
    first, *rest = schema.names
    return tagged.select(first, "Pair", "Timeframe", *rest, *(["file"] if mark_corrupt else []))


def unusable() -> Column:
    """Whether a bar read with ``mark_corrupt`` must not enter a window."""
    return F.col(CORRUPT).isNotNull() | F.col("Date").isNull() | F.col("Close").isNull()


def read_permissive(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """All lines; one that does not fit the schema has its text in ``_corrupt_record``.

    Header and blank lines are left out. Lines are parsed one by one and by all
    their fields, so the verdict does not depend on the columns a query reads.
    Split the result with ``good_rows`` and ``rejected_rows``.
    """
    fields = [*schema.fields, T.StructField(CORRUPT, T.StringType())]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "nullValue": NULL_TEXT}
    line = F.trim("value")
    lines = spark.read.text(paths).filter((line != "") & (line != ",".join(schema.names)))
    return lines.select(F.from_csv("value", ddl, options).alias("row")).select("row.*")


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(CORRUPT).isNotNull())


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose fields are all kept as text, named by its header."""
    return spark.read.options(header="true", inferSchema="false").csv(path)


def read_first_existing(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """The first of several alternative CSV paths that exists, or None."""
    for path in paths:
        try:
            return read_text_csv(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return None
