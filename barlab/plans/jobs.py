"""The batch jobs: prepare bars, train and publish, send triggers, bridge files."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, messages, models, split, training
from ..operators.forecast import trigger_rows
from ..schemas import TARGET_DIRECTION, TARGET_PRICE
from ..session import written
from ..sinks.files import write_processed, write_table
from ..sources.files import (
    CORRUPT, PAIRS, read_bar_grid, read_first_existing, read_processed, unusable,
)
from ..sources.ticks import TIMEFRAMES

Publish = Callable[[DataFrame], None]

# File names of the predictions, newest name first.
PREDICTION_FILES = {
    models.RANDOM_FOREST: ("rf_24h_predictions.csv", "rf_predictions.csv"),
    models.BOOSTED_TREES: ("gbt_24h_predictions.csv", "gbt_predictions.csv"),
    models.LOGISTIC: ("lr_24h_signals.csv", "lr_signals.csv"),
}
MODEL_FOLDER = "rf_h1_model"
PREDICTION_COLUMNS = {models.RANDOM_FOREST: "RF_Predicted", models.BOOSTED_TREES: "GBT_Predicted"}


def prepare(
    spark: SparkSession,
    source: str,
    target: str,
    pairs: Iterable[str] = PAIRS,
    timeframes: Iterable[str] = tuple(TIMEFRAMES),
    format: str = "parquet",
    rejects: str | None = None,
) -> None:
    """Raw bar files to the processed table, all series in one job.

    Lines that do not parse, and bars without a date or a close, never enter a
    window: a bad line costs that line only. With ``rejects`` they are written
    there as JSON with the name of their file; the files are then read once,
    into a table that both outputs are made from.
    """
    bars = read_bar_grid(spark, source, pairs, timeframes, mark_corrupt=True)
    if rejects:
        bars = written(bars, "raw-bars")
        bars.filter(unusable()).write.mode("overwrite").json(rejects)
    good = bars.filter(~unusable()).drop(CORRUPT, "file")
    write_processed(features.bar_features(good), target, format)


SCORED_COLUMNS = (
    "Date", "Pair", "Close", TARGET_PRICE, TARGET_DIRECTION, "prediction", "rawPrediction",
)


def prediction_table(scored: DataFrame, model: str) -> DataFrame:
    column = PREDICTION_COLUMNS.get(model)
    return models.price_predictions(scored, column) if column else models.signal_recode(scored)


def train(
    spark: SparkSession,
    processed: str,
    target: str,
    timeframe: str = "1h",
    pairs: Iterable[str] = PAIRS,
    estimators: Mapping[str, Estimator] | None = None,
    publish: Publish | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Train, score, save and optionally publish; returns the comparison table.

    The training frame is written once and read back by the split, the fits and
    the scoring; the scored test rows are written once and read back by the
    files, the messages and the comparison. Nothing is computed twice.
    """
    rows = read_processed(spark, processed, format).filter(
        (F.col("Timeframe") == timeframe) & F.col("Pair").isin(*pairs)
    )
    training.training_frame(rows).write.mode("overwrite").parquet(f"{target}/training_frame")
    frame = spark.read.parquet(f"{target}/training_frame")
    cut = split.split_date(frame).first()
    if cut is None:
        raise ValueError("no training rows; prepare the bars first")
    at = F.lit(cut["split_date"])
    fitted = models.fit_models(split.split_train(frame, at), estimators)
    test = split.split_test(frame, at)
    scored = {}
    for name, model in fitted.items():
        path = f"{target}/scored/{name}"
        predictions = models.score(model, test)
        kept = [c for c in SCORED_COLUMNS if c in predictions.columns]
        predictions.select(*kept).write.mode("overwrite").parquet(path)
        scored[name] = spark.read.parquet(path)
    tables = {}
    for name, predictions in scored.items():
        path = f"{target}/{PREDICTION_FILES[name][-1]}"
        write_table(prediction_table(predictions, name), path)
        tables[name] = prediction_table(predictions, name)
    if models.RANDOM_FOREST in fitted:
        fitted[models.RANDOM_FOREST].write().overwrite().save(f"{target}/{MODEL_FOLDER}")
    if publish:
        publish(messages.bridge_csv_json(tables))
    return models.model_comparison(scored)


def load_forecaster(target: str) -> PipelineModel:
    return PipelineModel.load(f"{target}/{MODEL_FOLDER}")


def send_triggers(
    spark: SparkSession,
    processed: str,
    publish: Publish,
    timeframe: str = "1h",
    pairs: Iterable[str] | None = None,
    full: bool = False,
    format: str = "parquet",
) -> None:
    """Publish the newest row of each series, or with ``full`` replay every row."""
    rows = read_processed(spark, processed, format).filter(F.col("Timeframe") == timeframe)
    if pairs is not None:
        rows = rows.filter(F.col("Pair").isin(*pairs))
    publish(messages.row_messages(rows if full else trigger_rows(rows)))


def bridge_predictions(spark: SparkSession, folder: str, publish: Publish) -> None:
    """Publish the prediction files that exist, under their newer or older name."""
    tables = {}
    for model, names in PREDICTION_FILES.items():
        found = read_first_existing(spark, [f"{folder}/{name}" for name in names])
        if found is not None:
            tables[model] = found
    if tables:
        publish(messages.bridge_csv_json(tables))
