"""Named queries. Each takes (session, table folder) and returns a DataFrame.

Bars come from the ``events`` table. Rolling, aggregated and recursive values
are rounded to six decimals, as the SQL they are compared with does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import json_field, number
from ..operators import documents as docs
from ..operators import (
    features, metrics, models, oscillators, series, split, summaries, training, validation,
)
from ..operators import forecast as fc
from ..operators import messages as msg
from ..schemas import FEATURES, LAG_COLUMNS, PROCESSED_COLUMNS, TARGET_DIRECTION, TARGET_PRICE
from ..session import fresh_dir, written
from ..sinks import files as out
from ..sinks.topics import publish
from ..sources import files, ticks, topics
from ..streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The stand-in for a trained model wherever results are compared with SQL.
MOMENTUM = 0.3141592653

# The pair and year the single-pair reports are about.
REPORT_PAIR = "view"
REPORT_YEAR = 2024

# A drained stream ends by itself; beyond this time it has failed.
DRAIN_SECONDS = 1800

ROLLING = ("MA5", "MA20", "Volatility5")
PRICE_KEY = ("Date", "Pair", "Timeframe", "Close")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _bars(spark: SparkSession, folder: str, timeframe: str = "1h") -> DataFrame:
    return ticks.bars(_events(spark, folder), timeframe)


def _processed(spark: SparkSession, folder: str) -> DataFrame:
    return features.bar_features(_bars(spark, folder))


def _all_frames(spark: SparkSession, folder: str) -> DataFrame:
    """The processed table as ``prepare`` makes it: every time frame in one table."""
    return features.bar_features(
        summaries.union_pairs([_bars(spark, folder, frame) for frame in ticks.TIMEFRAMES])
    )


def _stored_processed(spark: SparkSession, folder: str) -> DataFrame:
    """The processed table written first, as the jobs do, for steps that read it repeatedly."""
    return written(_processed(spark, folder), "processed")


def _frame(spark: SparkSession, folder: str) -> DataFrame:
    return training.training_frame(_stored_processed(spark, folder))


def _stored_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The training frame written once: the split and its users read it several times."""
    return written(_frame(spark, folder), "frame")


def momentum(close, lag1) -> Column:
    return close + F.lit(MOMENTUM) * (close - lag1)


def momentum_step(state: Column) -> Column:
    return momentum(state["Close"], state["Close_lag1"])


def _formula(rate: float):
    return lambda state: state["Close"] + F.lit(rate) * (state["Close"] - state["Close_lag1"])


def _saved_formula(spark: SparkSession) -> PipelineModel:
    """The same stand-in as a saved model, read back."""
    path = fresh_dir(spark, "model")
    statement = f"SELECT *, Close + {MOMENTUM}D * (Close - Close_lag1) AS prediction FROM __THIS__"
    PipelineModel(stages=[SQLTransformer(statement=statement)]).write().save(path)
    return PipelineModel.load(path)


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """The test rows with a price and a direction guessed from the last move."""
    return _score(_stored_frame(spark, folder))


def _score(frame: DataFrame) -> DataFrame:
    price = momentum(F.col("Close"), F.col("Close_lag1"))
    return split.split_test(frame).withColumns({
        "prediction": price,
        "direction": F.when(price > F.col("Close"), F.lit(1.0)).otherwise(F.lit(0.0)),
        "score": F.col("Close") - F.col("Close_lag1"),
    })


def _directed(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).withColumn("prediction", F.col("direction"))


# The fields of the messages of each model: its prediction is a column of the scored rows.
def _message_fields() -> dict[str, dict[str, Column]]:
    return {
        models.RANDOM_FOREST: models.price_fields("RF_Predicted"),
        models.BOOSTED_TREES: models.price_fields("GBT_Predicted", prediction="Close"),
        models.LOGISTIC: models.signal_fields(prediction="direction"),
    }


def _prediction_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    scored = _scored(spark, folder)
    return {
        model: scored.select(*(c.alias(name) for name, c in fields.items()))
        for model, fields in _message_fields().items()
    }


def _forecasts(spark: SparkSession, folder: str) -> DataFrame:
    return fc.forecast(fc.trigger_rows(_processed(spark, folder)), momentum_step)


def _all_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """Forecasts of every series of the table with all time frames."""
    return fc.forecast(fc.trigger_rows(_all_frames(spark, folder)), momentum_step)


def _all_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of three models, forecasts, and replayed bars, as one topic."""
    processed = _stored_processed(spark, folder)
    scored = _score(written(training.training_frame(processed), "frame"))
    predictions = msg.publish_predictions_json(scored, _message_fields())
    forecasts = msg.forecast_messages(fc.forecast(fc.trigger_rows(processed), momentum_step))
    replay = msg.row_messages(processed).select("key", "value")
    return predictions.unionByName(forecasts).unionByName(replay)


def _stored_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The same messages read back from the topic they were published to."""
    return topics.read_topic(spark, "parquet", path=_topic(spark, _all_messages(spark, folder)))


def _sunk_messages(spark: SparkSession, folder: str, known_only: bool) -> tuple[DataFrame, DataFrame]:
    """The messages of a topic, with positions, and the documents a stream has stored of them."""
    path, target = _topic(spark, _all_messages(spark, folder)), fresh_dir(spark, "documents")
    _drain(streams.start_document_sink(
        _stream(spark, path), streams.committed_folder(target), fresh_dir(spark, "checkpoint"),
        known_only=known_only,
    ))
    published = topics.read_topic(spark, "parquet", positions=True, path=path)
    return published, streams.committed(spark, target)


def _on_day(model: str, day: int) -> Column:
    """Documents of a model and a day of the month, the ones that get lost or doubled."""
    stamp = F.col("Date").try_cast("timestamp_ntz")
    return (F.col("model") == model) & (F.dayofmonth(stamp) == day)


def _lagged(spark: SparkSession, folder: str) -> DataFrame:
    """Every processed row with its lags: a trigger for each bar."""
    return training.ma_ratio(training.lag_features(_stored_processed(spark, folder)))


def _topic(spark: SparkSession, messages: DataFrame) -> str:
    """The messages as files of a topic folder."""
    path = fresh_dir(spark, "topic")
    if "timestamp" not in messages.columns:
        messages = messages.withColumn("timestamp", F.lit(None).cast("timestamp"))
    messages.write.parquet(path)
    return path


def _stream(spark: SparkSession, path: str) -> DataFrame:
    return topics.stream_topic(spark, "parquet", path=path, maxFilesPerTrigger="4")


# --- bars -----------------------------------------------------------------


@query
def bars_1h(spark, folder):
    return _bars(spark, folder)


@query
def bars_1d(spark, folder):
    return _bars(spark, folder, "1d")


@query
def bars_1min(spark, folder):
    return _bars(spark, folder, "1min")


# --- sources --------------------------------------------------------------


@query
def scan_csv_bars(spark, folder):
    path = fresh_dir(spark, "bars")
    _bars(spark, folder).select(*files.RAW_SCHEMA.names).write.option("header", True).csv(path)
    return files.read_bars(spark, path)


def _grid(spark, folder, timeframes):
    path = fresh_dir(spark, "grid")
    bars = _bars(spark, folder, timeframes[0])
    for timeframe in timeframes[1:]:
        bars = bars.unionByName(_bars(spark, folder, timeframe))
    out.write_bar_grid(bars, path)
    return path


PAIR_NAMES = ("click", "error", "purchase", "signup", "view")


@query
def scan_grid_tagged(spark, folder):
    path = _grid(spark, folder, ("1h", "1d"))
    return files.read_bar_grid(spark, path, PAIR_NAMES, ("1h", "1d"), prefix="file=")


@query
def scan_skip_missing(spark, folder):
    """Asks for pairs and a timeframe that were never written."""
    path = _grid(spark, folder, ("1h",))
    wanted = (*PAIR_NAMES, *files.PAIRS)
    return files.read_bar_grid(spark, path, wanted, ("1h", "1min"), prefix="file=")


@query
def scan_permissive(spark, folder):
    """Bar lines mixed with lines of another kind: how many of each were read."""
    path = fresh_dir(spark, "mixed")
    columns = [F.date_format("Date", "yyyy-MM-dd'T'HH:mm:ss"), *files.RAW_SCHEMA.names[1:]]
    lines = _bars(spark, folder).select(F.concat_ws(",", *columns).alias("value"))
    lines.unionByName(_events(spark, folder).select(F.col("props").alias("value"))).write.text(path)
    rows = files.read_permissive(spark, path)
    kind = F.when(F.col(files.CORRUPT).isNull(), F.lit("good")).otherwise(F.lit("reject"))
    # A rejected line may have been parsed in part; only good rows are summed.
    close = F.when(F.col(files.CORRUPT).isNull(), F.col("Close"))
    return rows.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("rows"), F.round(F.sum(close), 6).alias("close_sum")
    )


@query
def scan_processed(spark, folder):
    path = fresh_dir(spark, "processed")
    out.write_processed(_processed(spark, folder), path)
    return rounded(files.read_processed(spark, path, "parquet"), ROLLING)


@query
def load_counts(spark, folder):
    bars = _bars(spark, folder).unionByName(_bars(spark, folder, "1d"))
    return series.load_counts(bars)


@query
def scan_fallback(spark, folder):
    """The newer file name is absent, so the older one is read."""
    path = fresh_dir(spark, "predictions")
    table = _prediction_tables(spark, folder)[models.RANDOM_FOREST]
    out.write_table(table, f"{path}/rf_predictions.csv")
    names = ("rf_24h_predictions.csv", "rf_predictions.csv")
    found = files.read_first_existing(spark, [f"{path}/{name}" for name in names])
    return _typed_predictions(found)


def _typed_predictions(text_rows: DataFrame) -> DataFrame:
    return text_rows.select(
        F.col("Date").cast("timestamp_ntz").alias("Date"), "Pair",
        *[number(c).alias(c) for c in ("Close", "Actual_h1")],
        F.round(number("RF_Predicted"), 6).alias("RF_Predicted"),
    )


# --- sinks ----------------------------------------------------------------


@query
def sink_csv_roundtrip(spark, folder):
    path = fresh_dir(spark, "processed-csv")
    out.write_processed(_processed(spark, folder), path, "csv")
    return rounded(files.read_processed(spark, path), ROLLING)


@query
def sink_predictions(spark, folder):
    path = fresh_dir(spark, "rf")
    out.write_table(_prediction_tables(spark, folder)[models.RANDOM_FOREST], path)
    return _typed_predictions(files.read_text_csv(spark, path))


@query
def sink_signals(spark, folder):
    path = fresh_dir(spark, "signals")
    out.write_table(_prediction_tables(spark, folder)[models.LOGISTIC], path)
    found = files.read_text_csv(spark, path)
    return found.select(
        F.col("Date").cast("timestamp_ntz").alias("Date"), "Pair",
        number("Close").alias("Close"), "Actual", "Signal",
    )


@query
def publish_predictions_json(spark, folder):
    messages = msg.publish_predictions_json(_scored(spark, folder), _message_fields())
    return _parsed_predictions(messages)


def _parsed_predictions(messages: DataFrame) -> DataFrame:
    def read(name):
        return json_field("value", name)

    return messages.select(
        "key", read("model").alias("model"),
        read("Date").cast("timestamp_ntz").alias("Date"),
        *[number(read(c)).alias(c) for c in ("Close", "Actual_h1")],
        *[F.round(number(read(c)), 6).alias(c) for c in ("RF_Predicted", "GBT_Predicted")],
        *[read(c).alias(c) for c in ("Actual", "Signal")],
    )


@query
def bridge_csv_json(spark, folder):
    path = fresh_dir(spark, "predictions")
    tables = {}
    for model, table in _prediction_tables(spark, folder).items():
        out.write_table(table, f"{path}/{model}")
        tables[model] = files.read_text_csv(spark, f"{path}/{model}")
    return _parsed_predictions(msg.bridge_csv_json(tables))


@query
def replay_messages(spark, folder):
    messages = msg.row_messages(_processed(spark, folder))
    return rounded(
        messages.select(
            "key", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
            json_field("value", "Timeframe").alias("Timeframe"),
            *[number(json_field("value", c)).alias(c) for c in PROCESSED_COLUMNS[3:]],
        ),
        ROLLING,
    )


@query
def forecast_messages(spark, folder):
    messages = msg.forecast_messages(_forecasts(spark, folder))
    parsed = msg.parse_forecasts(messages)
    return _rounded_forecasts(parsed)


def _rounded_forecasts(forecasts: DataFrame) -> DataFrame:
    values = ("predicted_close", "base_close", "current_close", "ma5", "ma20", "volatility5")
    return rounded(forecasts, values).withColumn("hour", F.col("hour").cast("bigint"))


def _document_columns(documents: DataFrame) -> DataFrame:
    return rounded(
        documents.select(
            "collection", "key", "model",
            F.col("Date").cast("timestamp_ntz").alias("Date"), "Actual", "Signal",
            "Close", "Actual_h1", "RF_Predicted", "GBT_Predicted",
            F.col("numbers")["predicted_close"].alias("predicted_close"),
            F.col("numbers")["hour"].alias("hour"),
            F.col("texts")["Timeframe"].alias("Timeframe"),
        ),
        ("RF_Predicted", "predicted_close"),
    )


@query
def sink_route_by_model(spark, folder):
    path = fresh_dir(spark, "documents")
    routed = docs.documents(_stored_messages(spark, folder))
    routed.write.partitionBy("collection").parquet(path)
    return _document_columns(spark.read.parquet(path))


@query
def sink_field_typing(spark, folder):
    typed = docs.typed_fields(_stored_messages(spark, folder))
    return typed.select(
        "key", json_field("value", "model").alias("model"),
        F.coalesce(json_field("value", "Date"), json_field("value", "trigger_date"))
        .cast("timestamp_ntz").alias("stamp"),
        json_field("value", "hour").cast("bigint").alias("hour"),
        "field", F.round("number", 6).alias("number"),
        F.when(~F.col("field").isin("Date", "trigger_date"), F.col("text")).alias("text"),
    )


@query
def sink_verify_counts(spark, folder):
    path = fresh_dir(spark, "documents")
    docs.documents(_stored_messages(spark, folder)).write.partitionBy("collection").parquet(path)
    documents = spark.read.parquet(path)
    samples = docs.sample_documents(documents).select(
        "collection", F.col("key").alias("sample_key"),
        F.coalesce("Date", F.col("texts")["trigger_date"]).cast("timestamp_ntz").alias("sample_date"),
    )
    return docs.collection_counts(documents).join(samples, "collection", "left")


LOST_DAY, DOUBLED_DAY = 13, 14


@query
def sink_missing_rows(spark, folder):
    """What a sink for the three prediction models leaves behind, and rows it has lost since."""
    published, stored = _sunk_messages(spark, folder, known_only=True)
    lost = F.coalesce(_on_day(models.RANDOM_FOREST, LOST_DAY), F.lit(False))
    missing = docs.unstored(published, written(stored.filter(~lost), "damaged"))
    return missing.select(
        "key", json_field("value", "model").alias("model"),
        F.coalesce(json_field("value", "Date"), json_field("value", "trigger_date"))
        .cast("timestamp_ntz").alias("stamp"),
        json_field("value", "hour").cast("bigint").alias("hour"),
    )


@query
def sink_summary(spark, folder):
    """Published against stored, per collection, of a store that lost and doubled rows."""
    published, stored = _sunk_messages(spark, folder, known_only=False)
    lost = F.coalesce(_on_day(models.RANDOM_FOREST, LOST_DAY), F.lit(False))
    doubled = stored.filter(_on_day(models.LOGISTIC, DOUBLED_DAY))
    return docs.sink_summary(published, written(stored.filter(~lost).union(doubled), "damaged"))


@query
def publish_counts(spark, folder):
    return msg.publish_counts(_stored_messages(spark, folder))


# Two earlier runs used other formulas; the later one ended sooner.
EARLIER_RUNS = {"first": (0.11, 12), "second": (0.23, 5)}


@query
def store_retrieve_reconcile(spark, folder):
    """Forecasts continued from a topic that two earlier, unfinished runs wrote to.

    The first run stored twelve hours, the second five, so the newest stored
    closes are those of the second, then of the first; neither equals what the
    present formula gives. It goes on from the state they lead to.
    """
    triggers = fc.trigger_rows(written(_all_frames(spark, folder), "processed"))
    path = fresh_dir(spark, "topic")
    for rate, hours in EARLIER_RUNS.values():
        run = fc.forecast(triggers, _formula(rate), horizon=hours)
        publish(msg.forecast_messages(run), "parquet", path=path)
    stored = msg.parse_forecasts(topics.read_topic(spark, "parquet", positions=True, path=path))
    merged = fc.forecast(triggers, momentum_step, stored=stored)
    kept = max(hours for _, hours in EARLIER_RUNS.values())
    return rounded(
        merged.select(
            "pair", "timeframe", "trigger_date", F.col("hour").cast("bigint").alias("hour"),
            F.col("predicted_close").alias("close"), "ma5", "ma20", "volatility5",
            F.when(F.col("hour") <= kept, "stored").otherwise("computed").alias("source"),
        ),
        ("close", "ma5", "ma20", "volatility5"),
    )


# --- features and targets -------------------------------------------------


@query
def price_features(spark, folder):
    return features.price_features(_bars(spark, folder))


@query
def gain_loss(spark, folder):
    return features.gain_loss(_bars(spark, folder)).select("Date", "Pair", "Gain", "Loss")


@query
def rolling_ma(spark, folder):
    rolled = features.rolling_ma(_bars(spark, folder, "1min"))
    return rounded(rolled.select(*PRICE_KEY, "MA5", "MA20"), ("MA5", "MA20"))


@query
def rolling_volatility(spark, folder):
    rolled = features.rolling_volatility(_bars(spark, folder, "1min"))
    return rounded(rolled.select(*PRICE_KEY, "Volatility5"), ("Volatility5",))


@query
def warmup_filter(spark, folder):
    kept = features.bar_features(_bars(spark, folder), strict_warmup=True)
    return rounded(kept.select(*PRICE_KEY, "MA20"), ("MA20",))


@query
def bar_features(spark, folder):
    return rounded(_processed(spark, folder), ROLLING)


@query
def cast_numeric(spark, folder):
    """Bars kept as text, cast back."""
    path = fresh_dir(spark, "text")
    _bars(spark, folder).write.option("header", True).csv(path)
    text_rows = files.read_text_csv(spark, path)
    cast = training.cast_numeric(text_rows, ("Open", "High", "Low", "Close", "Volume"))
    return cast.withColumn("Date", F.col("Date").cast("timestamp_ntz"))


@query
def ma_ratio(spark, folder):
    rated = training.ma_ratio(_processed(spark, folder))
    return rounded(rated.select(*PRICE_KEY, "MA5_MA20_Ratio"), ("MA5_MA20_Ratio",))


@query
def lag_features(spark, folder):
    return training.lag_features(_stored_processed(spark, folder)).select(*PRICE_KEY, *LAG_COLUMNS)


@query
def target_h1(spark, folder):
    return training.target_h1(_bars(spark, folder, "1min")).select(*PRICE_KEY, TARGET_PRICE)


@query
def target_direction(spark, folder):
    labelled = training.target_direction(_bars(spark, folder, "1min"))
    return labelled.select(*PRICE_KEY, TARGET_DIRECTION)


@query
def training_frame(spark, folder):
    return rounded(_frame(spark, folder), (*ROLLING, "MA5_MA20_Ratio"))


@query
def distinct_dates(spark, folder):
    return split.distinct_dates(_frame(spark, folder))


@query
def split_date(spark, folder):
    return split.split_date(_stored_frame(spark, folder))


@query
def split_train(spark, folder):
    return split.split_train(_stored_frame(spark, folder)).select(*PRICE_KEY, TARGET_PRICE)


@query
def split_test(spark, folder):
    return split.split_test(_stored_frame(spark, folder)).select(*PRICE_KEY, TARGET_PRICE)


@query
def split_counts(spark, folder):
    return split.split_counts(_stored_frame(spark, folder))


@query
def series_tail(spark, folder):
    tail = series.series_tail(_bars(spark, folder))
    return tail.select("Date", "Pair", "Timeframe", "Close")


@query
def trigger_rows(spark, folder):
    triggers = fc.trigger_rows(_processed(spark, folder))
    return rounded(triggers, (*ROLLING, "MA5_MA20_Ratio"))


@query
def rsi14(spark, folder):
    """Relative strength of every series, smoothed along the whole of it."""
    rated = oscillators.wilder_rsi(_processed(spark, folder))
    return rounded(rated.select(*PRICE_KEY, "rsi14"), ("rsi14",))


@query
def time_folds(spark, folder):
    return validation.fold_counts(_stored_frame(spark, folder))


@query
def pair_regression(spark, folder):
    """The next close on the present one, a line per pair."""
    fitted = validation.linear_by_pair(_stored_frame(spark, folder), ["Close"])
    return rounded(
        fitted.select("Pair", "n", F.col("coefficients")[0].alias("slope"), "intercept", "r2"),
        ("slope", "intercept", "r2"),
    )


# --- reports --------------------------------------------------------------


@query
def series_stats(spark, folder):
    stats = summaries.series_stats(_processed(spark, folder))
    return rounded(stats, ("avg_close", "avg_change", "avg_volume", "avg_volatility"))


@query
def pair_summary(spark, folder):
    report = summaries.pair_summary(_all_frames(spark, folder), REPORT_PAIR, "1d")
    return rounded(report, ("avg_close", "avg_change_pct", "avg_volatility"))


@query
def top_volatile(spark, folder):
    top = summaries.top_volatile(_all_frames(spark, folder), REPORT_PAIR, "1d")
    return rounded(top, ("Volatility5",))


@query
def monthly_summary(spark, folder):
    report = summaries.monthly_summary(
        _all_frames(spark, folder), REPORT_PAIR, REPORT_YEAR, "1d"
    )
    return rounded(report, ("avg_close", "avg_change"))


@query
def union_pairs(spark, folder):
    return summaries.union_pairs([_bars(spark, folder, tf) for tf in ("1h", "1d")])


@query
def cross_pair_latest(spark, folder):
    report = summaries.cross_pair_latest(_all_frames(spark, folder), "1d")
    return rounded(report, ("avg_close", "avg_volatility"))


@query
def json_extract(spark, folder):
    return _events(spark, folder).select(
        "event_id", json_field("props", "k").cast("bigint").alias("k")
    )


# --- quality --------------------------------------------------------------


@query
def signal_recode(spark, folder):
    return models.signal_recode(_directed(spark, folder))


@query
def latest_signals(spark, folder):
    return models.latest_signals(_directed(spark, folder))


@query
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(_directed(spark, folder))


@query
def classification_metrics(spark, folder):
    report = metrics.classification_metrics(_directed(spark, folder))
    return rounded(report, report.columns)


@query
def regression_metrics(spark, folder):
    report = metrics.regression_metrics(_scored(spark, folder), by=["Pair"])
    return rounded(report, ("rmse", "mae", "r2"))


@query
def auc_roc(spark, folder):
    return rounded(metrics.auc_roc(_scored(spark, folder), score="score"), ("auc",))


@query
def best_model(spark, folder):
    scored = _scored(spark, folder)
    compared = models.model_comparison({
        models.RANDOM_FOREST: scored,
        models.BOOSTED_TREES: scored.withColumn("prediction", F.col("Close")),
    })
    return rounded(models.best_model(compared), ("value",))


# --- models ---------------------------------------------------------------

_FITTED: dict[tuple, PipelineModel] = {}


def _model(spark: SparkSession, folder: str, name: str) -> PipelineModel:
    """A model trained on the folder's train rows, once per application."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _FITTED:
        train = split.split_train(_stored_frame(spark, folder))
        chosen = {name: models.default_estimators()[name]}
        _FITTED[key] = models.fit_models(train, chosen)[name]
    return _FITTED[key]


def _predictions(spark: SparkSession, folder: str, name: str) -> DataFrame:
    test = split.split_test(_stored_frame(spark, folder))
    return models.score(_model(spark, folder, name), test)


@query
def assemble_skip(spark, folder):
    """Lagged rows include incomplete ones; those with every feature remain."""
    return models.assemble_skip(_lagged(spark, folder)).select("Date", "Pair", "Close", "Volume")


@query
def standardize(spark, folder):
    frame = _stored_frame(spark, folder)
    scaled = models.standardize(split.split_train(frame), split.split_test(frame))
    return rounded(scaled, scaled.columns[2:])


@query
def rf_forecast(spark, folder):
    scored = _predictions(spark, folder, models.RANDOM_FOREST)
    return models.price_predictions(scored, "RF_Predicted")


@query
def gbt_forecast(spark, folder):
    scored = _predictions(spark, folder, models.BOOSTED_TREES)
    return models.price_predictions(scored, "GBT_Predicted")


@query
def lr_direction(spark, folder):
    return models.signal_recode(_predictions(spark, folder, models.LOGISTIC))


@query
def feature_importance(spark, folder):
    return models.feature_importance(_model(spark, folder, models.RANDOM_FOREST))


@query
def model_comparison(spark, folder):
    names = models.default_estimators()
    return models.model_comparison({n: _predictions(spark, folder, n) for n in names})


@query
def scored_rows(spark, folder):
    """What the three models were asked about: the test rows, and answers in the labels' range."""
    frame = _stored_frame(spark, folder)
    train, test = split.split_train(frame), split.split_test(frame)
    reach = train.agg(F.min(TARGET_PRICE).alias("lo"), F.max(TARGET_PRICE).alias("hi"))
    low, high = reach.select("lo").scalar(), reach.select("hi").scalar()
    forest = models.score(_model(spark, folder, models.RANDOM_FOREST), test)
    trees = models.score(_model(spark, folder, models.BOOSTED_TREES), test)
    signs = models.score(_model(spark, folder, models.LOGISTIC), test)
    # A forest averages labels; boosted trees may leave their range, by less than its width.
    parts = [
        forest.select("Pair", F.lit(models.RANDOM_FOREST).alias("model"),
                      F.col("prediction").between(low, high).alias("fits"), TARGET_PRICE),
        trees.select("Pair", F.lit(models.BOOSTED_TREES).alias("model"),
                     F.col("prediction").between(2 * low - high, 2 * high - low).alias("fits"),
                     TARGET_PRICE),
        signs.select("Pair", F.lit(models.LOGISTIC).alias("model"),
                     F.col("prediction").isin(0.0, 1.0).alias("fits"), TARGET_PRICE),
    ]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("model", "Pair").agg(
        F.count("*").alias("rows"), F.count_if(~F.col("fits")).alias("outside"),
        F.round(F.sum(TARGET_PRICE), 6).alias("actual_sum"),
    )


@query
def importance_sum(spark, folder):
    """All importances of the forest: one per feature, none negative, adding up to one."""
    table = models.feature_importance(
        _model(spark, folder, models.RANDOM_FOREST), count=len(FEATURES)
    )
    return table.agg(
        F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("negative"),
    )


@query
def comparison_check(spark, folder):
    """Reported metrics of the regressors against the same recomputed from the scored rows."""
    names = (models.RANDOM_FOREST, models.BOOSTED_TREES)
    scored = {n: written(_predictions(spark, folder, n).select(TARGET_PRICE, "prediction"), "scored")
              for n in names}
    reported = models.model_comparison(scored)
    parts = []
    for name, rows in scored.items():
        error = F.col(TARGET_PRICE) - F.col("prediction")
        mean = rows.agg(F.avg(TARGET_PRICE)).scalar()
        again = rows.agg(
            F.sqrt(F.sum(error * error) / F.count("*")).alias("rmse"),
            (F.sum(F.abs(error)) / F.count("*")).alias("mae"),
            (1 - F.sum(error * error) / F.sum((F.col(TARGET_PRICE) - mean) ** 2)).alias("r2"),
        )
        parts.append(again.select(F.lit(name).alias("model"), "*").unpivot(
            "model", None, "metric", "again"))
    both = reported.join(parts[0].union(parts[1]), ["model", "metric"])
    return both.select("model", "metric", (F.abs(F.col("value") - F.col("again")) < 1e-9).alias("equal"))


@query
def model_roundtrip(spark, folder):
    """Rows a model predicts otherwise after it was saved and loaded."""
    path = fresh_dir(spark, "model")
    model = _model(spark, folder, models.RANDOM_FOREST)
    model.write().overwrite().save(path)
    test = split.split_test(_stored_frame(spark, folder))
    before = models.score(model, test).drop("raw_features", "features")
    both = models.score(
        PipelineModel.load(path), before.withColumnRenamed("prediction", "before")
    )
    return both.groupBy("Pair").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("before") != F.col("prediction")).alias("differing"),
    )


# --- recursive forecast ---------------------------------------------------


def _states(spark: SparkSession, folder: str) -> DataFrame:
    """A forecast state for every bar that has a predecessor."""
    return fc.forecast_init(_lagged(spark, folder).filter(F.col("Close_lag1").isNotNull()))


def _state_columns(states: DataFrame) -> DataFrame:
    state = F.col("state")
    flat = states.select(
        "Pair", F.col("trigger_date").cast("timestamp_ntz").alias("trigger_date"), "base_close",
        *[state[name].alias(name) for name in FEATURES],
        *[state["short_closes"][i].alias(f"short_{i + 1}") for i in range(4)],
        *[state["long_closes"][i].alias(f"long_{i + 1}") for i in (0, 17, 18)],
        F.size(state["long_closes"]).cast("bigint").alias("long_size"),
    )
    numbers = [c for c in flat.columns if c not in ("Pair", "trigger_date", "long_size")]
    return rounded(flat, numbers)


@query
def forecast_init(spark, folder):
    return _state_columns(_states(spark, folder))


@query
def forecast_step(spark, folder):
    return _state_columns(fc.forecast_step(_states(spark, folder), momentum_step))


@query
def forecast_24h(spark, folder):
    return _rounded_forecasts(_forecasts(spark, folder))


@query
def forecast_24h_model(spark, folder):
    """Step by step with a saved model whose predictions SQL can state."""
    triggers = fc.trigger_rows(_all_frames(spark, folder))
    return _rounded_forecasts(fc.forecast(triggers, _saved_formula(spark)))


@query
def forecast_24h_rf(spark, folder):
    triggers = fc.trigger_rows(_processed(spark, folder))
    return fc.forecast(triggers, _model(spark, folder, models.RANDOM_FOREST))


@query
def forecast_summary(spark, folder):
    report = fc.forecast_summary(_all_forecasts(spark, folder))
    return rounded(
        report, ("predicted_close", "base_close", "change", "change_pct")
    ).withColumn("hour", F.col("hour").cast("bigint"))


@query
def forecast_total(spark, folder):
    report = fc.forecast_total(_all_forecasts(spark, folder))
    return rounded(report, ("base_close", "final_close", "total_change", "total_pct"))


@query
def forecast_stats(spark, folder):
    report = fc.forecast_stats(_all_forecasts(spark, folder))
    return rounded(report, ("current", "predicted", "ma5", "volatility5", "change_pct"))


@query
def forecast_curve(spark, folder):
    processed = written(_all_frames(spark, folder), "processed")
    curve = fc.forecast_curve(processed, fc.forecast(fc.trigger_rows(processed), momentum_step))
    return rounded(curve, ("historical", "forecast")).withColumn(
        "position", F.col("position").cast("bigint")
    )


# --- streams --------------------------------------------------------------


def _drain(started) -> None:
    if not started.awaitTermination(DRAIN_SECONDS):
        started.stop()
        raise TimeoutError(f"the stream did not end within {DRAIN_SECONDS} s")


@query
def stream_trigger_parse(spark, folder):
    """Replayed bars (no lags, so no triggers) and lagged bars through one topic."""
    processed = _stored_processed(spark, folder)
    lagged = training.ma_ratio(training.lag_features(processed))
    path = _topic(spark, msg.row_messages(processed).unionByName(msg.row_messages(lagged)))
    target = fresh_dir(spark, "triggers")
    parsed = msg.parse_triggers(_stream(spark, path))
    _drain(streams.start_copy(parsed, target, fresh_dir(spark, "checkpoint")))
    kept = spark.read.parquet(target)
    kept = kept.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))
    return rounded(kept, (*ROLLING, "MA5_MA20_Ratio"))


@query
def stream_drain(spark, folder):
    """Everything in the topic from the start, in bounded batches, then stop."""
    path = _topic(spark, msg.row_messages(_processed(spark, folder)))
    target = fresh_dir(spark, "drained")
    _drain(streams.start_copy(_stream(spark, path), target, fresh_dir(spark, "checkpoint")))
    return spark.read.parquet(target).select(
        "key", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        number(json_field("value", "Close")).alias("Close"),
    )


@query
def topic_positions(spark, folder):
    """A topic written in two goes and read at once: each message with its number in its file."""
    path = fresh_dir(spark, "topic")
    for part in (_processed(spark, folder), _all_frames(spark, folder).filter("Timeframe = '1d'")):
        publish(msg.row_messages(part), "json", path=path)
    read = topics.read_topic(spark, "json", positions=True, path=path)
    files_of = read.groupBy("position.source").agg(
        F.count("*").alias("n"), F.count_distinct("position.nth").alias("places"),
        F.max("position.nth").alias("last"),
    )
    whole = files_of.agg(F.sum("n").alias("messages"), F.sum("places").alias("positions"),
                         F.sum(F.col("last") + 1).alias("numbered"))
    return whole.select(*(F.col(c).cast("bigint").alias(c) for c in whole.columns))


@query
def stream_two_queries(spark, folder):
    """A forecast and a monitor over one topic at once, waited for together."""
    triggers = fc.trigger_rows(_processed(spark, folder))
    path = _topic(spark, msg.row_messages(triggers))
    forecasts, seen = fresh_dir(spark, "forecasts"), fresh_dir(spark, "seen")
    running = [
        streams.start_forecasts(
            _stream(spark, path), momentum_step, streams.per_batch_folder(forecasts),
            fresh_dir(spark, "checkpoint"), available_now=True),
        streams.start_monitor(
            _stream(spark, path), fresh_dir(spark, "checkpoint"), format="parquet",
            available_now=True, path=seen, name="seen"),
    ]
    for query_of in running:
        _drain(query_of)
    made = msg.parse_forecasts(spark.read.parquet(forecasts)).groupBy("pair").agg(
        F.count("*").alias("forecasts"))
    shown = spark.read.parquet(seen).groupBy("pair").agg(F.count("*").alias("triggers"))
    return made.join(shown, "pair", "full")


@query
def stream_monitor(spark, folder):
    path = _topic(spark, msg.forecast_messages(_forecasts(spark, folder)))
    target = fresh_dir(spark, "monitor")
    _drain(streams.start_monitor(
        _stream(spark, path), fresh_dir(spark, "checkpoint"),
        format="parquet", available_now=True, path=target,
    ))
    return spark.read.parquet(target).select(
        "pair", json_field("prediction_json", "hour").cast("bigint").alias("hour"),
        F.round(number(json_field("prediction_json", "predicted_close")), 6).alias("predicted_close"),
    )


@query
def stream_forecast(spark, folder):
    path = _topic(spark, msg.row_messages(fc.trigger_rows(_processed(spark, folder))))
    target = fresh_dir(spark, "forecasts")
    _drain(streams.start_forecasts(
        _stream(spark, path), momentum_step, streams.per_batch_folder(target),
        fresh_dir(spark, "checkpoint"), available_now=True,
    ))
    return _rounded_forecasts(msg.parse_forecasts(spark.read.parquet(target)))


@query
def stream_forecast_model(spark, folder):
    """Micro-batches with a saved model; what its steps write is gone afterwards."""
    path = _topic(spark, msg.row_messages(fc.trigger_rows(_all_frames(spark, folder))))
    target = fresh_dir(spark, "forecasts")
    _drain(streams.start_forecasts(
        _stream(spark, path), _saved_formula(spark), streams.per_batch_folder(target),
        fresh_dir(spark, "checkpoint"), available_now=True,
    ))
    return _rounded_forecasts(msg.parse_forecasts(spark.read.parquet(target)))


@query
def stream_restart(spark, folder):
    """A sink stopped half-way, restarted, and run again with a new checkpoint."""
    messages = written(_all_messages(spark, folder), "messages")
    path, target = fresh_dir(spark, "topic"), fresh_dir(spark, "documents")
    write = streams.committed_folder(target, partition_by=("collection",))
    first, second = fresh_dir(spark, "checkpoint"), fresh_dir(spark, "checkpoint")
    recursive = json_field("value", "model") == fc.RECURSIVE_MODEL
    early = F.coalesce(recursive, F.lit(False))
    for part, checkpoint in ((messages.filter(early), first), (messages.filter(~early), first),
                             (None, second)):
        if part is not None:
            publish(part, "parquet", path=path)
        _drain(streams.start_document_sink(_stream(spark, path), write, checkpoint))
    return _document_columns(streams.committed(spark, target))


@query
def stream_sink_route(spark, folder):
    path = _topic(spark, _all_messages(spark, folder))
    target = fresh_dir(spark, "documents")
    _drain(streams.start_document_sink(
        _stream(spark, path), streams.per_batch_folder(target, partition_by=("collection",)),
        fresh_dir(spark, "checkpoint"),
    ))
    return _document_columns(spark.read.parquet(target))
