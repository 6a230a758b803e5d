"""Training, scoring and comparing the MLlib models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEATURES, TARGET_DIRECTION, TARGET_PRICE
from .metrics import auc_roc, classification_metrics, regression_metrics

# The name of each model in messages and reports.
RANDOM_FOREST = "RandomForest"
BOOSTED_TREES = "GradientBoostedTrees"
LOGISTIC = "LogisticRegression"


def assembler() -> VectorAssembler:
    return VectorAssembler(
        inputCols=list(FEATURES), outputCol="raw_features", handleInvalid="skip"
    )


def scaler() -> StandardScaler:
    return StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    )


def assemble_skip(df: DataFrame) -> DataFrame:
    """Rows whose features are all present, with their raw vector."""
    return assembler().transform(df)


def fit_features(train: DataFrame) -> PipelineModel:
    """Assembler and scaler, fitted once and shared by all models."""
    return Pipeline(stages=[assembler(), scaler()]).fit(train)


# The default settings of the three models below.
def random_forest(**params) -> RandomForestRegressor:
    return RandomForestRegressor(**{
        "featuresCol": "features", "labelCol": TARGET_PRICE,
        "numTrees": 50, "maxDepth": 8, "minInstancesPerNode": 10, "seed": 42, **params,
    })


def boosted_trees(**params) -> GBTRegressor:
    return GBTRegressor(**{
        "featuresCol": "features", "labelCol": TARGET_PRICE,
        "maxIter": 50, "maxDepth": 5, "stepSize": 0.05, "seed": 42, **params,
    })


def logistic(**params) -> LogisticRegression:
    return LogisticRegression(**{
        "featuresCol": "features", "labelCol": TARGET_DIRECTION,
        "maxIter": 200, "regParam": 0.01, "elasticNetParam": 0.0, "family": "binomial", **params,
    })


def default_estimators() -> dict[str, Estimator]:
    return {RANDOM_FOREST: random_forest(), BOOSTED_TREES: boosted_trees(), LOGISTIC: logistic()}


def fit_models(
    train: DataFrame, estimators: Mapping[str, Estimator] | None = None
) -> dict[str, PipelineModel]:
    """One saved-together model per estimator; features are prepared and cached once."""
    estimators = default_estimators() if estimators is None else estimators
    features = fit_features(train)
    prepared = features.transform(train).select("features", TARGET_PRICE, TARGET_DIRECTION)
    prepared = prepared.persist()
    try:
        return {
            name: PipelineModel(stages=[*features.stages, estimator.fit(prepared)])
            for name, estimator in estimators.items()
        }
    finally:
        prepared.unpersist()


def standardize(train: DataFrame, df: DataFrame) -> DataFrame:
    """The standardized features of ``df`` as plain columns, fitted on ``train``."""
    scaled = fit_features(train).transform(df).withColumn("z", vector_to_array("features"))
    return scaled.select(
        "Date", "Pair", *[F.col("z")[i].alias(f"z_{c}") for i, c in enumerate(FEATURES)]
    )


def score(model: Transformer, df: DataFrame) -> DataFrame:
    return model.transform(df)


def feature_importance(model: PipelineModel, count: int = 5) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(FEATURES, weights)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(count)


def _long(metrics: DataFrame, model: str) -> DataFrame:
    return metrics.select(F.lit(model).alias("model"), "*").unpivot(
        "model", None, "metric", "value"
    )


def model_comparison(scored: Mapping[str, DataFrame]) -> DataFrame:
    """(model, metric, value) for scored test sets keyed by model name."""
    parts = []
    for name, predictions in scored.items():
        if name == LOGISTIC:
            parts.append(_long(auc_roc(predictions), name))
            parts.append(_long(classification_metrics(predictions), name))
        else:
            parts.append(_long(regression_metrics(predictions), name))
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def best_model(comparison: DataFrame) -> DataFrame:
    """The regressor with the highest R²; the forest wins a tie."""
    return (
        comparison.filter((F.col("metric") == "r2") & F.col("model").isin(RANDOM_FOREST, BOOSTED_TREES))
        .orderBy(F.col("value").desc_nulls_last(), (F.col("model") != RANDOM_FOREST))
        .limit(1)
    )


def price_fields(column: str, prediction: str = "prediction") -> dict[str, Column]:
    """Date, Pair, Close, Actual_h1 and the prediction under ``column``."""
    return {
        "Date": F.col("Date"), "Pair": F.col("Pair"), "Close": F.col("Close"),
        "Actual_h1": F.col(TARGET_PRICE), column: F.col(prediction),
    }


def signal_fields(prediction: str = "prediction") -> dict[str, Column]:
    """Direction label and prediction as UP/DOWN and BUY/SELL."""
    return {
        "Date": F.col("Date"), "Pair": F.col("Pair"), "Close": F.col("Close"),
        "Actual": F.when(F.col(TARGET_DIRECTION) == 1.0, "UP").otherwise("DOWN"),
        "Signal": F.when(F.col(prediction) == 1.0, "BUY").otherwise("SELL"),
    }


def _selected(scored: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    return scored.select(*(c.alias(name) for name, c in fields.items()))


def price_predictions(scored: DataFrame, column: str) -> DataFrame:
    return _selected(scored, price_fields(column))


def signal_recode(scored: DataFrame) -> DataFrame:
    return _selected(scored, signal_fields())


def latest_signals(scored: DataFrame, count: int = 10) -> DataFrame:
    return signal_recode(scored).orderBy(F.desc("Date"), "Pair").limit(count)
