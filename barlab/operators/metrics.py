"""Model quality as DataFrames."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..schemas import TARGET_DIRECTION, TARGET_PRICE

# So many ranges of scores are ordered apart; they are found in two steps of the root of it.
RANGES = 1_024
# Relative rank error of the range borders, against the share of one range.
ACCURACY = 8 * RANGES


def regression_metrics(
    scored: DataFrame,
    label: str = TARGET_PRICE,
    prediction: str = "prediction",
    by: Iterable[str] = (),
) -> DataFrame:
    """RMSE, MAE and R² in one aggregation, overall or per group."""
    error = F.col(label) - F.col(prediction)
    return scored.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(label))).alias("r2"),
    )


def confusion_matrix(
    scored: DataFrame, label: str = TARGET_DIRECTION, prediction: str = "prediction"
) -> DataFrame:
    return (
        scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count("*").alias("count"))
        .orderBy("label", "prediction")
    )


def classification_metrics(
    scored: DataFrame, label: str = TARGET_DIRECTION, prediction: str = "prediction"
) -> DataFrame:
    """Accuracy and class-weighted precision, recall and F1.

    Everything follows from the confusion matrix, which has one row per pair of
    classes, so the data itself is aggregated once.
    """
    cells = scored.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count("*").alias("count"))
    # Each cell counts for the class it is and for the class it was taken for.
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    none = F.lit(0).cast("long")
    roles = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("count").alias("actual"),
                 hit.alias("hit"), none.alias("guessed")),
        F.struct(F.col("prediction").alias("class"), none.alias("actual"),
                 none.alias("hit"), F.col("count").alias("guessed")),
    )))
    classes = roles.groupBy("class").agg(
        *(F.sum(c).alias(c) for c in ("actual", "hit", "guessed"))
    ).filter("actual > 0")
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("guessed")), F.lit(0.0))
    recall = F.try_divide(F.col("hit"), F.col("actual"))
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))

    def weighted(value):
        return F.sum(value * F.col("actual")) / F.sum("actual")

    return classes.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("weighted_precision"),
        weighted(recall).alias("weighted_recall"),
    )


def auc_roc(
    scored: DataFrame, label: str = TARGET_DIRECTION, score: str = "rawPrediction", bins: int = 0
) -> DataFrame:
    """Area under the ROC curve; ``bins=0`` keeps every distinct score as a threshold.

    With plain scores and no bins it is exact, lazy and needs no order of all
    rows in one task: scores are counted first and cut into ranges at quantiles of
    the distinct scores, taken from one mergeable sketch, whatever the size of the
    scores. Running totals within a range start from the totals of the ranges
    below. Raw prediction vectors and bins go through the MLlib evaluator.
    """
    if bins or not isinstance(scored.schema[score].dataType, NumericType):
        evaluator = BinaryClassificationEvaluator(
            labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
        )
        area = evaluator.evaluate(scored)
        return scored.sparkSession.createDataFrame([(float(area),)], "auc double")
    positive = F.col(label) > 0.5
    counts = scored.groupBy(F.col(score).alias("score")).agg(
        F.sum(positive.cast("long")).alias("up"), F.sum((~positive).cast("long")).alias("down")
    )
    step = math.isqrt(RANGES)
    shares = [i / RANGES for i in range(1, RANGES)]
    borders = counts.agg(F.percentile_approx("score", shares, ACCURACY).alias("b")).scalar()
    # How many borders lie below a score: first of every so many, then of those between.
    coarse = F.filter(F.col("borders"), lambda b, i: ((i + 1) % step == 0) & (b < F.col("score")))
    first = F.size(coarse) * step
    rest = F.filter(F.slice("borders", F.col("first") + 1, step), lambda b: b < F.col("score"))
    ranged = counts.withColumn("borders", borders).withColumn("first", first).withColumn(
        "range", F.col("first") + F.size(rest)
    ).drop("borders", "first")
    totals = ranged.groupBy("range").agg(F.sum("down").alias("down"))
    # One row per range.
    before = totals.select(
        F.col("range").alias("in"),
        (F.sum("down").over(Window.orderBy("range")) - F.col("down")).alias("below"),
    )
    within = Window.partitionBy("range").orderBy("score")
    placed = ranged.withColumn("sofar", F.sum("down").over(within)).join(
        F.broadcast(before), F.col("range") == F.col("in")
    )
    # Pairs in the right order, equal scores counting half.
    pairs = F.col("up") * (F.col("below") + F.col("sofar") - F.col("down") / 2)
    return placed.agg(F.coalesce(
        F.try_divide(F.sum(pairs), F.sum("up").cast("double") * F.sum("down")), F.lit(0.0)
    ).alias("auc"))
