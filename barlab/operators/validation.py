"""Validation in the order of time, and models of single pairs.

Folds expand: each trains on all dates up to a border and is judged on those up
to the next one, so no model sees what comes after. Borders split the distinct
dates evenly. They are found like the split date, by counting dates per day, so
no task orders all dates.

A linear model per pair needs only sums of products of its columns (the Gram
matrix), which one aggregation adds up for all pairs before the shuffle. The
matrix of a pair, a few hundred numbers, is then solved in a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import FEATURES, TARGET_DIRECTION, TARGET_PRICE, TIME
from . import models
from .metrics import regression_metrics
from .split import distinct_dates

FOLDS = 4


def fold_borders(df: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(fold, train_until, valid_until) for folds 1 to ``folds``.

    Border ``i`` is the distinct date at 0-based position ``i * n // (folds + 1)``
    less one, of ``n`` dates; the last fold ends with the last date.
    """
    dates = distinct_dates(df).filter(F.col(TIME).isNotNull())
    per_day = dates.groupBy(F.to_date(TIME).alias("day")).agg(F.count("*").alias("n"))
    along = Window.orderBy("day")
    everything = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = per_day.select(
        "day", F.sum("n").over(along).alias("upto"), F.sum("n").over(everything).alias("total"), "n"
    )
    border = F.explode(F.array(*(F.lit(i) for i in range(1, folds + 2))))
    # One row per border: the day it lies on, and its place among the dates of that day.
    wanted = placed.withColumn("border", border).withColumn(
        "position", F.floor(F.col("border") * F.col("total") / (folds + 1))
    ).filter("position > upto - n and position <= upto").select(
        F.col("day").alias("on_day"), "border", (F.col("position") - F.col("upto") + F.col("n")).alias("place")
    )
    ranked = dates.withColumn("day", F.to_date(TIME)).join(
        F.broadcast(wanted), F.col("day") == F.col("on_day")
    ).withColumn("rank", F.row_number().over(Window.partitionBy("day", "border").orderBy(TIME)))
    at = ranked.filter("rank = place").select("border", F.col(TIME).alias("until"))
    ends = at.select((F.col("border") - 1).alias("border"), F.col("until").alias("valid_until"))
    return at.join(F.broadcast(ends), "border").select(
        F.col("border").alias("fold"), F.col("until").alias("train_until"), "valid_until"
    )


def in_folds(df: DataFrame, borders: DataFrame) -> DataFrame:
    """Each row once per fold that uses it, with ``fold`` and ``training``."""
    return df.join(F.broadcast(borders), F.col(TIME) <= F.col("valid_until")).withColumn(
        "training", F.col(TIME) <= F.col("train_until")
    )


def fold_counts(df: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(fold, train_until, valid_until, train_rows, valid_rows)."""
    return in_folds(df.select(TIME), fold_borders(df, folds)).groupBy(
        "fold", "train_until", "valid_until"
    ).agg(F.count_if("training").alias("train_rows"), F.count_if(~F.col("training")).alias("valid_rows"))


def cross_validate(
    frame: DataFrame, grid: Sequence[tuple[Estimator, Mapping]], folds: int = FOLDS
) -> DataFrame:
    """(fold, setting, params, rmse, mae, r2) of regressors, each with a map of parameters.

    Rows are assembled once and cached; each fold scales them by its training
    rows and fits every setting of the grid on them.
    """
    spark = frame.sparkSession
    borders = fold_borders(frame, folds).collect()
    assembled = models.assemble_skip(frame).select(
        TIME, "raw_features", TARGET_PRICE, TARGET_DIRECTION
    ).persist()
    try:
        results = []
        for fold in sorted(borders, key=lambda b: b.fold):
            train = assembled.filter(F.col(TIME) <= F.lit(fold.train_until))
            valid = assembled.filter(
                (F.col(TIME) > F.lit(fold.train_until)) & (F.col(TIME) <= F.lit(fold.valid_until))
            )
            scaler = models.scaler().fit(train)
            scaled = scaler.transform(train).persist()
            for number, (estimator, params) in enumerate(grid):
                model = PipelineModel(stages=[scaler, estimator.fit(scaled, dict(params))])
                found = regression_metrics(model.transform(valid)).first()
                named = ", ".join(sorted(f"{p.name}={v}" for p, v in params.items()))
                results.append((fold.fold, number, named, found.rmse, found.mae, found.r2))
            scaled.unpersist()
        schema = "fold int, setting int, params string, rmse double, mae double, r2 double"
        return spark.createDataFrame(results, schema)
    finally:
        assembled.unpersist()


def gram(rows: DataFrame, features: Sequence[str], label: str, by: Iterable[str]) -> DataFrame:
    """Per group: n, the means of features and label, and their sums of products.

    Products are taken of differences from a first value of the group's, so
    large levels cost no digits. ``products`` is the upper triangle by rows.
    """
    names = [*features, label]
    keys = list(by)
    usable = rows.filter(" and ".join(f"`{c}` is not null" for c in names))
    shift = usable.groupBy(*keys).agg(*(F.avg(c).alias(f"_at_{i}") for i, c in enumerate(names)))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"s.{key}"))
    # One row per group.
    moved = usable.alias("r").join(F.broadcast(shift.alias("s")), same).select(
        *(F.col(f"r.{k}").alias(k) for k in keys),
        *(F.col(f"s._at_{i}").alias(f"_at_{i}") for i in range(len(names))),
        *((F.col(f"r.{c}") - F.col(f"s._at_{i}")).alias(f"_x_{i}") for i, c in enumerate(names)),
    )
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    return moved.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.array(*(F.first(f"_at_{i}") for i in range(len(names)))).alias("means"),
        F.array(*(F.sum(F.col(f"_x_{i}") * F.col(f"_x_{j}")) for i, j in pairs)).alias("products"),
    )


def solve(products: np.ndarray, means: np.ndarray, n: int, ridge: float) -> tuple[np.ndarray, float, float]:
    """Coefficients, intercept and R² of one group's least squares.

    Features are brought to unit variance for the solution, and ``ridge`` times
    ``n`` is added there; a feature that does not vary gets no coefficient.
    """
    size = len(means)
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = products
    full = full + np.triu(full, 1).T
    spread = np.sqrt(np.diag(full)[:-1] / n)
    used = np.flatnonzero(spread > 1e-12 * np.maximum(np.abs(means[:-1]), 1e-300))
    slopes = np.zeros(size - 1)
    if len(used):
        unit = full[np.ix_(used, used)] / np.outer(spread[used], spread[used]) / n
        target = full[used, -1] / spread[used] / n
        found = np.linalg.lstsq(unit + ridge * np.eye(len(used)), target, rcond=1e-12)[0]
        slopes[used] = found / spread[used]
    left = full[-1, -1] - 2 * slopes @ full[:-1, -1] + slopes @ full[:-1, :-1] @ slopes
    r2 = 1 - left / full[-1, -1] if full[-1, -1] > 0 else float("nan")
    return slopes, float(means[-1] - slopes @ means[:-1]), float(r2)


def linear_by_pair(
    rows: DataFrame, features: Sequence[str] = FEATURES, label: str = TARGET_PRICE,
    by: Sequence[str] = ("Pair",), ridge: float = 0.0,
) -> DataFrame:
    """Per group: n, coefficients (in the order of ``features``), intercept, r2.

    ``r2`` is null where the label does not vary. Rows with a null are left out.
    """
    sums = gram(rows, features, label, by)

    def solved(batches):
        for batch in batches:
            out = [
                solve(np.array(p), np.array(m), n, ridge)
                for p, m, n in zip(batch["products"], batch["means"], batch["n"])
            ]
            yield pd.DataFrame({
                **{k: batch[k] for k in by}, "n": batch["n"],
                "coefficients": [s.tolist() for s, _, _ in out],
                "intercept": [i for _, i, _ in out], "r2": [r for _, _, r in out],
            })

    keys = ", ".join(f"`{k}` {sums.schema[k].dataType.simpleString()}" for k in by)
    found = sums.mapInPandas(
        solved, f"{keys}, n long, coefficients array<double>, intercept double, r2 double"
    )
    return found.withColumn("r2", F.when(~F.isnan("r2"), F.col("r2")))


def predict_by_pair(
    rows: DataFrame, fitted: DataFrame, features: Sequence[str] = FEATURES,
    by: Sequence[str] = ("Pair",),
) -> DataFrame:
    """``rows`` with the ``prediction`` of their group's model; one model row per group."""
    total: Column = F.col("intercept")
    for i, name in enumerate(features):
        total = total + F.col("coefficients")[i] * F.col(name)
    model = fitted.select(*by, "coefficients", "intercept")
    return rows.join(F.broadcast(model), list(by), "left").withColumn("prediction", total).drop(
        "coefficients", "intercept"
    )
