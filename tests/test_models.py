import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from barlab.operators import features, metrics, models, split, training
from barlab.schemas import FEATURES

# Published counts of one confusion matrix: (label, prediction, rows).
CELLS = [(0.0, 0.0, 13106), (0.0, 1.0, 2977), (1.0, 0.0, 13117), (1.0, 1.0, 2898)]


@pytest.fixture(scope="module")
def cells(spark):
    table = spark.createDataFrame(CELLS, "PriceDirection double, prediction double, n int")
    return table.withColumn("i", F.explode(F.sequence(F.lit(1), "n"))).drop("n", "i").persist()


def test_confusion_matrix_and_published_quality(cells):
    assert [tuple(r) for r in metrics.confusion_matrix(cells).collect()] == CELLS
    got = metrics.classification_metrics(cells).collect()[0]
    assert got.accuracy == pytest.approx(0.49860, abs=5e-6)
    assert got.weighted_precision == pytest.approx(0.49654, abs=5e-6)
    assert got.weighted_recall == pytest.approx(0.49860, abs=5e-6)
    assert got.f1 == pytest.approx(0.44256, abs=5e-6)


def test_classification_metrics_equal_the_evaluator(cells):
    odd = cells.filter("prediction = 0 or PriceDirection = 1").withColumn(
        "prediction", F.when(F.col("PriceDirection") == 1, 0.0).otherwise(F.col("prediction"))
    )
    for table in (cells, odd):
        got = metrics.classification_metrics(table).collect()[0]
        evaluator = MulticlassClassificationEvaluator(labelCol="PriceDirection")
        for ours, theirs in (("accuracy", "accuracy"), ("f1", "f1"),
                             ("weighted_precision", "weightedPrecision"),
                             ("weighted_recall", "weightedRecall")):
            assert got[ours] == pytest.approx(evaluator.setMetricName(theirs).evaluate(table))


def test_auc_with_ties(spark):
    rows = [(0.0, 0.1), (1.0, 0.1), (1.0, 0.4), (0.0, 0.3), (1.0, 0.9), (0.0, 0.9)]
    table = spark.createDataFrame(rows, "PriceDirection double, score double")
    pairs = [(a > b) + (a == b) / 2 for la, a in rows for lb, b in rows if la == 1 and lb == 0]
    assert metrics.auc_roc(table, score="score").collect()[0].auc == pytest.approx(sum(pairs) / 9)


@pytest.fixture(scope="module")
def frame(spark):
    from barlab.sources.ticks import bars

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return training.training_frame(features.bar_features(bars(events, "1h"))).persist()


@pytest.fixture(scope="module")
def small(frame):
    """Smaller settings of the three models, fitted on the train rows."""
    return models.fit_models(split.split_train(frame), {
        models.RANDOM_FOREST: models.random_forest(numTrees=5, maxDepth=3),
        models.BOOSTED_TREES: models.boosted_trees(maxIter=3, maxDepth=2),
        models.LOGISTIC: models.logistic(maxIter=20),
    })


def test_default_settings():
    forest, trees, line = models.random_forest(), models.boosted_trees(), models.logistic()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (50, 8, 10, 42)
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getStepSize(), trees.getSeed()) == (50, 5, 0.05, 42)
    assert (line.getMaxIter(), line.getRegParam(), line.getElasticNetParam(), line.getFamily()) == (200, 0.01, 0.0, "binomial")


def test_regression_metrics_equal_the_evaluator(frame, small):
    scored = models.score(small[models.RANDOM_FOREST], split.split_test(frame))
    got = metrics.regression_metrics(scored).collect()[0]
    evaluator = RegressionEvaluator(labelCol="Close_h1")
    for name in ("rmse", "mae", "r2"):
        assert got[name] == pytest.approx(evaluator.setMetricName(name).evaluate(scored))


def test_shared_features_give_the_same_model_as_a_whole_fit(frame, small):
    train, test = split.split_train(frame), split.split_test(frame)
    whole = Pipeline(stages=[
        models.assembler(), models.scaler(), models.random_forest(numTrees=5, maxDepth=3),
    ]).fit(train)
    ours = models.score(small[models.RANDOM_FOREST], test).select("Pair", "Date", "prediction")
    theirs = whole.transform(test).select("Pair", "Date", "prediction")
    assert sorted(ours.collect()) == sorted(theirs.collect())


def test_saved_model_predicts_the_same(frame, small, tmp_path):
    test = split.split_test(frame)
    for name, model in small.items():
        model.write().overwrite().save(str(tmp_path / name))
        loaded = PipelineModel.load(str(tmp_path / name))
        one = models.score(model, test).select("Pair", "Date", "prediction").collect()
        two = models.score(loaded, test).select("Pair", "Date", "prediction").collect()
        assert sorted(one) == sorted(two)


def test_importances(small):
    top = models.feature_importance(small[models.RANDOM_FOREST]).collect()
    assert len(top) == 5 and all(r.feature in FEATURES for r in top)
    assert [r.importance for r in top] == sorted((r.importance for r in top), reverse=True)
    everything = models.feature_importance(small[models.RANDOM_FOREST], len(FEATURES)).collect()
    assert sum(r.importance for r in everything) == pytest.approx(1.0)


def test_comparison_and_best(spark, frame, small):
    test = split.split_test(frame)
    table = models.model_comparison({n: models.score(m, test) for n, m in small.items()})
    found = {(r.model, r.metric) for r in table.collect()}
    assert {(models.LOGISTIC, m) for m in ("auc", "accuracy", "f1")} <= found
    assert {(models.BOOSTED_TREES, m) for m in ("rmse", "mae", "r2")} <= found
    tie = spark.createDataFrame(
        [(models.BOOSTED_TREES, "r2", 0.5), (models.RANDOM_FOREST, "r2", 0.5),
         (models.LOGISTIC, "auc", 0.9)], "model string, metric string, value double")
    assert models.best_model(tie).collect()[0].model == models.RANDOM_FOREST


def test_rows_with_a_missing_feature_are_skipped(frame):
    holed = frame.withColumn("MA5", F.when(F.col("Pair") != "view", F.col("MA5")))
    assert models.assemble_skip(holed).count() == frame.filter("Pair != 'view'").count()


def test_signals_are_written_by_name(spark):
    scored = spark.createDataFrame(
        [("d", "A", 1.0, 1.0, 0.0)],
        "Date string, Pair string, Close double, PriceDirection double, prediction double")
    row = models.signal_recode(scored).collect()[0]
    assert (row.Actual, row.Signal) == ("UP", "SELL")
