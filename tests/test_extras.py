import random

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from barlab.operators import features, metrics, oscillators, training, validation
from barlab.schemas import FEATURES
from barlab.sources import ticks


@pytest.fixture(scope="module")
def processed(make_bars):
    rng = random.Random(3)
    closes = {
        "A": [(3 * i, round(rng.uniform(1, 9), 2)) for i in range(700)],
        "B": [(40 * i, round(rng.uniform(1, 9), 2)) for i in range(60)],
        "C": [5.0] * 10, "D": [1.0],
    }
    return features.bar_features(make_bars(closes)).persist()


def by_pair(df, *columns):
    found = {}
    for r in df.orderBy("Pair", "Date").collect():
        found.setdefault(r.Pair, []).append(tuple(r[c] for c in columns))
    return found


@pytest.mark.parametrize("days,block", [(None, 256), (1, 3), (5, 7), (30, 1)])
def test_recurrence_equals_the_loop(processed, days, block):
    out = oscillators.recurrence(
        processed, F.col("Close") / 10, {"y": F.col("Gain"), "z": F.col("Loss") - 1}, start=2.0,
        chunk_days=days, block_rows=block,
    )
    assert out.columns == [*processed.columns, "y", "z"]
    for rows in by_pair(out, "Close", "Gain", "Loss", "y", "z").values():
        y = z = 2.0
        for close, gain, loss, got_y, got_z in rows:
            y, z = close / 10 * y + gain, close / 10 * z + loss - 1
            assert got_y == pytest.approx(y, rel=1e-9) and got_z == pytest.approx(z, rel=1e-9)


@pytest.mark.parametrize("days", [None, 2])
def test_rsi_equals_the_loop(processed, days):
    out = oscillators.wilder_rsi(processed, chunk_days=days)
    for pair, rows in by_pair(out, "Gain", "Loss", "rsi14").items():
        gain = loss = 0.0
        for n, (up, down, got) in enumerate(rows, 1):
            share = n if n <= 14 else 14
            gain, loss = (gain * (share - 1) + up) / share, (loss * (share - 1) + down) / share
            if n < 14 or gain + loss == 0:
                assert got is None
            else:
                assert got == pytest.approx(100 * gain / (gain + loss), abs=1e-9)
        assert len(rows) == {"A": 700, "B": 60, "C": 10, "D": 1}[pair]


@pytest.mark.parametrize("folds", [1, 4, 9])
def test_folds_follow_each_other(processed, folds):
    dates = sorted({r.Date for r in processed.select("Date").collect()})
    borders = {r.fold: r for r in validation.fold_borders(processed, folds).collect()}
    assert sorted(borders) == list(range(1, folds + 1))
    for i, b in borders.items():
        assert b.train_until == dates[i * len(dates) // (folds + 1) - 1]
        assert b.valid_until == dates[(i + 1) * len(dates) // (folds + 1) - 1]
    assert borders[folds].valid_until == dates[-1]
    counts = {r.fold: r for r in validation.fold_counts(processed, folds).collect()}
    rows = [r.Date for r in processed.select("Date").collect()]
    for i, b in borders.items():
        assert counts[i].train_rows == sum(d <= b.train_until for d in rows)
        assert counts[i].valid_rows == sum(b.train_until < d <= b.valid_until for d in rows)


def test_grid_is_judged_on_later_dates(processed):
    frame = training.training_frame(processed)
    line = LinearRegression(featuresCol="features", labelCol="Close_h1", solver="normal")
    grid = [(line, {line.regParam: p}) for p in (0.01, 1e9)]
    found = validation.cross_validate(frame, grid, folds=2).collect()
    assert [(r.fold, r.setting) for r in found] == [(1, 0), (1, 1), (2, 0), (2, 1)]
    for b, r in zip(sorted(validation.fold_borders(frame, 2).collect()), found[1::2]):
        # So much shrinking leaves the mean of the training labels.
        train = [x.Close_h1 for x in frame.filter(F.col("Date") <= F.lit(b.train_until)).collect()]
        valid = [x.Close_h1 for x in frame.filter(
            (F.col("Date") > F.lit(b.train_until)) & (F.col("Date") <= F.lit(b.valid_until))).collect()]
        assert r.rmse == pytest.approx(np.sqrt(np.mean((np.array(valid) - np.mean(train)) ** 2)), rel=1e-3)
    assert found[0].params == "regParam=0.01"


def test_models_by_pair_equal_least_squares(processed):
    """All 19 features, several of which are sums of others: predictions of the least-norm solution."""
    frame = training.training_frame(processed)
    fitted = validation.linear_by_pair(frame, ridge=1e-6)
    predicted = validation.predict_by_pair(frame, fitted)
    for pair in ("A", "B"):
        rows = predicted.filter(F.col("Pair") == pair).collect()
        x = np.array([[r[c] for c in FEATURES] for r in rows])
        y = np.array([r.Close_h1 for r in rows])
        spread = x.std(0)
        used = spread > 1e-12 * np.abs(x.mean(0))
        unit = (x[:, used] - x[:, used].mean(0)) / spread[used]
        left = np.vstack([unit, np.sqrt(1e-6 * len(y)) * np.eye(used.sum())])
        slopes = np.linalg.lstsq(left, np.concatenate([y - y.mean(), np.zeros(used.sum())]), rcond=None)[0]
        assert np.allclose([r.prediction for r in rows], unit @ slopes + y.mean(), atol=1e-5)
    models = {r.Pair: r for r in fitted.collect()}
    assert set(models) == {r.Pair for r in frame.select("Pair").distinct().collect()}
    assert models["C"].r2 is None and models["C"].intercept == pytest.approx(5.0)
    assert models["A"].n == frame.filter("Pair = 'A'").count()


@pytest.mark.parametrize("scale", [1e-4, 1.0, 1e12])
def test_ranges_follow_the_scores(spark, scale):
    """No range of scores holds more than a few per cent of the distinct ones, whatever their size."""
    rng = np.random.default_rng(1)
    score, label = rng.normal(size=20_000) * scale, rng.random(20_000) < 0.4
    score[:3_000] = score[0]
    rows = spark.createDataFrame(
        [(float(s), float(x)) for s, x in zip(score, label)], "score double, PriceDirection double"
    )
    area = metrics.auc_roc(rows, score="score")
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    same = score == score[0]
    ranks[same] = ranks[same].mean()
    up = label.sum()
    truth = (ranks[label].sum() - up * (up + 1) / 2) / (up * (len(label) - up))
    assert area.first().auc == pytest.approx(truth, abs=1e-12)


def test_ticks_of_one_time_have_an_order(spark):
    when = "2024-03-10 02:30:15"  # an hour that a zone may not have
    rows = [(when, 5.0, 2), (when, 9.0, 1), (when, 7.0, 3), ("2024-03-10 02:30:10", 1.0, 9)]
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            for order in (rows, rows[::-1]):
                df = spark.createDataFrame(order, "t string, value double, id int").select(
                    F.col("t").cast("timestamp_ntz").alias("ts"), "value", "id", F.lit("p").alias("event_type"))
                for frame, start in (("1h", "2024-03-10 02:00:00"), ("1min", "2024-03-10 02:30:00"),
                                     ("1d", "2024-03-10 00:00:00")):
                    bar = ticks.bars(df, frame, ties=("id",)).first()
                    assert (str(bar.Date), bar.Open, bar.Close) == (start, 1.0, 7.0)
                    assert ticks.bars(df, frame).first().Close == 9.0
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
