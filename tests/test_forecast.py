import math

import pytest
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from barlab.operators import features, training
from barlab.operators import forecast as fc
from barlab.schemas import FEATURES

RATE = 0.37
STATEMENT = f"SELECT *, Close + {RATE} * (Close - Close_lag1) AS prediction FROM __THIS__"


def formula(state):
    return state["Close"] + F.lit(RATE) * (state["Close"] - state["Close_lag1"])


@pytest.fixture(scope="module")
def processed(make_bars):
    closes = {
        "A": [10 + (i * 7 % 11) / 3 for i in range(40)],
        "B": [5.0, 4.0, 6.0, 5.5],
        "C": [1.0, 2.0, 3.0],
        "Z": [0.0] * 30,
    }
    return features.bar_features(make_bars(closes)).persist()


def by_hand(f, hours, shift=False, history=None):
    """The recursion written out for one trigger, step by step."""
    short = [f["Close_lag3"], f["Close_lag2"], f["Close_lag1"], f["Close"]]
    long = list(history) if history else [f["Close"]] * 20
    rows = []
    for hour in range(1, hours + 1):
        old = f["Close"]
        p = old + RATE * (old - f["Close_lag1"])
        rows.append((hour, p, old, f["MA5"], f["MA20"], f["Volatility5"]))
        short, long = [*short, p], [*long, p]
        five, twenty = short[-5:], long[-20:]
        ma5, ma20 = sum(five) / len(five), sum(twenty) / len(twenty)
        f = {
            **f, "Open": old, "High": max(old, p), "Low": min(old, p), "Close": p,
            "Range": abs(p - old), "Change": p - old,
            "ChangePct": (p - old) / old * 100 if old else 0.0,
            "MA5": ma5, "MA20": ma20,
            "Volatility5": math.sqrt(sum((x - ma5) ** 2 for x in five) / 5),
            "Gain": max(p - old, 0.0), "Loss": max(old - p, 0.0),
            "Close_lag1": old, "Close_lag2": f["Close_lag1"], "Close_lag3": f["Close_lag2"],
            "Change_lag1": f["Change"] if shift else p - old, "Change_lag2": f["Change_lag1"],
            "MA5_MA20_Ratio": ma5 / ma20 if ma20 else 1.0,
        }
    return rows, f


def curve(df, pair):
    cols = ["hour", "predicted_close", "current_close", "ma5", "ma20", "volatility5"]
    return [tuple(r) for r in df.filter(F.col("pair") == pair).orderBy("hour").select(*cols).collect()]


def features_of(triggers, pair):
    row = triggers.filter(F.col("Pair") == pair).collect()[0].asDict()
    return {k: float(row[k] or 0.0) for k in FEATURES}


def test_triggers(processed):
    rows = {r.Pair: r for r in fc.trigger_rows(processed).collect()}
    assert set(rows) == {"A", "B", "Z"}
    assert rows["B"].Close == 5.5
    assert (rows["B"].Close_lag1, rows["B"].Close_lag2, rows["B"].Close_lag3) == (6.0, 4.0, 5.0)
    assert rows["Z"].MA5_MA20_Ratio == 1.0
    lagged = training.lag_features(processed).filter("Pair = 'A'").orderBy(F.desc("Date")).first()
    assert (rows["A"].Close_lag3, rows["A"].Change_lag2) == (lagged.Close_lag3, lagged.Change_lag2)


@pytest.mark.parametrize("pair", ["A", "B", "Z"])
@pytest.mark.parametrize("shift", [False, True])
def test_fold_equals_recursion_by_hand(processed, pair, shift):
    triggers = fc.trigger_rows(processed)
    expected, last = by_hand(features_of(triggers, pair), 24, shift)
    states = fc.run_formula(fc.forecast_init(triggers), formula, shift_change_lag=shift)
    got = curve(fc.forecast_rows(states), pair)
    assert len(got) == 24
    for a, b in zip(got, expected):
        assert a == pytest.approx(b, abs=1e-9)
    final = states.filter(F.col("Pair") == pair).select("state.*").collect()[0]
    for name in FEATURES:
        assert final[name] == pytest.approx(last[name], abs=1e-9), name


@pytest.mark.parametrize("every", [0, 2])
def test_model_steps_equal_the_fold(processed, every):
    triggers = fc.trigger_rows(processed)
    one = fc.forecast(triggers, SQLTransformer(statement=STATEMENT), horizon=5, write_every=every)
    two = fc.forecast(triggers, formula, horizon=5)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_history_seed(processed):
    triggers = fc.trigger_rows(processed, history=20)
    closes = [r.Close for r in processed.filter("Pair = 'A'").orderBy("Date").collect()]
    expected, _ = by_hand(features_of(triggers, "A"), 24, history=closes[-20:])
    got = curve(fc.forecast(triggers, formula, seed="history"), "A")
    for a, b in zip(got, expected):
        assert a == pytest.approx(b, abs=1e-9)
    short = fc.forecast_init(triggers.filter("Pair = 'B'"), seed="history").collect()[0].state
    assert short.long_closes == [5.0] * 16 + [4.0, 6.0, 5.5]


def test_missing_features_are_zero_or_rejected(processed):
    holed = fc.trigger_rows(processed).withColumn("Gain", F.when(F.col("Pair") != "A", F.col("Gain")))
    assert fc.forecast(holed, formula).count() == 72
    assert fc.forecast(holed, formula, missing="reject").count() == 48
    assert [r.Pair for r in fc.incomplete_triggers(holed).collect()] == ["A"]


def test_reports(processed):
    forecasts = fc.forecast(fc.trigger_rows(processed), formula).persist()
    total = {r.pair: r for r in fc.forecast_total(forecasts).collect()}
    last = {r.pair: r.predicted_close for r in forecasts.filter("hour = 24").collect()}
    assert {p: r.final_close for p, r in total.items()} == last
    assert total["Z"].total_pct is None and total["Z"].total_change == 0
    text = {(r.pair, r.hour): r for r in fc.forecast_summary(forecasts).collect()}
    sample = text["B", 1]
    assert sample.change_text == f"{sample.change_pct:.4f}%" and sample.change < 0
    assert all(r.direction == ("UP" if r.predicted >= r.current else "DOWN")
               for r in fc.forecast_stats(forecasts).collect() if r.pair != "Z")
    shown = fc.forecast_curve(processed, forecasts).filter("pair = 'A'").orderBy("position").collect()
    assert [r.label for r in shown] == [f"h-{k}" for k in range(24, 0, -1)] + [f"h+{k}" for k in range(1, 25)]
    assert shown[23].historical == total["A"].base_close and shown[23].forecast is None


def test_forecast_needs_no_shuffle(processed, spark):
    from barlab.session import written

    triggers = written(fc.trigger_rows(processed))
    plan = fc.forecast(triggers, formula)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
