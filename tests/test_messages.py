import json

import pytest
from pyspark.sql import functions as F

from barlab.operators import documents as docs
from barlab.operators import features
from barlab.operators import forecast as fc
from barlab.operators import messages as msg
from barlab.operators import models
from barlab.schemas import FEATURES


def topic(spark, *values):
    rows = [(f"k{i}", v, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key string, value string, timestamp timestamp")


def trigger(**changes):
    fields = {"Date": "2024-01-01 00:00:00", "Pair": "A", "Timeframe": "1h"}
    fields |= {name: "1.5" for name in FEATURES}
    fields |= changes
    return json.dumps({k: v for k, v in fields.items() if v is not None})


def test_only_usable_triggers_pass(spark):
    parsed = msg.parse_triggers(topic(
        spark, trigger(), trigger(Close=None), trigger(Close_lag1="null"), "no json", None,
        trigger(Gain=None, Pair="B"), trigger(MA20="0", Pair="C"),
    ))
    rows = {r.Pair: r for r in parsed.collect()}
    assert set(rows) == {"A", "B", "C"}
    assert rows["B"].Gain is None and rows["C"].MA20 == 0.0
    assert parsed.columns == ["kafka_timestamp", "Date", "Pair", "Timeframe", *FEATURES]


def test_row_messages_are_text_objects(make_bars):
    processed = features.bar_features(make_bars({"A": [2.0]}))
    row = msg.row_messages(processed).collect()[0]
    fields = json.loads(row.value)
    assert list(fields) == processed.columns and row.key == "A"
    assert all(isinstance(v, str) for v in fields.values())
    assert fields["Volatility5"] == "" and fields["Close"] == "2.0"


def test_replayed_bars_are_no_triggers(make_bars):
    processed = features.bar_features(make_bars({"A": [2.0, 3.0, 4.0, 5.0]}))
    messages = msg.row_messages(processed).unionByName(msg.row_messages(fc.trigger_rows(processed)))
    parsed = msg.parse_triggers(messages).collect()
    assert len(parsed) == 1 and parsed[0].Close_lag1 == 4.0


def test_bridge_tags_trims_and_keys(spark):
    a = spark.createDataFrame([(" A ", " 1.5", None)], "Pair string, Close string, Date string")
    b = spark.createDataFrame([("x",)], "Signal string")
    rows = msg.bridge_csv_json({models.RANDOM_FOREST: a, models.LOGISTIC: b}).collect()
    assert [(r.key, r.value) for r in rows] == [
        ("A", '{"model":"RandomForest","Pair":"A","Close":"1.5","Date":""}'),
        ("LogisticRegression", '{"model":"LogisticRegression","Signal":"x"}'),
    ]


@pytest.fixture(scope="module")
def stored(spark):
    return docs.documents(topic(
        spark,
        '{"model":"RandomForest","Date":"2024-01-01","Pair":"A","Close":"1.5","Actual_h1":"bad"}',
        '{"model":"GradientBoostedTrees","Date":"2024-01-01","Pair":"A","GBT_Predicted":"2"}',
        '{"model":"LogisticRegression","Pair":"A","Actual":"1","Signal":"BUY","extra":"7","note":"n"}',
        '{"model":"RF_h1_recursive","pair":"A","hour":3,"predicted_close":1.25}',
        '{"model":"Other","Close":"1"}', "no json", None,
    )).persist()


def test_routing(stored):
    counts = {r.collection: r.documents for r in docs.collection_counts(stored).collect()}
    assert counts == {"rf_predictions": 1, "gbt_predictions": 1, "lr_signals": 1, "forecasts": 1, "rejects": 3}


def test_known_models_only(spark):
    messages = topic(spark, '{"model":"RandomForest"}', '{"model":"RF_h1_recursive"}', "x")
    assert docs.documents(messages, known_only=True).count() == 1
    kept = docs.documents(messages, known_only=True)
    assert docs.missing_rows(messages, kept, ["key", "value"]).count() == 2


def test_field_types(stored):
    row = {r.collection: r for r in stored.filter("collection != 'rejects'").collect()}
    forest = row["rf_predictions"]
    assert forest.Close == 1.5 and forest.Actual_h1 is None and forest.texts == {"Actual_h1": "bad"}
    signals = row["lr_signals"]
    assert (signals.Actual, signals.Signal) == ("1", "BUY")
    assert signals.numbers == {"extra": 7.0} and signals.texts == {"note": "n"}
    assert row["forecasts"].numbers == {"hour": 3.0, "predicted_close": 1.25}


def test_field_view_agrees(spark):
    messages = topic(spark, '{"model":"M","Close":"1.5","Actual":"2","odd":"x"}')
    got = {r.field: (r.number, r.text) for r in docs.typed_fields(messages).collect()}
    assert got == {"model": (None, "M"), "Close": (1.5, None), "Actual": (None, "2"), "odd": (None, "x")}


def test_one_sample_per_collection(stored):
    samples = docs.sample_documents(stored).collect()
    assert sorted(r.collection for r in samples) == sorted(
        {"rf_predictions", "gbt_predictions", "lr_signals", "forecasts", "rejects"})
    assert set(samples[0].asDict()) == set(stored.columns)


def test_reconcile_prefers_what_was_stored(spark):
    schema = "pair string, trigger_date string, hour int, predicted_close double"
    computed = spark.createDataFrame([("A", "d", h, float(h)) for h in (1, 2, 3)], schema)
    kept = spark.createDataFrame([("A", "d", 1, 9.0), ("A", "d", 1, 9.0), ("A", "d", 2, None)], schema)
    rows = {r.hour: (r.close, r.source) for r in docs.reconcile(computed, kept).collect()}
    assert rows == {1: (9.0, "stored"), 2: (2.0, "computed"), 3: (3.0, "computed")}


def test_forecast_messages_round_trip(make_bars):
    processed = features.bar_features(make_bars({"A": [2.0, 3.0, 4.0, 5.0, 7.0]}))
    forecasts = fc.forecast(fc.trigger_rows(processed), lambda s: s["Close"] * 1.01)
    back = msg.parse_forecasts(msg.forecast_messages(forecasts))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, forecasts.select(back.columns).collect()))
    counts = msg.publish_counts(msg.forecast_messages(forecasts)).collect()
    assert [tuple(r) for r in counts] == [("RF_h1_recursive", 24)]


def test_counts_of_messages_without_a_model(spark):
    got = msg.publish_counts(topic(spark, '{"a":1}', '{"model":"x"}')).orderBy(F.col("model")).collect()
    assert [tuple(r) for r in got] == [(None, 1), ("x", 1)]
