import json

import pytest

from barlab.operators import features
from barlab.operators import forecast as fc
from barlab.operators import messages as msg
from barlab.schemas import FEATURES
from barlab.session import fresh_dir
from barlab.sources import topics
from barlab.streaming import jobs


def step(state):
    return state["Close"] * 1.01


def send(spark, path, *values):
    """One more file in the topic folder."""
    rows = [("k", v, None) for v in values]
    table = spark.createDataFrame(rows, "key string, value string, timestamp timestamp")
    table.coalesce(1).write.mode("append").json(path)


def trigger(pair, close):
    fields = {"Date": "2024-01-01", "Pair": pair, "Timeframe": "1h"}
    return json.dumps(fields | {name: str(close) for name in FEATURES})


def stream(spark, path, **options):
    return topics.stream_topic(spark, "json", path=path, **options)


def test_forecasts_equal_the_batch_result(spark, tmp_path, make_bars):
    processed = features.bar_features(make_bars({"A": [1.0, 2.0, 3.0, 4.0], "B": [5.0] * 9}))
    triggers = fc.trigger_rows(processed)
    msg.row_messages(triggers).write.json(str(tmp_path / "in"))
    jobs.start_forecasts(
        stream(spark, str(tmp_path / "in")), step, jobs.per_batch_folder(str(tmp_path / "out")),
        str(tmp_path / "cp"), available_now=True,
    ).awaitTermination()
    streamed = msg.parse_forecasts(spark.read.parquet(str(tmp_path / "out")))
    batch = fc.forecast(triggers, step).select(streamed.columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        jobs.start_forecasts(
            stream(spark, source), step, jobs.per_batch_folder(out), cp, horizon=2, available_now=True
        ).awaitTermination()

    send(spark, source, trigger("A", 1), "no trigger")
    run()
    run()
    send(spark, source, trigger("B", 2))
    run()
    pairs = [r.pair for r in msg.parse_forecasts(spark.read.parquet(out)).collect()]
    assert sorted(pairs) == ["A", "A", "B", "B"]


def test_failed_batch_is_replaced_on_retry(spark, tmp_path):
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    send(spark, source, '{"model":"RandomForest","Pair":"A"}', '{"model":"RandomForest","Pair":"B"}')
    write = jobs.per_batch_folder(out, partition_by=("collection",))

    def breaks(rows, batch_id):
        write(rows, batch_id)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        jobs.start_document_sink(stream(spark, source), breaks, cp).awaitTermination()
    spark.streams.resetTerminated()
    assert spark.read.parquet(out).count() == 2
    jobs.start_document_sink(stream(spark, source), write, cp).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_sink_stores_every_message(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    send(spark, source, *['{"model":"LogisticRegression","Pair":"A"}'] * 3, "broken", '{"model":"new"}')
    write = jobs.per_batch_folder(out, partition_by=("collection",))
    jobs.start_document_sink(stream(spark, source), write, str(tmp_path / "cp")).awaitTermination()
    counts = dict(spark.read.parquet(out).groupBy("collection").count().collect())
    assert counts == {"lr_signals": 3, "rejects": 2}


def test_batch_sizes_store_the_same_documents(spark, tmp_path):
    source, stored = str(tmp_path / "in"), []
    for _ in range(4):
        send(spark, source, *['{"model":"LogisticRegression","Pair":"A"}'] * 2)
    for size in ("1", "3", "1000"):
        out = str(tmp_path / f"out{size}" / "{collection}")
        for _ in range(2):  # the second run repeats every batch
            jobs.start_document_sink(
                stream(spark, source, maxFilesPerTrigger=size), jobs.to_collections("json", path=out),
                fresh_dir(spark, "cp"),
            ).awaitTermination()
        ids = [r["_id"] for r in spark.read.json(out.format(collection="lr_signals")).collect()]
        assert len(ids) == 16 and len(set(ids)) == 8
        stored.append(sorted(ids))
    assert stored[0] == stored[1] == stored[2]


def test_documents_go_to_one_place_per_collection(spark, tmp_path):
    source = str(tmp_path / "in")
    send(spark, source, '{"model":"RandomForest","Pair":"A"}', '{"model":"RF_h1_recursive","hour":1}', "x")
    write = jobs.to_collections("json", path=str(tmp_path / "{collection}"))
    jobs.start_document_sink(stream(spark, source), write, str(tmp_path / "cp")).awaitTermination()
    ids = set()
    for name in ("rf_predictions", "forecasts", "rejects"):
        rows = spark.read.json(str(tmp_path / name)).collect()
        assert len(rows) == 1
        ids.add(rows[0]["_id"])
    assert len(ids) == 3


def test_forecasts_can_be_published(spark, tmp_path):
    source, topic = str(tmp_path / "in"), str(tmp_path / "topic")
    send(spark, source, trigger("A", 1))
    jobs.start_forecasts(
        stream(spark, source), step, jobs.to_topic("json", path=topic), str(tmp_path / "cp"),
        horizon=3, available_now=True,
    ).awaitTermination()
    assert [r.key for r in topics.read_topic(spark, "json", path=topic).collect()] == ["A"] * 3


def test_batches_are_bounded(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(5):
        send(spark, source, str(i))
    query = jobs.start_copy(
        stream(spark, source, maxFilesPerTrigger="2"), out, str(tmp_path / "cp")
    )
    query.awaitTermination()
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(sizes) == 5 and max(sizes) <= 2
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == list("01234")


def test_several_queries_run_at_once(spark, tmp_path):
    spark.streams.resetTerminated()
    source = str(tmp_path / "in")
    send(spark, source, trigger("A", 1))
    forecasting = jobs.start_forecasts(
        stream(spark, source), step, jobs.per_batch_folder(str(tmp_path / "out")),
        str(tmp_path / "cp1"), horizon=3, every="1 second",
    )
    monitor = jobs.start_monitor(
        stream(spark, source), format="memory", every="1 second", name="seen"
    )
    try:
        assert {q.name for q in spark.streams.active} >= {"recursive_forecast", "seen"}
        forecasting.processAllAvailable()
        monitor.processAllAvailable()
        assert jobs.wait_any(spark, 1) is False
        assert spark.table("seen").columns == ["pair", "prediction_json"]
        assert spark.table("seen").count() == 1
        assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    finally:
        forecasting.stop()
        monitor.stop()


def test_kafka_options_carry_the_defaults():
    options = topics.kafka_options("broker:9092", "live", maxOffsetsPerTrigger="500")
    assert options["startingOffsets"] == "latest" and options["failOnDataLoss"] == "false"
    assert options["subscribe"] == "live" and options["maxOffsetsPerTrigger"] == "500"
