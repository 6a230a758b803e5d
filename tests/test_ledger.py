import os

import pytest
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from barlab.operators import documents as docs
from barlab.operators import features
from barlab.operators import forecast as fc
from barlab.operators import messages as msg
from barlab.operators import models, training
from barlab.session import scratch, shared_dir, written
from barlab.sources import topics
from barlab.streaming import jobs

from test_forecast import RATE, STATEMENT, formula
from test_streaming import send, stream, trigger


def stored(spark, path):
    rows = jobs.committed(spark, path).select("key", "value", "position.source", "position.nth")
    return sorted((r.value, os.path.basename(r.source), r.nth) for r in rows.collect())


def run_sink(spark, source, write, checkpoint, **options):
    jobs.start_document_sink(stream(spark, source, **options), write, checkpoint).awaitTermination()


def test_positions_number_the_lines_of_files(spark, tmp_path):
    path = str(tmp_path / "topic")
    for part in (["a", "b", "a"], ["c"], [f"v{i}" for i in range(5_000)]):
        send(spark, path, *part)
    for block in ("128m", "20000b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        try:
            rows = topics.read_topic(spark, "json", positions=True, path=path).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        places = {(r.position.source, r.position.nth): r.value for r in rows}
        assert len(places) == len(rows) == 5_004
        for source in {s for s, _ in places}:
            with open(source.removeprefix("file:").replace("///", "/")) as file:
                lines = [line for line in file if line.strip()]
            assert [f'"value":"{places[source, i]}"' in line for i, line in enumerate(lines)] == [True] * len(lines)


def test_second_checkpoint_neither_overwrites_nor_repeats(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write = jobs.committed_folder(out)
    send(spark, source, "x", "x", '{"model":"RandomForest"}')
    run_sink(spark, source, write, str(tmp_path / "cp1"))
    first = stored(spark, out)
    assert len(first) == 3
    run_sink(spark, source, jobs.committed_folder(out), str(tmp_path / "cp2"))
    assert stored(spark, out) == first
    send(spark, source, "y")
    run_sink(spark, source, write, str(tmp_path / "cp1"))
    run_sink(spark, source, jobs.committed_folder(out), str(tmp_path / "cp3"), maxFilesPerTrigger="1")
    assert [v for v, _, _ in stored(spark, out)] == sorted(["x", "x", "y", '{"model":"RandomForest"}'])
    runs = jobs.ledger(spark, out).select("run").distinct().count()
    assert runs == 3


def test_half_done_batches_do_not_count(spark, tmp_path):
    """A run that dies between writing rows and committing them, then a new checkpoint."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    send(spark, source, "a", "b")
    good = jobs.committed_folder(out)

    def dies(rows, batch_id):
        rows.write.mode("overwrite").parquet(
            f"{out}/documents/run={jobs.run_id(rows.sparkSession)}/batch_id={batch_id}")
        raise RuntimeError("lost before the commit")

    with pytest.raises(Exception, match="lost before the commit"):
        run_sink(spark, source, dies, str(tmp_path / "cp1"))
    spark.streams.resetTerminated()
    run_sink(spark, source, good, str(tmp_path / "cp2"))
    assert [v for v, _, _ in stored(spark, out)] == ["a", "b"]
    run_sink(spark, source, good, str(tmp_path / "cp1"))  # the first run goes on, and adds nothing
    assert [v for v, _, _ in stored(spark, out)] == ["a", "b"]


def test_batch_that_failed_after_its_commit_is_not_written_again(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    send(spark, source, "a", "a")
    write = jobs.committed_folder(out)

    def breaks(rows, batch_id):
        write(rows, batch_id)
        raise RuntimeError("lost after the commit")

    with pytest.raises(Exception, match="lost after the commit"):
        run_sink(spark, source, breaks, str(tmp_path / "cp"))
    spark.streams.resetTerminated()
    run_sink(spark, source, write, str(tmp_path / "cp"))
    assert [v for v, _, _ in stored(spark, out)] == ["a", "a"]


def test_audit_names_missing_and_doubled_messages(spark, tmp_path):
    source = str(tmp_path / "in")
    send(spark, source, '{"model":"RandomForest"}', '{"model":"RandomForest"}', "odd", '{"model":"LogisticRegression"}')
    published = topics.read_topic(spark, "json", positions=True, path=source)
    held = written(docs.documents(published))
    nth = F.col("position.nth")
    damaged = held.filter(nth != 1).union(held.filter(nth == 3))
    assert [r.position.nth for r in docs.unstored(published, damaged).collect()] == [1]
    summary = {r.collection: tuple(r)[1:] for r in docs.sink_summary(published, damaged).collect()}
    assert summary == {"rf_predictions": (2, 1, 1, 0), "rejects": (1, 1, 0, 0), "lr_signals": (1, 1, 0, 1)}
    assert docs.unstored(published, held).count() == 0


@pytest.fixture(scope="module")
def triggers(make_bars):
    closes = {"A": [10 + (i * 7 % 11) / 3 for i in range(40)], "B": [5.0, 4.0, 6.0, 5.5]}
    both = make_bars(closes).unionByName(make_bars({"A": [1.0, 3.0, 2.0, 5.0, 4.0]}, "1d"))
    return written(fc.trigger_rows(features.bar_features(both)))


def with_positions(rows, first):
    return rows.withColumn("position", F.struct(
        F.lit(None).cast("timestamp").alias("arrived"), F.lit("t/0").alias("source"),
        (F.lit(first) + F.col("hour")).cast("long").alias("nth")))


def shown(rows):
    return {(r.pair, r.timeframe, r.hour): r.predicted_close for r in rows.collect()}


@pytest.mark.parametrize("saved", [False, True])
def test_forecast_goes_on_from_stored_closes(triggers, saved):
    """Stored closes differ from computed ones; a gap, an older version, and other series."""
    predict = SQLTransformer(statement=STATEMENT) if saved else formula
    made = fc.forecast(triggers, formula, horizon=9)
    other = made.withColumn("predicted_close", F.col("predicted_close") + 100)
    newer = made.withColumn("predicted_close", F.col("predicted_close") + F.col("hour") / 7)
    a_hours = newer.filter("pair = 'A' and timeframe = '1h' and hour <= 4")
    after_gap = newer.filter("pair = 'B' and hour in (1, 3)")
    kept = written(
        with_positions(other.filter("pair = 'A' and timeframe = '1h' and hour <= 5"), 0)
        .unionByName(with_positions(a_hours, 50)).unionByName(with_positions(after_gap, 90))
    )
    got = shown(fc.forecast(triggers, predict, horizon=9, stored=kept))
    plain, says = shown(made), {(r.pair, r.timeframe, r.hour): r.predicted_close for r in newer.collect()}
    old = shown(other)
    assert len(got) == 3 * 9
    for key in plain:
        pair, frame, hour = key
        if (pair, frame) == ("A", "1d"):
            assert got[key] == pytest.approx(plain[key])
        elif pair == "A":
            if hour <= 5:
                assert got[key] == pytest.approx(says[key] if hour <= 4 else old[key])
            elif hour > 6:
                step = got[pair, frame, hour - 1] + RATE * (got[pair, frame, hour - 1] - got[pair, frame, hour - 2])
                assert got[key] == pytest.approx(step)
        elif hour == 1:
            assert got[key] == pytest.approx(says[key])
        elif hour > 2:  # hour 3 is stored, but not hour 2 it rests on
            step = got[pair, frame, hour - 1] + RATE * (got[pair, frame, hour - 1] - got[pair, frame, hour - 2])
            assert got[key] == pytest.approx(step)


def test_whole_stored_forecast_needs_no_step(triggers):
    made = fc.forecast(triggers, formula, horizon=6)
    kept = written(with_positions(made, 0))
    assert shown(fc.forecast(triggers, SQLTransformer(statement="SELECT *, 0D AS prediction FROM __THIS__"),
                             horizon=6, stored=kept)) == shown(made)


def tables(spark):
    return {d for d in os.listdir(shared_dir(spark)) if d.startswith(("forecast-", "scope"))}


def test_ten_batches_leave_no_table(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(10):
        send(spark, source, trigger(f"P{i}", 1 + i))
    before = tables(spark)
    query = jobs.start_forecasts(
        stream(spark, source, maxFilesPerTrigger="1"), SQLTransformer(statement=STATEMENT),
        jobs.per_batch_folder(out), str(tmp_path / "cp"), horizon=4, available_now=True,
    )
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 10
    assert msg.parse_forecasts(spark.read.parquet(out)).count() == 40
    assert tables(spark) == before


def test_scratch_ends_with_its_scope(spark):
    with scratch(spark, "scope-test") as folder:
        inner = written(spark.range(5))
        assert inner.count() == 5 and folder in inner.inputFiles()[0]
    assert not os.path.exists(folder.removeprefix("file:"))
    assert folder not in written(spark.range(2)).inputFiles()[0]


def test_messages_of_three_models_come_from_one_scan(spark, make_bars):
    frame = training.training_frame(features.bar_features(make_bars({"A": [float(i % 9) for i in range(60)]})))
    scored = written(frame.withColumn("prediction", F.col("Close")).withColumn("direction", F.lit(1.0)))
    messages = msg.publish_predictions_json(scored, {
        models.RANDOM_FOREST: models.price_fields("RF_Predicted"),
        models.BOOSTED_TREES: models.price_fields("GBT_Predicted", prediction="Close"),
        models.LOGISTIC: models.signal_fields(prediction="direction"),
    })
    plan = messages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan
    parts = msg.bridge_csv_json({
        models.RANDOM_FOREST: models.price_predictions(scored, "RF_Predicted"),
        models.BOOSTED_TREES: models.price_predictions(scored, "GBT_Predicted"),
        models.LOGISTIC: models.signal_recode(scored.withColumn("prediction", F.col("direction"))),
    })
    assert sorted(map(tuple, messages.collect())) == sorted(map(tuple, parts.collect()))
