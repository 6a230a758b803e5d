import json

import pytest
from pyspark.sql import functions as F

from barlab.operators import models
from barlab.operators import forecast as fc
from barlab.operators import messages as msg
from barlab.plans import jobs
from barlab.session import fresh_dir, shared_dir, written
from barlab.sinks.topics import publish
from barlab.sources import files, topics


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    """Raw files of two pairs, prepared and trained on."""
    base = tmp_path_factory.mktemp("work")
    (base / "raw").mkdir()
    for pair, shift in (("EURUSD", 1.0), ("GBPUSD", 3.0)):
        lines = ["Date,Open,High,Low,Close,Volume"]
        for i in range(120):
            o, c = shift + (i % 5) / 10, shift + (i * 7 % 11) / 10
            lines.append(f"2024-01-{i // 24 + 1:02d} {i % 24:02d}:00:00,{o},{max(o, c)},{min(o, c)},{c},{i + 1}")
        (base / "raw" / f"{pair}_1h_2017-01-01_2024-12-31.csv").write_text("\n".join(lines))
    jobs.prepare(spark, str(base / "raw"), str(base / "processed"))
    comparison = jobs.train(
        spark, str(base / "processed"), str(base / "ml"),
        estimators={
            models.RANDOM_FOREST: models.random_forest(numTrees=3, maxDepth=2),
            models.BOOSTED_TREES: models.boosted_trees(maxIter=2, maxDepth=2),
            models.LOGISTIC: models.logistic(maxIter=10),
        },
        publish=lambda m: publish(m, "json", path=str(base / "topic")),
    )
    return base, comparison


def test_prepare_writes_every_series(spark, work):
    table = files.read_processed(spark, str(work[0] / "processed"), "parquet")
    assert dict(table.groupBy("Pair").count().collect()) == {"EURUSD": 120, "GBPUSD": 120}


def test_bad_lines_are_kept_out_of_the_windows(spark, tmp_path):
    good = [f"2024-01-{d:02d} 00:00:00,1.0,1.2,0.9,1.{d % 10},{d}" for d in range(1, 26)]
    bad = ["not a date,1,2,3,99,5", "2024-01-03 00:00:00,7", ",1,2,3,99,5", "2024-01-04 00:00:00,1,2,3,,5"]
    header = "Date,Open,High,Low,Close,Volume"
    for name, lines in (("clean", good), ("dirty", [*bad[:2], *good, *bad[2:]])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "EURUSD_1d_x.csv").write_text("\n".join([header, *lines]))
        jobs.prepare(spark, str(tmp_path / name), str(tmp_path / f"{name}-out"),
                     rejects=str(tmp_path / f"{name}-rejects"))
    clean, dirty = (
        sorted(map(tuple, files.read_processed(spark, str(tmp_path / f"{n}-out"), "parquet").collect()))
        for n in ("clean", "dirty")
    )
    assert clean == dirty and len(clean) == 25
    rejects = spark.read.json(str(tmp_path / "dirty-rejects"))
    assert rejects.count() == 4
    assert all(r.file.endswith("EURUSD_1d_x.csv") for r in rejects.select("file").collect())


def test_train_saves_predictions_messages_and_metrics(spark, work):
    base, comparison = work
    assert {r.model for r in comparison.select("model").distinct().collect()} == set(models.default_estimators())
    signals = files.read_text_csv(spark, str(base / "ml" / "lr_signals.csv"))
    assert signals.columns == ["Date", "Pair", "Close", "Actual", "Signal"]
    assert {r.Actual for r in signals.collect()} <= {"UP", "DOWN"}
    frame = spark.read.parquet(str(base / "ml" / "training_frame"))
    assert frame.count() == 2 * 116
    published = topics.read_topic(spark, "json", path=str(base / "topic"))
    counts = dict(msg.publish_counts(published).collect())
    assert set(counts.values()) == {signals.count()} and len(counts) == 3
    value = json.loads(published.filter("value like '%RandomForest%'").first().value)
    assert list(value) == ["model", "Date", "Pair", "Close", "Actual_h1", "RF_Predicted"]


def test_triggers_to_forecast_with_the_saved_model(spark, work, tmp_path):
    base, _ = work
    jobs.send_triggers(spark, str(base / "processed"), lambda m: publish(m, "json", path=str(tmp_path / "t")))
    triggers = msg.parse_triggers(topics.read_topic(spark, "json", path=str(tmp_path / "t")))
    forecasts = fc.forecast(triggers, jobs.load_forecaster(str(base / "ml")), horizon=4)
    assert forecasts.count() == 8
    first = forecasts.filter("hour = 1").collect()
    assert all(r.current_close == r.base_close for r in first)


def test_full_replay_sends_every_row(spark, work, tmp_path):
    jobs.send_triggers(
        spark, str(work[0] / "processed"), lambda m: publish(m, "json", path=str(tmp_path / "t")),
        pairs=["EURUSD"], full=True,
    )
    replayed = topics.read_topic(spark, "json", path=str(tmp_path / "t"))
    assert replayed.count() == 120 and replayed.filter("key != 'EURUSD'").count() == 0


def test_bridge_publishes_the_files_there_are(spark, work, tmp_path):
    jobs.bridge_predictions(
        spark, str(work[0] / "ml"), lambda m: publish(m, "json", path=str(tmp_path / "t"))
    )
    bridged = topics.read_topic(spark, "json", path=str(tmp_path / "t"))
    assert msg.publish_counts(bridged).count() == 3
    jobs.bridge_predictions(spark, str(tmp_path / "none"), lambda m: pytest.fail("nothing to send"))


def test_training_without_bars_says_so(spark, work, tmp_path):
    with pytest.raises(ValueError, match="no training rows"):
        jobs.train(spark, str(work[0] / "processed"), str(tmp_path), timeframe="1d")


def test_scratch_lies_in_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base and fresh_dir(spark, "x").startswith(base)
    table = written(spark.range(3).withColumn("a", F.array("id")))
    assert table.inputFiles()[0].split("file:")[-1].lstrip("/").startswith(base.lstrip("/"))
    assert table.count() == 3
