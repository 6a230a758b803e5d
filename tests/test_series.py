import random

import pytest
from pyspark.sql import functions as F

from barlab.operators import features, series, training
from barlab.operators.series import over_series


@pytest.fixture(scope="module")
def uneven(make_bars):
    """Series with dense days, nearly empty days, long gaps, and one dominant pair."""
    rng = random.Random(7)
    closes = {}
    for pair, n, step in (("AAA", 900, 1), ("BBB", 60, 30), ("CCC", 3, 5), ("DDD", 1, 1), ("EEE", 200, 9)):
        hour, values = 0, []
        for _ in range(n):
            hour += rng.randint(1, step)
            values.append((hour, round(rng.uniform(1, 50), 2)))
        rng.shuffle(values)
        closes[pair] = values
    return make_bars(closes).persist()


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("days", [1, 2, 7, 60])
def test_chunked_windows_equal_plain_windows(uneven, days):
    chunked = features.bar_features(uneven, chunk_days=days)
    assert rows(chunked) == rows(features.bar_features(uneven, chunk_days=0))


@pytest.mark.parametrize("days", [1, 5])
def test_chunked_training_frame_equals_plain(uneven, days):
    processed = features.bar_features(uneven, chunk_days=0)
    chunked = training.training_frame(processed, chunk_days=days)
    plain = training.training_frame(processed, chunk_days=0)
    assert rows(chunked) == rows(plain)


@pytest.mark.parametrize("back,ahead", [(3, 0), (0, 24), (2, 9), (19, 1)])
def test_each_reach(uneven, back, ahead):
    builds = {
        "sum": lambda w: F.sum("Close").over(w.rowsBetween(-back, ahead)),
        "first": lambda w: F.lag("Close", back).over(w),
        "last": lambda w: F.lead("Close", ahead).over(w),
    }
    chunked = over_series(uneven, builds, back, ahead, chunk_days=1)
    assert rows(chunked) == rows(over_series(uneven, builds, back, ahead, chunk_days=0))


def test_nothing_is_lost_or_repeated(uneven):
    labelled = training.target_direction(uneven, chunk_days=1)
    assert labelled.count() == uneven.count()
    assert labelled.select("Pair", "Date").distinct().count() == uneven.count()


def test_missing_dates_and_names_stay(spark, make_bars):
    bars = make_bars({"AAA": [1.0, 2.0, 3.0], "BBB": [4.0]})
    odd = bars.withColumn("Date", F.when(F.col("Close") != 2.0, F.col("Date"))).withColumn(
        "Pair", F.when(F.col("Close") != 4.0, F.col("Pair"))
    )
    assert features.rolling_ma(odd).count() == 4


def test_series_tail_and_counts(uneven):
    tail = series.series_tail(uneven).groupBy("Pair").count().collect()
    assert dict(tail) == {"AAA": 4, "BBB": 4, "CCC": 3, "DDD": 1, "EEE": 4}
    counts = {r.Pair: r.rows for r in series.load_counts(uneven).collect()}
    assert counts == {"AAA": 900, "BBB": 60, "CCC": 3, "DDD": 1, "EEE": 200}


def test_rank_limit_runs_before_the_shuffle(uneven):
    plan = series.series_tail(uneven)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rows_are_shuffled_and_sorted_once(spark, uneven):
    from barlab.session import written

    stored = written(features.bar_features(uneven))
    for days in (None, 2):
        frame = training.training_frame(stored, chunk_days=days)
        plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_equal_dates_give_one_result_in_any_order(spark, uneven):
    """Rows of one date, on both sides of borders, in two orders of arrival."""
    doubled = uneven.union(uneven.withColumn("Close", F.col("Close") + 1).withColumn("Volume", F.col("Volume") + 7))
    found = []
    for seed in (1, 2):
        shuffled = doubled.repartition(7).orderBy(F.xxhash64("Date", "Close", F.lit(seed))).coalesce(3)
        for days in (0, 1, 3):
            found.append(rows(features.bar_features(shuffled, chunk_days=days)))
        found[-1], tail = found[-1], series.series_tail(shuffled, 3)
        found.append(sorted(map(str, tail.collect())))
    assert found[0] == found[1] == found[2] == found[4] == found[5] == found[6]
    assert found[3] == found[7]


def test_other_bar_lengths_get_chunks_of_their_own_width(make_bars):
    builds = {"s": lambda w: F.sum("Close").over(w.rowsBetween(-4, 0))}
    bars = make_bars({"A": [(4 * i, float(i % 7)) for i in range(3000)]}, "4h")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(over_series(bars, builds, back=4)) == rows(over_series(bars, builds, back=4, chunk_days=0))
