from datetime import datetime

import pytest
from pyspark.sql import functions as F

from barlab.functions import prices
from barlab.operators import features, split, summaries, training
from barlab.schemas import FEATURES, PROCESSED_COLUMNS


def one(df):
    return df.collect()[0]


def test_partial_frames_are_kept_unless_strict(make_bars):
    bars = make_bars({"AAA": [float(i) for i in range(25)]})
    assert features.bar_features(bars).count() == 25
    assert features.bar_features(bars, strict_warmup=True).count() == 6
    assert tuple(features.bar_features(bars).columns) == PROCESSED_COLUMNS


@pytest.mark.parametrize("n", [1, 19, 20, 21])
def test_strict_warmup_borders(make_bars, n):
    bars = make_bars({"AAA": [float(i) for i in range(n)]})
    assert features.bar_features(bars, strict_warmup=True).count() == max(0, n - 19)


def test_volatility_is_the_sample_deviation(make_bars):
    got = features.bar_features(make_bars({"AAA": [1.0, 3.0]})).orderBy("Date").collect()
    assert got[0].Volatility5 is None
    assert got[1].Volatility5 == pytest.approx(2**0.5)


def test_zero_open_and_flat_bar(make_bars):
    assert one(features.price_features(make_bars({"AAA": [5.0]}, opens=0.0))).ChangePct is None
    flat = one(features.bar_features(make_bars({"AAA": [5.0]}, opens=5.0)))
    assert (flat.Range, flat.Change, flat.ChangePct, flat.Gain, flat.Loss) == (0, 0, 0, 0, 0)


def test_gain_and_loss(make_bars):
    up = one(features.gain_loss(make_bars({"A": [5.0]}, opens=3.0)))
    down = one(features.gain_loss(make_bars({"A": [5.0]}, opens=9.0)))
    assert (up.Gain, up.Loss, down.Gain, down.Loss) == (2.0, 0.0, 0.0, 4.0)


def test_rows_with_no_close_in_reach_fall_out(make_bars):
    bars = make_bars({"AAA": [1.0] + [None] * 25 + [2.0]})
    assert features.bar_features(bars).count() == 20 + 1


def test_every_pair_loses_four_rows(make_bars):
    bars = make_bars({p: [float(i % 7 + j + 2) for i in range(40)] for j, p in enumerate("ABC")})
    frame = training.training_frame(features.bar_features(bars))
    assert dict(frame.groupBy("Pair").count().collect()) == {"A": 36, "B": 36, "C": 36}


def test_series_shorter_than_the_lags_give_nothing(make_bars):
    frame = training.training_frame(features.bar_features(make_bars({"A": [2.0, 3.0, 4.0, 5.0]})))
    assert frame.count() == 0


def test_label_without_a_future_bar(make_bars):
    bars = make_bars({"A": [float(i) for i in range(25)]})
    compat = training.target_direction(bars).groupBy("PriceDirection").count().collect()
    assert dict(compat) == {1.0: 1, 0.0: 24}
    strict = training.target_direction(bars, strict=True).groupBy("PriceDirection").count().collect()
    assert dict(strict) == {1.0: 1, None: 24}
    frame = training.training_frame(features.bar_features(bars), strict_label=True)
    assert frame.count() == 0


def test_zero_average_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0), (1.0, None)], "a double, b double")
    null = [r[0] for r in df.select(prices.ma_ratio(F.col("a"), F.col("b"))).collect()]
    one_ = [r[0] for r in df.select(prices.ma_ratio(F.col("a"), F.col("b"), 1.0)).collect()]
    assert null == [None, 0.5, None] and one_ == [1.0, 0.5, None]


def test_text_that_is_no_number_becomes_null(spark):
    df = spark.createDataFrame([("1.5",), ("null",), ("",), ("x",), (None,)], "Close string")
    cast = training.cast_numeric(df, ["Close"])
    assert [r.Close for r in cast.collect()] == [1.5, None, None, None, None]


@pytest.mark.parametrize("n", [1, 4, 5, 9, 10, 11, 30, 200])
def test_split_date_is_the_element_at_the_floor(make_bars, n):
    bars = make_bars({"A": [float(i) for i in range(n)], "B": [1.0] * min(n, 3)})
    dates = sorted({r.Date for r in bars.collect()})
    cut = one(split.split_date(bars)).split_date
    assert cut == dates[int(len(dates) * 0.8)]
    train, test = split.split_train(bars), split.split_test(bars)
    assert train.count() + test.count() == bars.count()
    assert train.agg(F.max("Date")).first()[0] == cut
    counts = one(split.split_counts(bars))
    assert (counts.total_rows, counts.train_rows, counts.test_rows, counts.features) == (
        bars.count(), train.count(), test.count(), len(FEATURES))


def test_split_of_nothing_is_nothing(make_bars):
    empty = make_bars({"A": [1.0]}).filter("false")
    assert split.split_date(empty).count() == 0
    assert split.split_train(empty).count() == split.split_test(empty).count() == 0
    assert tuple(one(split.split_counts(empty)))[:3] == (0, 0, 0)


def test_each_pair_is_on_both_sides(make_bars):
    bars = make_bars({"A": [1.0] * 50, "B": [2.0] * 50})
    cut = F.lit(one(split.split_date(bars)).split_date)
    assert split.split_train(bars, cut).select("Pair").distinct().count() == 2
    assert split.split_test(bars, cut).select("Pair").distinct().count() == 2


def test_latest_close_follows_the_date(make_bars):
    processed = features.bar_features(make_bars({"A": [(5, 1.0), (9, 2.0), (1, 3.0)]}))
    row = one(summaries.cross_pair_latest(processed, "1h"))
    assert (row.latest_close, row.latest_date.hour) == (2.0, 9)


def test_top_volatile_orders_numbers_and_puts_null_last(make_bars):
    processed = features.bar_features(make_bars({"A": [1.0, 101.0, 1.0, 9.0], "B": [500.0, 1.0]}))
    top = summaries.top_volatile(processed, "A", "1h").collect()
    assert [r.Volatility5 for r in top[:-1]] == sorted((r.Volatility5 for r in top[:-1]), reverse=True)
    assert len(top) == 4 and top[-1].Volatility5 is None


def test_monthly_summary_takes_one_year(make_bars):
    hours = [0, 1, 24 * 40, 24 * 366, 24 * 400]
    processed = features.bar_features(make_bars({"A": [(h, 2.0) for h in hours]}, "1d"))
    got = [(r.month, r.trading_days) for r in summaries.monthly_summary(processed, "A", 2024, "1d").collect()]
    assert got == [(1, 2), (2, 1)]


def test_series_filter_reaches_the_scan(spark):
    from barlab.sources.ticks import bars

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    report = summaries.pair_summary(features.bar_features(bars(events, "1h")), "view", "1h")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EqualTo(event_type,view)") == plan.count("PushedFilters: [")
    assert "props" not in plan


def test_bars_take_first_and_last_tick(spark):
    from barlab.sources.ticks import bars

    ticks = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5, m), "A", v) for m, v in ((50, 4.0), (1, 7.0), (30, 1.0))],
        "ts timestamp_ntz, event_type string, value double",
    )
    bar = one(bars(ticks, "1h"))
    assert tuple(bar) == (datetime(2024, 1, 1, 5), "A", "1h", 7.0, 7.0, 1.0, 4.0, 3)
