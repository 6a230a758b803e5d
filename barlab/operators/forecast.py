"""Trigger rows and the recursive multi-step forecast.

The state of one forecast is a struct: the features the model sees, the last 4
and 19 closes, and the steps taken so far. A step maps (state, prediction) to
the next state with column expressions only, so every trigger is carried
forward independently: no shuffle, no driver state, all triggers at once.

With a predictor that is a column expression the whole recursion is one fold
inside a single projection. With a saved model each step is a ``transform`` of
the state table, and the growing plan is cut by writing that table every few
steps; the steps are taken out of the state there, so it does not grow.

A forecast that was stored in part is continued (``resume``): the stored closes
are folded into the state first, and only the hours after them are predicted.

A forecast belongs to a series, (Pair, Timeframe), and a trigger date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import prices
from ..schemas import FEATURES, HORIZON, NUMERIC_PROCESSED, SERIES, TIME
from ..session import written
from .series import last_rows

MA_SHORT = 5
MA_LONG = 20
LAG_ROWS = 4

# Fixed value: how recursive forecasts name their model.
RECURSIVE_MODEL = "RF_h1_recursive"

_EMPTY_STEPS = (
    "cast(array() as array<struct<hour:int,predicted_close:double,current_close:double,"
    "ma5:double,ma20:double,volatility5:double>>)"
)

Predictor = Callable[[Column], Column]


def trigger_rows(processed: DataFrame, history: int = 0) -> DataFrame:
    """The newest row of every series with the lags of the rows before it.

    Series with fewer than four rows give no trigger. ``history`` adds the array
    ``recent_closes`` with that many closes, oldest first.
    """
    tail = last_rows(processed, max(LAG_ROWS, history))
    order = Window.partitionBy(*SERIES).orderBy(TIME)
    lagged = tail.withColumns({
        **{f"Close_lag{k}": F.lag("Close", k).over(order) for k in (1, 2, 3)},
        **{f"Change_lag{k}": F.lag("Change", k).over(order) for k in (1, 2)},
        "MA5_MA20_Ratio": prices.ma_ratio(F.col("MA5"), F.col("MA20"), if_zero=1.0),
        "_rows": F.count("*").over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    columns = [*processed.columns, *FEATURES[len(NUMERIC_PROCESSED):]]
    if history:
        # At most ``history`` rows per series are left at this point.
        closes = F.collect_list("Close").over(order.rowsBetween(1 - history, 0))
        lagged = lagged.withColumn("recent_closes", closes)
        columns.append("recent_closes")
    return lagged.filter((F.col("_age") == 1) & (F.col("_rows") >= LAG_ROWS)).select(*columns)


def _number(name: str, missing: str) -> Column:
    value = F.col(name).cast("double")
    return F.coalesce(value, F.lit(0.0)) if missing == "zero" else value


def forecast_init(triggers: DataFrame, missing: str = "zero", seed: str = "flat") -> DataFrame:
    """(Pair, Timeframe, trigger_date, base_close, state) for every trigger.

    A missing feature counts as 0.0; ``missing="reject"`` leaves such triggers
    out (``incomplete_triggers`` lists them). ``seed="flat"`` fills the long
    price window with copies of the close, ``seed="history"`` with
    ``recent_closes``.
    """
    if missing == "reject":
        triggers = triggers.filter(complete())
    values = {name: _number(name, missing) for name in FEATURES}
    close = values["Close"]
    flat = F.array_repeat(close, MA_LONG - 1)
    if seed == "history":
        known = F.slice(F.reverse("recent_closes"), 1, MA_LONG - 1)
        pad = F.array_repeat(F.element_at(known, -1), MA_LONG - 1 - F.size(known))
        long_closes = F.reverse(F.concat(known, pad))
    else:
        long_closes = flat
    state = F.struct(
        *[value.alias(name) for name, value in values.items()],
        F.array(
            values["Close_lag3"], values["Close_lag2"], values["Close_lag1"], close
        ).alias("short_closes"),
        long_closes.alias("long_closes"),
        F.lit(0).alias("hour"),
        F.expr(_EMPTY_STEPS).alias("steps"),
    )
    return triggers.select(
        *SERIES, F.col(TIME).cast("string").alias("trigger_date"),
        close.alias("base_close"), state.alias("state"),
    )


def complete() -> Column:
    """Whether a trigger has every feature."""
    present = F.lit(True)
    for name in FEATURES:
        present = present & F.col(name).isNotNull()
    return present


def incomplete_triggers(triggers: DataFrame) -> DataFrame:
    return triggers.filter(~complete())


def _mean(values: Column, size: int) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x) / size


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def next_state(state: Column, predicted: Column, shift_change_lag: bool = False) -> Column:
    """The state after the predicted close has become the current one.

    The first change lag is the new change itself; ``shift_change_lag`` uses the
    previous change, as the training lags do.
    """
    old = state["Close"]
    move = predicted - old
    short = F.concat(state["short_closes"], F.array(predicted))
    long = F.concat(state["long_closes"], F.array(predicted))
    step = F.struct(
        (state["hour"] + 1).alias("hour"),
        predicted.alias("predicted_close"),
        old.alias("current_close"),
        state["MA5"].alias("ma5"),
        state["MA20"].alias("ma20"),
        state["Volatility5"].alias("volatility5"),
    )

    def evolve(t: Column) -> Column:
        spread = F.aggregate(
            short, F.lit(0.0), lambda total, x: total + (x - t["ma5"]) * (x - t["ma5"])
        )
        new = {
            "Open": old,
            "High": F.greatest(old, predicted),
            "Low": F.least(old, predicted),
            "Close": predicted,
            "Volume": state["Volume"],
            "Range": F.abs(move),
            "Change": move,
            "ChangePct": F.coalesce(F.try_divide(move, old), F.lit(0.0)) * 100,
            "MA5": t["ma5"],
            "MA20": t["ma20"],
            "Volatility5": F.sqrt(spread / MA_SHORT),
            "Gain": prices.gain(move),
            "Loss": prices.loss(move),
            "Close_lag1": old,
            "Close_lag2": state["Close_lag1"],
            "Close_lag3": state["Close_lag2"],
            "Change_lag1": state["Change"] if shift_change_lag else move,
            "Change_lag2": state["Change_lag1"],
            "MA5_MA20_Ratio": prices.ma_ratio(t["ma5"], t["ma20"], if_zero=1.0),
        }
        return F.struct(
            *[new[name].alias(name) for name in FEATURES],
            F.slice(short, 2, MA_SHORT - 1).alias("short_closes"),
            F.slice(long, 2, MA_LONG - 1).alias("long_closes"),
            (state["hour"] + 1).alias("hour"),
            F.concat(state["steps"], F.array(step)).alias("steps"),
        )

    averages = F.struct(_mean(short, MA_SHORT).alias("ma5"), _mean(long, MA_LONG).alias("ma20"))
    return _let(averages, evolve)


def _step(state: Column, predict: Predictor, shift_change_lag: bool) -> Column:
    return _let(predict(state), lambda p: next_state(state, p, shift_change_lag))


def forecast_step(states: DataFrame, predict: Predictor, shift_change_lag: bool = False) -> DataFrame:
    """One step of every forecast, with a predictor given as a column expression."""
    return states.withColumn("state", _step(F.col("state"), predict, shift_change_lag))


def stored_closes(stored: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """(pair, timeframe, trigger_date, closes): what is stored of each forecast.

    ``stored`` holds parsed forecast messages with their ``position``. Of several
    closes of an hour the newest by position counts. ``closes`` ends before the
    first hour that is missing, as later ones rest on it.
    """
    keys = ("pair", "timeframe", "trigger_date")
    newest = (
        stored.filter(F.col("hour").between(1, horizon) & F.col("predicted_close").isNotNull())
        .groupBy(*keys, "hour").agg(F.max_by("predicted_close", "position").alias("close"))
    )
    # At most ``horizon`` hours a forecast are left.
    steps = F.array_sort(F.collect_list(F.struct("hour", "close")))
    unbroken = F.filter(steps, lambda step, i: step["hour"] == i + 1)
    return newest.groupBy(*keys).agg(F.transform(unbroken, lambda step: step["close"]).alias("closes"))


def resume(
    states: DataFrame, stored: DataFrame, horizon: int = HORIZON, shift_change_lag: bool = False
) -> DataFrame:
    """States moved on through the closes that are stored of them; others stay."""
    known = stored_closes(stored, horizon).alias("k")
    same = (
        (F.col("s.Pair") == F.col("k.pair")) & (F.col("s.trigger_date") == F.col("k.trigger_date"))
        & F.col("s.Timeframe").eqNullSafe(F.col("k.timeframe"))
    )
    moved = F.aggregate(
        F.coalesce("closes", F.expr("cast(array() as array<double>)")), F.col("state"),
        lambda state, close: next_state(state, close, shift_change_lag),
    )
    kept = [moved.alias(c) if c == "state" else F.col(f"s.{c}").alias(c) for c in states.columns]
    return states.alias("s").join(known, same, "left").select(*kept)


def run_formula(
    states: DataFrame, predict: Predictor, horizon: int = HORIZON, shift_change_lag: bool = False
) -> DataFrame:
    """All steps that are left as one fold over the hours."""
    hours = F.filter(
        F.sequence(F.lit(1), F.lit(horizon)), lambda hour: hour > F.col("state")["hour"]
    )
    fold = F.aggregate(
        hours, F.col("state"), lambda state, _: _step(state, predict, shift_change_lag)
    )
    return states.withColumn("state", fold)


def run_model(
    states: DataFrame,
    model: Transformer,
    horizon: int = HORIZON,
    shift_change_lag: bool = False,
    write_every: int = 2,
    model_name: str = RECURSIVE_MODEL,
    resumed: bool = False,
) -> DataFrame:
    """The rows of all steps with a saved model, scoring every trigger at once in each step.

    Every ``write_every`` steps the table of states is written; the rows of the
    steps since then are read from there, and the state goes on without them.
    ``resumed`` states have steps already, and may need fewer.
    """
    columns = states.columns
    features = [F.col("state")[name].alias(name) for name in FEATURES]
    advanced = _let(
        F.struct("state", "prediction"),
        lambda both: next_state(both["state"], both["prediction"], shift_change_lag),
    )
    kept = [advanced.alias(c) if c == "state" else F.col(c) for c in columns]
    done: list[DataFrame] = []

    def put_down(states: DataFrame) -> DataFrame:
        held = written(states, "forecast-steps") if write_every else states
        # A resumed state may have passed the horizon since it was last written.
        done.append(forecast_rows(held, model_name).filter(F.col("hour") <= horizon))
        emptied = F.col("state").withField("steps", F.expr(_EMPTY_STEPS))
        return held.withColumn("state", emptied).filter(F.col("state.hour") < horizon)

    if resumed:
        states = put_down(states)
    taken = 0
    while taken < horizon and not (resumed and states.isEmpty()):
        for _ in range(min(write_every or horizon, horizon - taken)):
            states = model.transform(states.select(*columns, *features)).select(*kept)
            taken += 1
        states = put_down(states)
    rows = done[0]
    for some in done[1:]:
        rows = rows.union(some)
    return rows


def forecast_rows(states: DataFrame, model: str = RECURSIVE_MODEL) -> DataFrame:
    """One row per trigger and hour, carrying the features from before the step."""
    return states.select(
        *SERIES, "trigger_date", "base_close", F.explode("state.steps").alias("step")
    ).select(
        F.col("Pair").alias("pair"), "step.hour", "step.predicted_close", "trigger_date",
        F.lit(model).alias("model"), "base_close", "step.current_close",
        "step.ma5", "step.ma20", "step.volatility5", F.col("Timeframe").alias("timeframe"),
    )


def forecast(
    triggers: DataFrame,
    predict: Predictor | Transformer,
    horizon: int = HORIZON,
    model_name: str = RECURSIVE_MODEL,
    missing: str = "zero",
    seed: str = "flat",
    shift_change_lag: bool = False,
    write_every: int = 2,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Triggers to forecast rows, with an MLlib model or a column formula.

    With ``stored``, parsed forecast messages and their positions, each forecast
    goes on after the last hour that is stored of it, from the stored closes.
    """
    states = forecast_init(triggers, missing=missing, seed=seed)
    if stored is not None:
        states = resume(states, stored, horizon, shift_change_lag)
    if isinstance(predict, Transformer):
        return run_model(
            states, predict, horizon, shift_change_lag, write_every, model_name, stored is not None
        )
    return forecast_rows(run_formula(states, predict, horizon, shift_change_lag), model_name)


def forecast_summary(forecasts: DataFrame) -> DataFrame:
    """Distance from the base close per hour, in price, percent and as text."""
    move = F.col("predicted_close") - F.col("base_close")
    pct = prices.percent_of(move, F.col("base_close"))
    return forecasts.select(
        "pair", "timeframe", "hour", "predicted_close", "base_close",
        move.alias("change"), pct.alias("change_pct"),
        prices.signed_percent_text(move, pct).alias("change_text"),
    )


def forecast_total(forecasts: DataFrame) -> DataFrame:
    """Base, final close and total change of every forecast."""
    final = forecasts.groupBy("pair", "timeframe", "trigger_date", "base_close").agg(
        F.max_by("predicted_close", "hour").alias("final_close")
    )
    move = F.col("final_close") - F.col("base_close")
    return final.withColumns({
        "total_change": move, "total_pct": prices.percent_of(move, F.col("base_close")),
    })


def forecast_stats(forecasts: DataFrame) -> DataFrame:
    """The six figures shown with a curve, as of its last hour."""
    last = forecasts.groupBy("pair", "timeframe", "trigger_date").agg(
        F.max_by("base_close", "hour").alias("current"),
        F.max_by("predicted_close", "hour").alias("predicted"),
        F.max_by("ma5", "hour").alias("ma5"),
        F.max_by("volatility5", "hour").alias("volatility5"),
    )
    pct = prices.percent_of(F.col("predicted") - F.col("current"), F.col("current"))
    return last.withColumns({
        "change_pct": pct,
        "direction": F.when(pct >= 0, F.lit("UP")).otherwise(F.lit("DOWN")),
    })


def forecast_curve(processed: DataFrame, forecasts: DataFrame, points: int = HORIZON) -> DataFrame:
    """The last ``points`` bars followed by the forecast, labelled h-k and h+k."""
    past = last_rows(processed, points).select(
        F.col("Pair").alias("pair"), F.col("Timeframe").alias("timeframe"),
        (-F.col("_age")).cast("int").alias("position"),
        F.concat(F.lit("h-"), F.col("_age")).alias("label"),
        F.col("Close").alias("historical"),
        F.lit(None).cast("double").alias("forecast"),
    )
    ahead = forecasts.select(
        "pair", "timeframe",
        F.col("hour").cast("int").alias("position"),
        F.concat(F.lit("h+"), F.col("hour")).alias("label"),
        F.lit(None).cast("double").alias("historical"),
        F.col("predicted_close").alias("forecast"),
    )
    return past.unionByName(ahead)
