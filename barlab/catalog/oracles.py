"""The SQL each named query is checked with, over the same tables."""

from __future__ import annotations

from ..operators.documents import COLLECTIONS, FORECASTS, REJECTS
from ..operators.forecast import RECURSIVE_MODEL
from ..operators.models import BOOSTED_TREES, LOGISTIC, RANDOM_FOREST
from ..schemas import FEATURES, LAG_COLUMNS, NUMERIC_PROCESSED, PROCESSED_COLUMNS
from .queries import (
    DOUBLED_DAY, EARLIER_RUNS, LOST_DAY, MOMENTUM, REPORT_PAIR, REPORT_YEAR,
)

_UNITS = {"1d": "day", "1h": "hour", "1min": "minute"}
_ROLLING = ("MA5", "MA20", "Volatility5")


def _q(name: str) -> str:
    return f'"{name}"'


def _list(names) -> str:
    return ", ".join(_q(n) for n in names)


def _bars(timeframe: str) -> str:
    return f"""
    SELECT date_trunc('{_UNITS[timeframe]}', ts)::TIMESTAMP AS "Date", event_type AS "Pair",
           '{timeframe}' AS "Timeframe",
           arg_min(value, ts) AS "Open", max(value) AS "High", min(value) AS "Low",
           arg_max(value, ts) AS "Close", count(*)::BIGINT AS "Volume"
    FROM events GROUP BY ALL"""


_RANGE = '"High" - "Low"'
_CHANGE = '"Close" - "Open"'
_PCT = '("Close" - "Open") / nullif("Open", 0) * 100'
_GAIN = 'CASE WHEN "Close" - "Open" > 0 THEN "Close" - "Open" ELSE 0::DOUBLE END'
_LOSS = 'CASE WHEN "Close" - "Open" < 0 THEN -("Close" - "Open") ELSE 0::DOUBLE END'
_SERIES = 'PARTITION BY "Pair", "Timeframe" ORDER BY "Date"'
_LAST5 = f"({_SERIES} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
_LAST20 = f"({_SERIES} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"

_PROCESSED = f"""
    SELECT "Date", "Pair", "Timeframe", "Open", "High", "Low", "Close", "Volume",
           {_RANGE} AS "Range", {_CHANGE} AS "Change", {_PCT} AS "ChangePct",
           avg("Close") OVER {_LAST5} AS "MA5",
           avg("Close") OVER {_LAST20} AS "MA20",
           stddev_samp("Close") OVER {_LAST5} AS "Volatility5",
           {_GAIN} AS "Gain", {_LOSS} AS "Loss"
    FROM bars"""

_LAGGED = f"""
    SELECT *,
           lag("Close", 1) OVER s AS "Close_lag1", lag("Close", 2) OVER s AS "Close_lag2",
           lag("Close", 3) OVER s AS "Close_lag3",
           lag("Change", 1) OVER s AS "Change_lag1", lag("Change", 2) OVER s AS "Change_lag2",
           "MA5" / nullif("MA20", 0) AS "MA5_MA20_Ratio"
    FROM processed WINDOW s AS ({_SERIES})"""

_ALL_PRESENT = " AND ".join(
    f"{_q(c)} IS NOT NULL" for c in (*PROCESSED_COLUMNS, *FEATURES[len(NUMERIC_PROCESSED):], "Close_h1")
)

_FRAME = f"""
    SELECT * REPLACE ("Volume"::DOUBLE AS "Volume") FROM (
        SELECT *, lead("Close", 1) OVER s AS "Close_h1",
               CASE WHEN lead("Close", 24) OVER s > "Close" THEN 1::DOUBLE ELSE 0::DOUBLE END
                   AS "PriceDirection"
        FROM lagged WINDOW s AS ({_SERIES}))
    WHERE {_ALL_PRESENT}"""

_CUT = """
    SELECT "Date" AS split_date FROM (
        SELECT "Date", row_number() OVER (ORDER BY "Date") - 1 AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT "Date" FROM frame))
    WHERE i = floor(n * 0.8::DOUBLE)"""

# Borders 1 to 5 of four folds; the fifth is the last date.
_BORDERS = """
    SELECT border, "Date" FROM (SELECT unnest(range(1, 6)) AS border) JOIN (
        SELECT "Date", row_number() OVER (ORDER BY "Date") AS i, count(*) OVER () AS n
        FROM (SELECT DISTINCT "Date" FROM frame)
    ) ON i = border * n // 5"""

# Averages of gain and loss, smoothed row by row.
_SMOOTH = f"""
    SELECT "Date", "Pair", "Timeframe", "Close", "Gain", "Loss", 1::BIGINT AS n,
           "Gain" AS g, "Loss" AS l FROM (
        SELECT *, row_number() OVER ({_SERIES}) AS n FROM processed) WHERE n = 1
    UNION ALL
    SELECT p."Date", p."Pair", p."Timeframe", p."Close", p."Gain", p."Loss", p.n,
           CASE WHEN p.n <= 14 THEN (s.g * (p.n - 1) + p."Gain") / p.n ELSE (s.g * 13 + p."Gain") / 14 END,
           CASE WHEN p.n <= 14 THEN (s.l * (p.n - 1) + p."Loss") / p.n ELSE (s.l * 13 + p."Loss") / 14 END
    FROM smooth s JOIN (SELECT *, row_number() OVER ({_SERIES}) AS n FROM processed) p
        ON p."Pair" = s."Pair" AND p."Timeframe" = s."Timeframe" AND p.n = s.n + 1"""

_TRAIN = 'SELECT frame.* FROM frame, cut WHERE "Date" <= split_date'
_TEST = 'SELECT frame.* FROM frame, cut WHERE "Date" > split_date'

_SCORED = f"""
    SELECT *, CASE WHEN prediction > "Close" THEN 1::DOUBLE ELSE 0::DOUBLE END AS direction,
           "Close" - "Close_lag1" AS score
    FROM (SELECT *, "Close" + {MOMENTUM}::DOUBLE * ("Close" - "Close_lag1") AS prediction FROM test)"""

_AGED = f"""
    SELECT *, row_number() OVER (PARTITION BY "Pair", "Timeframe" ORDER BY "Date" DESC) AS age
    FROM {{table}}"""

_TRIGGERS = f"""
    SELECT * EXCLUDE (age, n) REPLACE (
        CASE WHEN "MA20" = 0 THEN 1::DOUBLE ELSE "MA5" / "MA20" END AS "MA5_MA20_Ratio")
    FROM (SELECT *, count(*) OVER (PARTITION BY "Pair", "Timeframe") AS n
          FROM ({_AGED.format(table='lagged')}))
    WHERE age = 1 AND n >= 4"""


def _states(table: str, where: str = "TRUE") -> str:
    """Forecast states: features without gaps, and the two price windows."""
    values = ", ".join(f"coalesce({_q(c)}, 0)::DOUBLE AS {_q(c)}" for c in FEATURES)
    return f"""
    SELECT "Pair", "Timeframe", trigger_date, "Close" AS base_close, 0 AS hour, {_list(FEATURES)},
           ["Close_lag3", "Close_lag2", "Close_lag1", "Close"] AS short_closes,
           [x FOR x IN list_transform(range(19), lambda i: "Close")] AS long_closes,
           NULL::DOUBLE AS predicted_close, NULL::DOUBLE AS current_close,
           NULL::DOUBLE AS ma5_before, NULL::DOUBLE AS ma20_before, NULL::DOUBLE AS vol_before
    FROM (SELECT "Pair", "Timeframe", "Date" AS trigger_date, {values} FROM {table} WHERE {where})"""


def _guess(rate: float) -> str:
    return f'"Close" + {rate}::DOUBLE * ("Close" - "Close_lag1")'


def _step(source: str, guess: str = _guess(MOMENTUM), horizon: int = 24) -> str:
    """One step of every state in ``source``."""
    new = {
        "Open": '"Close"',
        "High": 'greatest("Close", p)',
        "Low": 'least("Close", p)',
        "Close": "p",
        "Volume": '"Volume"',
        "Range": 'abs(p - "Close")',
        "Change": 'p - "Close"',
        "ChangePct": 'CASE WHEN "Close" <> 0 THEN (p - "Close") / "Close" * 100 ELSE 0 END',
        "MA5": "list_avg(s)",
        "MA20": "list_avg(l)",
        "Volatility5": "list_stddev_pop(s)",
        "Gain": 'CASE WHEN p > "Close" THEN p - "Close" ELSE 0 END',
        "Loss": 'CASE WHEN p < "Close" THEN "Close" - p ELSE 0 END',
        "Close_lag1": '"Close"',
        "Close_lag2": '"Close_lag1"',
        "Close_lag3": '"Close_lag2"',
        "Change_lag1": 'p - "Close"',
        "Change_lag2": '"Change_lag1"',
        "MA5_MA20_Ratio": "CASE WHEN list_avg(l) <> 0 THEN list_avg(s) / list_avg(l) ELSE 1 END",
    }
    values = ", ".join(f"{new[c]} AS {_q(c)}" for c in FEATURES)
    return f"""
    SELECT "Pair", "Timeframe", trigger_date, base_close, hour + 1 AS hour, {values},
           s[2:] AS short_closes, l[2:] AS long_closes,
           p AS predicted_close, "Close" AS current_close,
           "MA5" AS ma5_before, "MA20" AS ma20_before, "Volatility5" AS vol_before
    FROM (SELECT *, list_append(short_closes, p) AS s, list_append(long_closes, p) AS l
          FROM (SELECT *, {guess} AS p FROM {source} WHERE hour < {horizon}))"""


_CURVES = f"""
    SELECT "Pair" AS pair, hour::BIGINT AS hour, predicted_close, trigger_date,
           '{RECURSIVE_MODEL}' AS model, base_close, current_close,
           ma5_before AS ma5, ma20_before AS ma20, vol_before AS volatility5,
           "Timeframe" AS timeframe
    FROM walk WHERE hour > 0"""

# The newest close of each hour; runs are named in the order they were published in.
_STORED = """
    SELECT "Pair", "Timeframe", hour, arg_max(predicted_close, run) AS p FROM (""" + " UNION ALL ".join(
    f'SELECT "Pair", "Timeframe", hour, predicted_close, {i} AS run FROM {run} WHERE hour > 0'
    for i, run in enumerate(EARLIER_RUNS)
) + ') GROUP BY ALL'

_RESUMED = f"""coalesce((
    SELECT s.p FROM stored s WHERE s."Pair" = continued."Pair"
        AND s."Timeframe" = continued."Timeframe" AND s.hour = continued.hour + 1
), {_guess(MOMENTUM)})"""

_NULL_TEXT = "NULL::VARCHAR"
_NULL_NUMBER = "NULL::DOUBLE"

# Every message, with the fields of all kinds side by side.
_MESSAGES = f"""
    SELECT "Pair" AS key, '{RANDOM_FOREST}' AS model, "Date", NULL::TIMESTAMP AS trigger_date,
           {_NULL_TEXT} AS "Actual", {_NULL_TEXT} AS "Signal", {_NULL_TEXT} AS "Timeframe",
           "Close", "Close_h1" AS "Actual_h1", prediction AS "RF_Predicted",
           {_NULL_NUMBER} AS "GBT_Predicted", {_NULL_NUMBER} AS predicted_close, NULL::BIGINT AS hour
    FROM scored
    UNION ALL BY NAME
    SELECT "Pair" AS key, '{BOOSTED_TREES}' AS model, "Date", "Close",
           "Close_h1" AS "Actual_h1", "Close" AS "GBT_Predicted" FROM scored
    UNION ALL BY NAME
    SELECT "Pair" AS key, '{LOGISTIC}' AS model, "Date", "Close",
           CASE WHEN "PriceDirection" = 1 THEN 'UP' ELSE 'DOWN' END AS "Actual",
           CASE WHEN direction = 1 THEN 'BUY' ELSE 'SELL' END AS "Signal" FROM scored
    UNION ALL BY NAME
    SELECT pair AS key, model, trigger_date, predicted_close, hour FROM curves
    UNION ALL BY NAME
    SELECT "Pair" AS key, "Date", "Timeframe", "Close" FROM processed"""

_COLLECTION = (
    "CASE " + " ".join(f"WHEN model = '{m}' THEN '{c}'" for m, c in COLLECTIONS.items())
    + f" WHEN model = '{RECURSIVE_MODEL}' THEN '{FORECASTS}' ELSE '{REJECTS}' END"
)

_TABLES = {
    "processed": (_PROCESSED, ()),
    "lagged": (_LAGGED, ("processed",)),
    "frame": (_FRAME, ("lagged",)),
    "cut": (_CUT, ("frame",)),
    "train": (_TRAIN, ("cut",)),
    "test": (_TEST, ("cut",)),
    "borders": (_BORDERS, ("frame",)),
    "smooth": (_SMOOTH, ("processed",)),
    "scored": (_SCORED, ("test",)),
    "triggers": (_TRIGGERS, ("lagged",)),
    "walk": (_states("triggers") + "\n    UNION ALL" + _step("walk"), ("triggers",)),
    "curves": (_CURVES, ("walk",)),
    **{
        run: (_states("triggers") + "\n    UNION ALL" + _step(run, _guess(rate), hours), ("triggers",))
        for run, (rate, hours) in EARLIER_RUNS.items()
    },
    "stored": (_STORED, tuple(EARLIER_RUNS)),
    "continued": (
        _states("triggers") + "\n    UNION ALL" + _step("continued", _RESUMED), ("triggers", "stored")
    ),
    "messages": (_MESSAGES, ("scored", "curves", "processed")),
}


def _needs(name: str, seen: list[str]) -> list[str]:
    for other in _TABLES[name][1]:
        _needs(other, seen)
    if name not in seen:
        seen.append(name)
    return seen


def _sql(select: str, *tables: str, timeframe: str = "1h") -> str:
    """``select`` with the named tables, and those they build on, in front.

    The time frame "all" puts the bars of every length into one table.
    """
    seen: list[str] = []
    for name in tables:
        _needs(name, seen)
    every = " UNION ALL ".join(f"SELECT * FROM ({_bars(t)})" for t in _UNITS)
    parts = [f"bars AS ({every if timeframe == 'all' else _bars(timeframe)})"]
    parts += [f"{name} AS ({_TABLES[name][0]})" for name in seen]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


def _r(*names: str, table: str = "") -> str:
    return ", ".join(f"round({table}{_q(n)}, 6) AS {_q(n)}" for n in names)


_PROCESSED_OUT = (
    f"SELECT {_list(c for c in PROCESSED_COLUMNS if c not in _ROLLING)}, {_r(*_ROLLING)} FROM processed"
)
_PRICE_KEY = '"Date", "Pair", "Timeframe", "Close"'
_LAG_LIST = _list(LAG_COLUMNS)
_CURVE_OUT = (
    "SELECT pair, hour, CAST(trigger_date AS VARCHAR) AS trigger_date, model, "
    + _r("predicted_close", "base_close", "current_close", "ma5", "ma20", "volatility5")
    + ", timeframe FROM curves"
)
_STAMP = 'coalesce("Date", trigger_date) AS stamp'


def _two_timeframes() -> str:
    return f"SELECT * FROM ({_bars('1h')}) UNION ALL SELECT * FROM ({_bars('1d')})"


def _state_out(source: str) -> str:
    numbers = _r("base_close", *FEATURES)
    shorts = ", ".join(f"round(short_closes[{i}], 6) AS short_{i}" for i in range(1, 5))
    longs = ", ".join(f"round(long_closes[{i}], 6) AS long_{i}" for i in (1, 18, 19))
    return f"""SELECT "Pair", trigger_date, {numbers}, {shorts}, {longs},
        len(long_closes)::BIGINT AS long_size FROM ({source})"""


_ALL_STATES = _states("lagged", '"Close_lag1" IS NOT NULL AND "Close" IS NOT NULL')

_PREDICTIONS_OUT = f"""SELECT key, model, "Date", "Close", "Actual_h1",
    {_r("RF_Predicted", "GBT_Predicted")}, "Actual", "Signal"
    FROM messages WHERE model IN ('{RANDOM_FOREST}', '{BOOSTED_TREES}', '{LOGISTIC}')"""

_RF_OUT = f"""SELECT "Date", "Pair", "Close", "Close_h1" AS "Actual_h1",
    round(prediction, 6) AS "RF_Predicted" FROM scored"""

_SIGNALS_OUT = """SELECT "Date", "Pair", "Close",
    CASE WHEN "PriceDirection" = 1 THEN 'UP' ELSE 'DOWN' END AS "Actual",
    CASE WHEN direction = 1 THEN 'BUY' ELSE 'SELL' END AS "Signal" FROM scored"""

_DOCUMENTS_OUT = f"""SELECT {_COLLECTION} AS collection, key, model, "Date", "Actual", "Signal",
    "Close", "Actual_h1", {_r("RF_Predicted")}, "GBT_Predicted",
    {_r("predicted_close")}, hour::DOUBLE AS hour, "Timeframe" FROM messages"""


def _field_typing() -> str:
    """Long form of every message field, typed by the rule for stored documents."""

    def part(source: str, head: str, numbers: dict[str, str], texts: dict[str, str]) -> str:
        rows = [
            f"""SELECT {head}, '{name}' AS field, round(({value})::DOUBLE, 6) AS number,
                CASE WHEN ({value}) IS NULL THEN '' END AS "text" FROM {source}"""
            for name, value in numbers.items()
        ] + [
            f"""SELECT {head}, '{name}' AS field, NULL::DOUBLE AS number, {value} AS "text" FROM {source}"""
            for name, value in texts.items()
        ]
        return "\nUNION ALL\n".join(rows)

    def head(key: str, model: str, stamp: str, hour: str = "NULL::BIGINT") -> str:
        return f"{key} AS key, {model} AS model, {stamp} AS stamp, {hour} AS hour"

    dated = {"Date": "NULL::VARCHAR", "Pair": '"Pair"'}
    parts = [
        part("scored", head('"Pair"', f"'{RANDOM_FOREST}'", '"Date"'),
             {"Close": '"Close"', "Actual_h1": '"Close_h1"', "RF_Predicted": "prediction"},
             {"model": f"'{RANDOM_FOREST}'", **dated}),
        part("scored", head('"Pair"', f"'{BOOSTED_TREES}'", '"Date"'),
             {"Close": '"Close"', "Actual_h1": '"Close_h1"', "GBT_Predicted": '"Close"'},
             {"model": f"'{BOOSTED_TREES}'", **dated}),
        part("scored", head('"Pair"', f"'{LOGISTIC}'", '"Date"'),
             {"Close": '"Close"'},
             {"model": f"'{LOGISTIC}'", **dated,
              "Actual": "CASE WHEN \"PriceDirection\" = 1 THEN 'UP' ELSE 'DOWN' END",
              "Signal": "CASE WHEN direction = 1 THEN 'BUY' ELSE 'SELL' END"}),
        part("curves", head("pair", "model", "trigger_date", "hour"),
             {c: c for c in ("hour", "predicted_close", "base_close", "current_close", "ma5", "ma20",
                             "volatility5")},
             {"model": "model", "pair": "pair", "trigger_date": "NULL::VARCHAR",
              "timeframe": "timeframe"}),
        part("processed", head('"Pair"', "NULL::VARCHAR", '"Date"'),
             {c: _q(c) for c in PROCESSED_COLUMNS[3:]},
             {**dated, "Timeframe": '"Timeframe"'}),
    ]
    # A forecast field that is NULL is left out of the message.
    return f"""SELECT * FROM ({" UNION ALL ".join(parts)})
        WHERE NOT coalesce(model = '{RECURSIVE_MODEL}' AND number IS NULL AND "text" = '', FALSE)"""


def oracles() -> dict[str, str]:
    timeframe_bars = {
        f"bars_{tf}": f"SELECT * FROM ({_bars(tf)})" for tf in ("1h", "1d", "1min")
    }
    return {
        **timeframe_bars,
        "scan_csv_bars": _sql('SELECT "Date", "Open", "High", "Low", "Close", "Volume" FROM bars'),
        "scan_grid_tagged": _two_timeframes(),
        "scan_skip_missing": _sql("SELECT * FROM bars"),
        "scan_permissive": _sql("""
            SELECT 'good' AS kind, count(*)::BIGINT AS rows, round(sum("Close"), 6) AS close_sum FROM bars
            UNION ALL SELECT 'reject', count(*)::BIGINT, NULL FROM events"""),
        "scan_processed": _sql(_PROCESSED_OUT, "processed"),
        "load_counts": f"""SELECT "Pair", "Timeframe", count(*)::BIGINT AS rows
            FROM ({_two_timeframes()}) GROUP BY ALL""",
        "scan_fallback": _sql(_RF_OUT, "scored"),
        "sink_csv_roundtrip": _sql(_PROCESSED_OUT, "processed"),
        "sink_predictions": _sql(_RF_OUT, "scored"),
        "sink_signals": _sql(_SIGNALS_OUT, "scored"),
        "publish_predictions_json": _sql(_PREDICTIONS_OUT, "messages"),
        "bridge_csv_json": _sql(_PREDICTIONS_OUT, "messages"),
        "replay_messages": _sql(
            f"""SELECT "Pair" AS key, "Date" AS "timestamp", "Timeframe",
            "Open", "High", "Low", "Close", "Volume"::DOUBLE AS "Volume", "Range", "Change", "ChangePct",
            {_r(*_ROLLING)}, "Gain", "Loss" FROM processed""", "processed"),
        "forecast_messages": _sql(_CURVE_OUT, "curves"),
        "sink_route_by_model": _sql(_DOCUMENTS_OUT, "messages"),
        "sink_field_typing": _sql(_field_typing(), "messages"),
        "sink_verify_counts": _sql(
            f"""SELECT collection, count(*)::BIGINT AS documents,
                first(key ORDER BY stamp, key) AS sample_key, min(stamp) AS sample_date
            FROM (SELECT {_COLLECTION} AS collection, key, {_STAMP} FROM messages) GROUP BY collection""",
            "messages"),
        "sink_missing_rows": _sql(
            f"""SELECT key, model, {_STAMP}, hour FROM messages
            WHERE model = '{RECURSIVE_MODEL}' OR model IS NULL
                OR (model = '{RANDOM_FOREST}' AND day("Date") = {LOST_DAY})""", "messages"),
        "publish_counts": _sql(
            "SELECT model, count(*)::BIGINT AS messages FROM messages GROUP BY model", "messages"),
        "sink_summary": _sql(
            f"""SELECT collection, count(*)::BIGINT AS published,
                (count(*) - count(*) FILTER (lost))::BIGINT AS stored,
                (count(*) FILTER (lost))::BIGINT AS missing,
                (count(*) FILTER (model = '{LOGISTIC}' AND day(stamp) = {DOUBLED_DAY}))::BIGINT AS repeated
            FROM (SELECT {_COLLECTION} AS collection, model, {_STAMP},
                    coalesce(model = '{RANDOM_FOREST}' AND day("Date") = {LOST_DAY}, FALSE) AS lost
                FROM messages) GROUP BY collection""", "messages"),
        "store_retrieve_reconcile": _sql(
            f"""SELECT "Pair" AS pair, "Timeframe" AS timeframe,
                CAST(trigger_date AS VARCHAR) AS trigger_date, hour::BIGINT AS hour,
                round(predicted_close, 6) AS "close", round(ma5_before, 6) AS ma5,
                round(ma20_before, 6) AS ma20, round(vol_before, 6) AS volatility5,
                CASE WHEN hour <= {max(h for _, h in EARLIER_RUNS.values())}
                    THEN 'stored' ELSE 'computed' END AS source
            FROM continued WHERE hour > 0""", "continued", timeframe="all"),
        "price_features": _sql(
            f'SELECT *, {_RANGE} AS "Range", {_CHANGE} AS "Change", {_PCT} AS "ChangePct" FROM bars'),
        "gain_loss": _sql(f'SELECT "Date", "Pair", {_GAIN} AS "Gain", {_LOSS} AS "Loss" FROM bars'),
        "rolling_ma": _sql(
            f"SELECT {_PRICE_KEY}, {_r('MA5', 'MA20')} FROM processed", "processed", timeframe="1min"),
        "rolling_volatility": _sql(
            f"SELECT {_PRICE_KEY}, {_r('Volatility5')} FROM processed", "processed", timeframe="1min"),
        "warmup_filter": _sql(
            f"""SELECT {_PRICE_KEY}, {_r('MA20')} FROM (
                SELECT *, count(*) OVER {_LAST20} AS n FROM processed) WHERE n = 20""", "processed"),
        "bar_features": _sql(_PROCESSED_OUT, "processed"),
        "cast_numeric": _sql('SELECT * REPLACE ("Volume"::DOUBLE AS "Volume") FROM bars'),
        "ma_ratio": _sql(f"SELECT {_PRICE_KEY}, {_r('MA5_MA20_Ratio')} FROM lagged", "lagged"),
        "lag_features": _sql(f"SELECT {_PRICE_KEY}, {_LAG_LIST} FROM lagged", "lagged"),
        "target_h1": _sql(
            f'SELECT {_PRICE_KEY}, lead("Close", 1) OVER ({_SERIES}) AS "Close_h1" FROM bars',
            timeframe="1min"),
        "target_direction": _sql(
            f"""SELECT {_PRICE_KEY}, CASE WHEN lead("Close", 24) OVER ({_SERIES}) > "Close"
                THEN 1::DOUBLE ELSE 0::DOUBLE END AS "PriceDirection" FROM bars""",
            timeframe="1min"),
        "training_frame": _sql(
            f"""SELECT * REPLACE ({_r(*_ROLLING, 'MA5_MA20_Ratio')}) FROM frame""", "frame"),
        "distinct_dates": _sql('SELECT DISTINCT "Date" FROM frame', "frame"),
        "split_date": _sql("SELECT split_date FROM cut", "cut"),
        "split_train": _sql(f'SELECT {_PRICE_KEY}, "Close_h1" FROM train', "train"),
        "split_test": _sql(f'SELECT {_PRICE_KEY}, "Close_h1" FROM test', "test"),
        "split_counts": _sql(
            f"""SELECT count(*)::BIGINT AS total_rows,
                count(*) FILTER ("Date" <= split_date)::BIGINT AS train_rows,
                count(*) FILTER ("Date" > split_date)::BIGINT AS test_rows,
                {len(FEATURES)}::BIGINT AS features FROM frame, cut""", "cut"),
        "series_tail": _sql(
            f"SELECT {_PRICE_KEY} FROM ({_AGED.format(table='bars')}) WHERE age <= 4"),
        "trigger_rows": _sql(
            f"SELECT * REPLACE ({_r(*_ROLLING, 'MA5_MA20_Ratio')}) FROM triggers", "triggers"),
        "rsi14": _sql(
            f"""SELECT {_PRICE_KEY}, CASE WHEN n >= 14 AND g + l > 0 THEN round(100 * g / (g + l), 6) END
                AS rsi14 FROM smooth""", "smooth"),
        "time_folds": _sql(
            """SELECT x.border::INT AS fold, x."Date" AS train_until, y."Date" AS valid_until,
                (SELECT count(*) FROM frame WHERE "Date" <= x."Date")::BIGINT AS train_rows,
                (SELECT count(*) FROM frame
                 WHERE "Date" > x."Date" AND "Date" <= y."Date")::BIGINT AS valid_rows
            FROM borders x JOIN borders y ON y.border = x.border + 1""", "borders"),
        "pair_regression": _sql(
            """SELECT "Pair", count(*)::BIGINT AS n, round(regr_slope("Close_h1", "Close"), 6) AS slope,
                round(regr_intercept("Close_h1", "Close"), 6) AS intercept,
                round(regr_r2("Close_h1", "Close"), 6) AS r2
            FROM frame GROUP BY "Pair\"""", "frame"),
        "scored_rows": _sql(
            f"""SELECT model, "Pair", count(*)::BIGINT AS rows, 0::BIGINT AS outside,
                round(sum("Close_h1"), 6) AS actual_sum
            FROM test, (SELECT unnest(['{RANDOM_FOREST}', '{BOOSTED_TREES}', '{LOGISTIC}']) AS model)
            GROUP BY ALL""", "test"),
        "importance_sum": f"""SELECT {len(FEATURES)}::BIGINT AS features, 1::DOUBLE AS total,
            0::BIGINT AS negative""",
        "comparison_check": f"""SELECT model, metric, TRUE AS "equal"
            FROM (SELECT unnest(['{RANDOM_FOREST}', '{BOOSTED_TREES}']) AS model),
                (SELECT unnest(['rmse', 'mae', 'r2']) AS metric)""",
        "topic_positions": _sql(
            f"""SELECT n AS messages, n AS positions, n AS numbered FROM (
                SELECT (SELECT count(*) FROM processed)
                    + (SELECT count(*) FROM ({_bars('1d')})) AS n)""", "processed"),
        "stream_two_queries": _sql(
            'SELECT "Pair" AS pair, 24::BIGINT AS forecasts, 1::BIGINT AS triggers FROM triggers',
            "triggers"),
        "series_stats": _sql(
            """SELECT "Pair", "Timeframe", count(*)::BIGINT AS records, min("Date") AS "start",
                max("Date") AS "end", round(avg("Close"), 6) AS avg_close, min("Close") AS min_close,
                max("Close") AS max_close, round(avg("ChangePct"), 6) AS avg_change,
                round(avg("Volume"), 6) AS avg_volume, round(avg("Volatility5"), 6) AS avg_volatility
            FROM processed GROUP BY ALL""", "processed"),
        "pair_summary": _sql(
            f"""SELECT count(*)::BIGINT AS records, min("Close") AS min_close, max("Close") AS max_close,
                round(avg("Close"), 6) AS avg_close, round(avg("ChangePct"), 6) AS avg_change_pct,
                round(avg("Volatility5"), 6) AS avg_volatility
            FROM processed WHERE "Pair" = '{REPORT_PAIR}'""", "processed", timeframe="1d"),
        "top_volatile": _sql(
            f"""SELECT "Date", "Close", "ChangePct", {_r('Volatility5')} FROM (
                SELECT * FROM processed WHERE "Pair" = '{REPORT_PAIR}'
                ORDER BY "Volatility5" DESC NULLS LAST, "Date" LIMIT 10)""", "processed", timeframe="1d"),
        "monthly_summary": _sql(
            f"""SELECT month("Date")::BIGINT AS "month", round(avg("Close"), 6) AS avg_close,
                round(avg("ChangePct"), 6) AS avg_change, count(*)::BIGINT AS trading_days
            FROM processed WHERE "Pair" = '{REPORT_PAIR}' AND year("Date") = {REPORT_YEAR}
            GROUP BY 1""", "processed", timeframe="1d"),
        "union_pairs": _two_timeframes(),
        "cross_pair_latest": _sql(
            """SELECT "Pair", max("Date") AS latest_date, arg_max("Close", "Date") AS latest_close,
                round(avg("Close"), 6) AS avg_close, round(avg("Volatility5"), 6) AS avg_volatility
            FROM processed GROUP BY "Pair\"""", "processed", timeframe="1d"),
        "json_extract": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "signal_recode": _sql(_SIGNALS_OUT, "scored"),
        "latest_signals": _sql(
            f'SELECT * FROM ({_SIGNALS_OUT}) ORDER BY "Date" DESC, "Pair" LIMIT 10', "scored"),
        "confusion_matrix": _sql(
            """SELECT "PriceDirection" AS "label", direction AS prediction, count(*)::BIGINT AS "count"
            FROM scored GROUP BY ALL""", "scored"),
        "classification_metrics": _sql(
            """SELECT round(sum(hit) / sum(actual), 6) AS accuracy,
                round(sum(actual * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END)
                    / sum(actual), 6) AS f1,
                round(sum(actual * p) / sum(actual), 6) AS weighted_precision,
                round(sum(actual * r) / sum(actual), 6) AS weighted_recall
            FROM (SELECT *, CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS p, hit / actual AS r
                FROM (SELECT c,
                    count(*) FILTER ("PriceDirection" = c)::DOUBLE AS actual,
                    count(*) FILTER (direction = c)::DOUBLE AS guessed,
                    count(*) FILTER ("PriceDirection" = c AND direction = c)::DOUBLE AS hit
                    FROM scored, (VALUES (0), (1)) AS classes(c) GROUP BY c))""", "scored"),
        "regression_metrics": _sql(
            """SELECT s."Pair", round(sqrt(avg(power("Close_h1" - prediction, 2))), 6) AS rmse,
                round(avg(abs("Close_h1" - prediction)), 6) AS mae,
                round(1 - sum(power("Close_h1" - prediction, 2)) / sum(power("Close_h1" - m, 2)), 6) AS r2
            FROM scored s JOIN (SELECT "Pair", avg("Close_h1") AS m FROM scored GROUP BY "Pair") USING ("Pair")
            GROUP BY s."Pair\"""", "scored"),
        "auc_roc": _sql(
            """SELECT round((sum(rank) FILTER ("PriceDirection" = 1)
                    - p * (p + 1) / 2) / (p * n), 6) AS auc
            FROM (SELECT "PriceDirection",
                    rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rank,
                    (count(*) FILTER ("PriceDirection" = 1) OVER ())::DOUBLE AS p,
                    (count(*) FILTER ("PriceDirection" = 0) OVER ())::DOUBLE AS n
                FROM scored) GROUP BY p, n""", "scored"),
        "best_model": _sql(
            f"""SELECT model, 'r2' AS metric, round(r2, 6) AS "value" FROM (
                SELECT '{RANDOM_FOREST}' AS model, 0 AS place,
                    1 - avg(power("Close_h1" - prediction, 2)) / var_pop("Close_h1") AS r2 FROM scored
                UNION ALL
                SELECT '{BOOSTED_TREES}', 1,
                    1 - avg(power("Close_h1" - "Close", 2)) / var_pop("Close_h1") FROM scored)
            ORDER BY r2 DESC, place LIMIT 1""", "scored"),
        "assemble_skip": _sql(
            f"""SELECT "Date", "Pair", "Close", "Volume" FROM lagged
            WHERE {" AND ".join(f"{_q(c)} IS NOT NULL" for c in FEATURES)}""", "lagged"),
        "standardize": _sql(
            "SELECT \"Date\", \"Pair\", " + ", ".join(
                f'round((test.{_q(c)} - m.{_q(c)}) / m."sd_{c}", 6) AS "z_{c}"' for c in FEATURES)
            + " FROM test, (SELECT " + ", ".join(
                f'avg({_q(c)}) AS {_q(c)}, stddev_samp({_q(c)}) AS "sd_{c}"' for c in FEATURES)
            + " FROM train) AS m", "train", "test"),
        "model_roundtrip": _sql(
            """SELECT "Pair", count(*)::BIGINT AS rows, 0::BIGINT AS differing
            FROM test GROUP BY "Pair\"""", "test"),
        "forecast_init": _sql(_state_out(_ALL_STATES), "lagged"),
        "forecast_step": _sql(_state_out(_step(f"({_ALL_STATES})")), "lagged"),
        "forecast_24h": _sql(_CURVE_OUT, "curves"),
        "forecast_summary": _sql(
            """SELECT pair, timeframe, hour, round(predicted_close, 6) AS predicted_close,
                round(base_close, 6) AS base_close, round(move, 6) AS change, round(pct, 6) AS change_pct,
                CASE WHEN move >= 0 THEN '+' ELSE '' END || printf('%.4f%%', pct) AS change_text
            FROM (SELECT *, predicted_close - base_close AS move,
                (predicted_close - base_close) / nullif(base_close, 0) * 100 AS pct FROM curves)""",
            "curves", timeframe="all"),
        "forecast_total": _sql(
            f"""SELECT pair, timeframe, CAST(trigger_date AS VARCHAR) AS trigger_date,
                round(base_close, 6) AS base_close, round(predicted_close, 6) AS final_close,
                round(predicted_close - base_close, 6) AS total_change,
                round((predicted_close - base_close) / nullif(base_close, 0) * 100, 6) AS total_pct
            FROM curves WHERE hour = 24""", "curves", timeframe="all"),
        "forecast_stats": _sql(
            """SELECT pair, timeframe, CAST(trigger_date AS VARCHAR) AS trigger_date,
                round(base_close, 6) AS "current", round(predicted_close, 6) AS predicted,
                round(ma5, 6) AS ma5, round(volatility5, 6) AS volatility5, round(pct, 6) AS change_pct,
                CASE WHEN pct >= 0 THEN 'UP' ELSE 'DOWN' END AS direction
            FROM (SELECT *, (predicted_close - base_close) / nullif(base_close, 0) * 100 AS pct
                FROM curves WHERE hour = 24)""", "curves", timeframe="all"),
        "forecast_curve": _sql(
            f"""SELECT "Pair" AS pair, "Timeframe" AS timeframe, -age::BIGINT AS "position", 'h-' || age AS "label",
                round("Close", 6) AS historical, NULL::DOUBLE AS forecast
            FROM ({_AGED.format(table='processed')}) WHERE age <= 24
            UNION ALL
            SELECT pair, timeframe, hour, 'h+' || hour, NULL, round(predicted_close, 6)
            FROM curves""", "curves", timeframe="all"),
        "stream_trigger_parse": _sql(
            f"""SELECT "Date" AS kafka_timestamp, CAST("Date" AS VARCHAR) AS "Date", "Pair", "Timeframe",
                "Open", "High", "Low", "Close", "Volume"::DOUBLE AS "Volume", "Range", "Change",
                "ChangePct", {_r(*_ROLLING)}, "Gain", "Loss", {_LAG_LIST}, {_r('MA5_MA20_Ratio')}
            FROM lagged WHERE "Close" IS NOT NULL AND "Close_lag1" IS NOT NULL""", "lagged"),
        "stream_drain": _sql('SELECT "Pair" AS key, "Date" AS "timestamp", "Close" FROM bars'),
        "stream_monitor": _sql(
            "SELECT pair, hour, round(predicted_close, 6) AS predicted_close FROM curves", "curves"),
        "forecast_24h_model": _sql(_CURVE_OUT, "curves", timeframe="all"),
        "stream_forecast": _sql(_CURVE_OUT, "curves"),
        "stream_forecast_model": _sql(_CURVE_OUT, "curves", timeframe="all"),
        "stream_restart": _sql(_DOCUMENTS_OUT, "messages"),
        "stream_sink_route": _sql(_DOCUMENTS_OUT, "messages"),
    }
