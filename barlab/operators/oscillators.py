"""Linear recurrences along a series, and the indicators that are ones.

``y[i] = a[i] * y[i-1] + b[i]`` is a composition of maps ``y -> a y + b``, which is
associative; several values with the same ``a`` are taken along together. So a series is cut into blocks of a bounded number of rows, each
block is folded on its own, the blocks of a chunk are folded, then the chunks of
a series, and each row gets the value its block starts from. No task holds more
than a block of rows, a chunk's blocks, or a series' chunks, whose number depends
on the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SERIES
from ..session import written
from .series import _chunk, over_series, plain_window, with_ties

BLOCK_ROWS = 256
RSI_ROWS = 14

Maps = list[str]  # the names of the values; a map is a struct of ``a`` and one number for each


def _identity(names: Maps) -> Column:
    return F.struct(F.lit(1.0).alias("a"), *(F.lit(0.0).alias(n) for n in names))


def _then(first: Column, second: Column, names: Maps) -> Column:
    """The map that applies ``first``, then ``second``."""
    return F.struct(
        (second["a"] * first["a"]).alias("a"),
        *((second["a"] * first[n] + second[n]).alias(n) for n in names),
    )


def _running(steps: Column, names: Maps) -> Column:
    """The compositions of an array's maps up to each of them."""
    fields = ",".join(f"{n}:double" for n in ("a", *names))
    none = F.expr(f"cast(array() as array<struct<{fields}>>)")
    return F.aggregate(steps, none, lambda done, step: F.concat(done, F.array(_then(
        F.coalesce(F.try_element_at(done, F.lit(-1)), _identity(names)), step, names
    ))))


def _earlier(rows: DataFrame, inner: str, outer: list[str], names: Maps) -> DataFrame:
    """(outer, inner, before, all): compositions of the maps before each, and of all, of one ``outer``."""
    gathered = rows.groupBy(*outer).agg(
        F.array_sort(F.collect_list(F.struct(inner, "whole"))).alias("parts")
    ).withColumn("run", _running(F.transform("parts", lambda p: p["whole"]), names))
    placed = gathered.select(
        *outer, F.element_at("run", -1).alias("all"), "run", F.posexplode("parts").alias("i", "part")
    )
    before = F.when(F.col("i") == 0, _identity(names)).otherwise(F.get("run", F.col("i") - 1))
    return placed.select(*outer, F.col(f"part.{inner}").alias(inner), before.alias("before"), "all")


def _same(left: str, right: str, on: list[str]) -> Column:
    met = F.lit(True)
    for c in on:
        met = met & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return met


def recurrence(
    df: DataFrame, a: Column, values: Mapping[str, Column], start: float = 0.0,
    chunk_days: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``y[i] = a[i] * y[i-1] + b[i]`` along each series, from ``y = start``.

    ``values`` names each ``y`` and gives its ``b``; they and ``a`` must not be
    null. ``chunk_days`` is as in ``over_series``. The blocks are written once.
    """
    columns, names = df.columns, [f"b{i}" for i in range(len(values))]
    step = F.struct(
        a.cast("double").alias("a"), *(b.cast("double").alias(n) for n, b in zip(names, values.values()))
    )
    in_chunk, in_series = [*SERIES, "_chunk", "_block"], [*SERIES, "_chunk"]
    placed = with_ties(df).withColumns({"_chunk": _chunk(chunk_days), "_step": step}).withColumn(
        "_place", F.row_number().over(plain_window("_chunk")) - 1
    ).withColumn("_block", F.floor(F.col("_place") / block_rows).cast("int"))
    # At most ``block_rows`` rows each.
    rows = F.array_sort(
        F.collect_list(F.struct("_place", "_step", F.struct(*columns).alias("_row"))),
        lambda x, y: x["_place"] - y["_place"],
    )
    blocks = placed.groupBy(*in_chunk).agg(rows.alias("rows")).withColumn(
        "run", _running(F.transform("rows", lambda r: r["_step"]), names)
    )
    blocks = written(blocks.withColumn("whole", F.element_at("run", -1)), "recurrence-blocks")
    by_block = written(
        _earlier(blocks.select(*in_chunk, "whole"), "_block", in_series, names), "recurrence-chunks"
    )
    chunks = by_block.groupBy(*in_series).agg(F.first("all").alias("whole"))
    by_chunk = _earlier(chunks, "_chunk", list(SERIES), names)
    starts = by_block.alias("x").join(by_chunk.alias("y"), _same("x", "y", in_series)).select(
        *(f"x.{c}" for c in in_chunk), _then(F.col("y.before"), F.col("x.before"), names).alias("before")
    )
    done = blocks.alias("x").join(starts.alias("y"), _same("x", "y", in_chunk)).select(
        F.col("y.before").alias("before"),
        F.inline(F.arrays_zip(F.col("x.rows").alias("r"), F.col("x.run").alias("step"))),
    )
    moved = _then(F.col("before"), F.col("step"), names)
    return done.withColumn("m", moved).select("r._row.*", *(
        (F.col("m.a") * F.lit(start) + F.col(f"m.{n}")).alias(name) for n, name in zip(names, values)
    ))


def wilder_rsi(bars: DataFrame, rows: int = RSI_ROWS, chunk_days: int | None = None) -> DataFrame:
    """``rsi{rows}`` from the columns Gain and Loss, with Wilder's smoothing.

    The first averages are plain ones of the first ``rows`` rows; before that the
    index is null, and so where nothing has moved. From then on an average is
    ``((rows - 1) * average + value) / rows``. Missing values count as no move.
    """
    columns = bars.columns
    filled = bars.withColumns({
        f"_{c}": F.coalesce(F.col(c), F.lit(0.0)) for c in ("Gain", "Loss")
    })
    framed = over_series(filled, {
        "_rows": lambda w: F.count("*").over(w.rowsBetween(-rows, 0)),
        "_first_Gain": lambda w: F.avg("_Gain").over(w.rowsBetween(1 - rows, 0)),
        "_first_Loss": lambda w: F.avg("_Loss").over(w.rowsBetween(1 - rows, 0)),
    }, back=rows, chunk_days=chunk_days)
    seen = F.col("_rows")
    keep = F.when(seen > rows, (rows - 1) / rows).otherwise(0.0)
    framed = recurrence(framed, keep, {
        f"_avg_{c}": F.when(seen > rows, F.col(f"_{c}") / rows)
        .when(seen == rows, F.col(f"_first_{c}")).otherwise(0.0)
        for c in ("Gain", "Loss")
    }, chunk_days=chunk_days)
    gain, loss = F.col("_avg_Gain"), F.col("_avg_Loss")
    index = F.when(F.col("_rows") >= rows, 100 * F.try_divide(gain, gain + loss))
    return framed.withColumn(f"rsi{rows}", index).select(*columns, f"rsi{rows}")
