"""Window functions along a series, and the newest rows of every series.

There may be only a handful of series, one of which holds most of the rows, so
a window partitioned by series alone would leave nearly all executors idle.
``over_series`` cuts every series into calendar chunks instead and sorts each
chunk on its own. A row near a border needs rows of the neighbouring chunks, so
the days that hold those are carried along: rows are counted per day first, which
combines before the shuffle and gives one row per series and day, and running
totals over that small table tell which days each chunk needs from outside. Their
rows go to both chunks. So every frame is whole, however sparse the chunks are;
all rows are shuffled and sorted once, and the carried ones are dropped again.

Rows of one date are ordered by a hash of all their columns, so the order in
which they arrive changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schemas import SERIES, TIME
from ..session import written

Build = Callable[[WindowSpec], Column]

# Days per chunk and minute of a bar, for roughly 90,000 bars whatever their length.
CHUNK_DAYS_PER_MINUTE = 64
MINUTES = {"min": 1, "h": 60, "d": 1440}

# Sorts before every real day, like a NULL date does.
_NO_DAY = -(2**31)

# Days near a border are broadcast up to so many (about 100 MB), else joined by a shuffle.
BROADCAST_DAYS = 1_000_000

_TIE = "_tie"


def plain_window(*extra: str) -> WindowSpec:
    """Along a series, in a total order; the rows need the column ``_tie``."""
    return Window.partitionBy(*SERIES, *extra).orderBy(TIME, _TIE)


def with_ties(df: DataFrame) -> DataFrame:
    return df.withColumn(_TIE, F.xxhash64(*df.columns))


def _day() -> Column:
    return F.coalesce(F.unix_date(F.to_date(TIME)), F.lit(_NO_DAY))


def _chunk(days: int | None) -> Column:
    day = F.unix_date(F.to_date(TIME))
    if days is not None:
        width = F.lit(days)
    else:
        # "4h" is 4 units of 60 minutes; a name of another form counts as one minute.
        count = F.regexp_extract("Timeframe", "^([0-9]{1,4})[a-z]+$", 1).try_cast("int")
        unit = F.regexp_extract("Timeframe", "^[0-9]{1,4}([a-z]+)$", 1)
        minutes = F.lit(None).cast("int")
        for name, length in MINUTES.items():
            minutes = F.when(unit == name, F.greatest(count, F.lit(1)) * length).otherwise(minutes)
        width = F.coalesce(minutes, F.lit(1)) * CHUNK_DAYS_PER_MINUTE
    return F.coalesce(F.floor(day / width).cast("int"), F.lit(_NO_DAY))


def _carried(chunked: DataFrame, back: int, ahead: int) -> DataFrame:
    """(Pair, Timeframe, day, to): the other chunks that need the rows of a day."""
    days = chunked.groupBy(*SERIES, "_day", "_chunk").agg(F.count("*").alias("n"))
    along = Window.partitionBy(*SERIES).orderBy("_day")
    upto = F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0))
    following, before = F.lead("_chunk").over(along), F.lag("_chunk").over(along)
    placed = days.select(
        *SERIES, "_day", upto.alias("upto"), (upto - F.col("n")).alias("from"),
        # A chunk begins after this day, or has ended before it.
        F.when(following != F.col("_chunk"), following).alias("begins"),
        F.when(before != F.col("_chunk"), before).alias("ended"),
    )
    # Chunks that begin less than ``back`` rows after the day, and such that ended before it.
    later = Window.partitionBy(*SERIES).orderBy("upto").rangeBetween(0, back - 1)
    earlier = Window.partitionBy(*SERIES).orderBy("from").rangeBetween(1 - ahead, 0)
    none = F.array().cast("array<int>")
    to = F.concat(
        F.collect_list("begins").over(later) if back else none,
        F.collect_list("ended").over(earlier) if ahead else none,
    )
    return placed.select(*SERIES, "_day", to.alias("to")).filter(F.size("to") > 0)


def over_series(
    df: DataFrame,
    builds: Mapping[str, Build],
    back: int = 0,
    ahead: int = 0,
    chunk_days: int | None = None,
) -> DataFrame:
    """Add window columns along (Pair, Timeframe) in Date order.

    Each column is a function of the ordered window and may use up to ``back``
    rows before the current one and ``ahead`` rows after it. ``chunk_days=0``
    runs the plain window.
    """
    columns = df.columns
    tied = with_ties(df)

    def windowed(over: WindowSpec) -> list[Column]:
        return [build(over).alias(name) for name, build in builds.items()]

    if chunk_days == 0:
        return tied.select(*columns, *windowed(plain_window()))

    chunked = tied.withColumns({"_chunk": _chunk(chunk_days), "_day": _day()})
    own = plain_window("_in")
    carried = written(_carried(chunked, back, ahead), "border-days") if back or ahead else None
    near = carried.count() if carried is not None else 0
    if not near:  # no series has a border
        return chunked.withColumn("_in", F.col("_chunk")).select(*columns, *windowed(own))
    if near <= BROADCAST_DAYS:
        carried = F.broadcast(carried)
    same = F.lit(True)
    for column in (*SERIES, "_day"):
        same = same & F.col(f"r.{column}").eqNullSafe(F.col(f"c.{column}"))
    to = F.concat(F.array("r._chunk"), F.coalesce("c.to", F.array().cast("array<int>")))
    dealt = chunked.alias("r").join(carried.alias("c"), same, "left").select(
        "r.*", F.explode(to).alias("_in")
    )
    return dealt.select("*", *windowed(own)).filter("_in = _chunk").select(*columns, *builds)


def last_rows(df: DataFrame, count: int) -> DataFrame:
    """The newest ``count`` rows of every series, with ``_age`` 1 for the newest.

    The rank limit is applied before the shuffle, so a task sends at most
    ``count`` rows per series.
    """
    newest_first = Window.partitionBy(*SERIES).orderBy(F.col(TIME).desc(), F.col(_TIE).desc())
    aged = with_ties(df).withColumn("_age", F.row_number().over(newest_first))
    return aged.filter(F.col("_age") <= count).drop(_TIE)


def series_tail(df: DataFrame, count: int = 4) -> DataFrame:
    return last_rows(df, count).drop("_age")


def load_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES).agg(F.count("*").alias("rows"))
