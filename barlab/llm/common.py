"""What the text operators share: word hashes, tables, Arrow batches, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

# Words whose hash a task remembers before it starts over; bounds its memory.
REMEMBERED_WORDS = 200_000
# Rows a task turns into Python objects at a time; Spark's own batches are larger.
ROWS_AT_ONCE = 1_000


class WordHashes(dict):
    """64-bit hashes of byte words, each computed once while it is remembered."""

    def __init__(self, limit: int = REMEMBERED_WORDS):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LEFT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of ordered pairs of hashed things."""
    return mix(left * _LEFT + mix(right))


def ascii_words(text: bytes | None) -> list[bytes]:
    """Runs of anything but space and the control characters 9 to 13."""
    return text.split() if text else []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes, which tasks can split and lower-case per ASCII rules."""
    return F.col(column).cast("string").cast("binary")


def map_batches(
    df: DataFrame,
    rows: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """``mapInArrow`` with state per task: ``rows()`` makes the function for the batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = rows()
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_ONCE):
                yield apply(batch.slice(start, ROWS_AT_ONCE))

    return df.mapInArrow(run, schema)


def list_array(parts: list[np.ndarray | None], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from one numpy array, or null, per row."""
    ends = np.cumsum([0, *(0 if p is None else len(p) for p in parts)])
    held = [p for p in parts if p is not None]
    flat = np.concatenate(held) if held else np.empty(0)
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(flat, kind),
        mask=pa.array([p is None for p in parts], pa.bool_()),
    )


def batch_of(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def longs(values: Iterable) -> pa.Array:
    return pa.array(values, pa.int64())


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """The smallest node each node of (a, b) is connected to: (node, component).

    Every round takes the smallest label among the neighbours and then the
    label of that label, so paths shrink by more than half. A node with very
    many neighbours sends and gets minima, which combine before the shuffle;
    nothing gathers its neighbours. Rounds are written to the shared folder.
    """
    both = written(
        edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(),
        f"{label}-edges",
    )
    state = written(
        both.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("lowest"))
        .select("node", F.least("node", "lowest").alias("component")),
        label,
    )
    while True:
        reached = (
            both.join(state, both["b"] == state["node"])
            .groupBy("a").agg(F.min("component").alias("near"))
        )
        hooked = state.join(reached, state["node"] == reached["a"]).select(
            "node", F.col("component").alias("before"),
            F.least("component", "near").alias("component"),
        )
        up = hooked.select(
            F.col("node").alias("up"), F.col("component").alias("further")
        )
        stepped = written(
            hooked.join(up, hooked["component"] == up["up"]).select(
                "node", "before", F.least("component", "further").alias("component")
            ),
            label,
        )
        state = stepped.select("node", "component")
        if stepped.filter("before <> component").isEmpty():
            return state
