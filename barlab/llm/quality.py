"""Quality classifier: ordinal regression with cumulative links on hashed text.

The probability that a text has more than grade ``j`` is
``sigmoid(score - threshold[j])``. All grades share the weights of the score, and
the thresholds are ordered by construction. From them come the expected grade
and, for selection, the probability of a grade or a higher one.

The score is a mean of weights over the words of the whole text (each word has a
hashed feature for itself and one for its shape) plus weights of a few hashed
statements about the whole text, such as the share of repeated words.

The model is fitted on a bounded sample of labelled rows: ``SAMPLE`` rows with
the smallest hash of their id. A row has at most ``BUCKETS`` features, so the
sample on the driver has a fixed bound too. Scoring reads each text once.

Nulls: a null or empty text has no words and only the statements of an empty
text. Labels with a null id or grade are not used; labels that repeat an id are
used each. Rows with a null or repeated id are scored like any other. Without
labels, or without labels of some grade, the thresholds that no row speaks for
stay where they begin, so every grade has a probability. Equal scores are equal
results. An empty table gives an empty one; further columns are not read, and
``select_rows`` keeps them. Texts of any length are read whole, by one task each.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_words, batch_of, list_array, map_batches, text_bytes

SAMPLE = 4_000
BUCKETS = 8_192
REMEMBERED = 100_000
# A feature, no text: changes of class after so many leave the shape of a word as it is.
SHAPE_SIGNS = 12

# Shape classes: letters by case, digits, anything beyond ASCII; other characters stay.
_CLASSES = bytes(
    ord("a") if chr(c).islower() and c < 128
    else ord("A") if chr(c).isupper() and c < 128
    else ord("0") if chr(c).isdigit() and c < 128
    else ord("a") if c >= 128
    else c
    for c in range(256)
)


def _bucket(kind: bytes, value: bytes) -> int:
    return zlib.crc32(kind + value) % BUCKETS


def _shape(word: bytes) -> bytes:
    """The classes of the characters, runs of one class cut to one, up to ``SHAPE_SIGNS``."""
    classes = word.translate(_CLASSES)
    return bytes(c for c, before in zip(classes, b"\0" + classes, strict=False) if c != before)[:SHAPE_SIGNS]


class _WordFeatures(dict):
    """The two buckets of a word."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = (_bucket(b"w", word.lower()), _bucket(b"s", _shape(word)))
        return value


def _statements(words: list[bytes]) -> list[int]:
    """Buckets of what holds for the text as a whole."""
    n = len(words)
    distinct = len(set(words)) / n if n else 0.0
    length = sum(map(len, words)) / n if n else 0.0
    said = (
        (b"size", min(n.bit_length(), 12)),
        (b"distinct", int(distinct * 20)),
        (b"length", min(int(length), 20)),
    )
    return [_bucket(kind, str(value).encode()) for kind, value in said]


def features(text: bytes | None, known: _WordFeatures) -> tuple[np.ndarray, np.ndarray]:
    """Buckets, not distinct, and their values: word features sum to two."""
    words = ascii_words(text)
    of_words = np.fromiter(
        (i for pair in map(known.__getitem__, words) for i in pair), np.int64, 2 * len(words)
    )
    of_text = np.array(_statements(words), np.int64)
    values = np.full(len(of_words) + len(of_text), 0.25)
    values[:len(of_words)] = 1.0 / max(len(words), 1)
    return np.concatenate([of_words, of_text]), values


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(x / 2))


class OrdinalModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """Per score, the probabilities of more than each grade but the last."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, steps: int = 400,
    penalty: float = 1e-5, rate: float = 0.3, levels: int | None = None,
) -> OrdinalModel:
    """Maximum likelihood by Adam over all rows; grades are 0, 1, 2, ..., ``levels`` of them.

    A grade that no row has keeps its threshold, far from the others.
    """
    count = (int(grades.max()) if len(grades) else 1) if levels is None else levels - 1
    ends = np.cumsum([0, *(len(i) for i, _ in rows)])
    index = np.concatenate([i for i, _ in rows]) if rows else np.empty(0, np.int64)
    value = np.concatenate([v for _, v in rows]) if rows else np.empty(0)
    row_of = np.repeat(np.arange(len(rows)), np.diff(ends))
    cuts = max(count, 1)
    # Parameters: weights, first threshold, logarithms of the gaps between thresholds.
    theta = np.concatenate([np.zeros(BUCKETS), [-1.0], np.zeros(cuts - 1)])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, (steps if len(grades) else 0) + 1):
        weights = theta[:BUCKETS]
        gaps = np.exp(theta[BUCKETS + 1:])
        thresholds = theta[BUCKETS] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row_of, weights[index] * value, len(rows))
        above = _sigmoid(score[:, None] - thresholds)
        bounded = np.concatenate(
            [np.ones((len(score), 1)), above, np.zeros((len(score), 1))], axis=1
        )
        slope = np.concatenate(
            [np.zeros((len(score), 1)), above * (1 - above), np.zeros((len(score), 1))], axis=1
        )
        at = np.arange(len(score))
        chance = np.maximum(bounded[at, grades] - bounded[at, grades + 1], 1e-12)
        by_score = -(slope[at, grades] - slope[at, grades + 1]) / chance / len(score)
        by_cut = np.zeros((len(score), cuts + 2))
        by_cut[at, grades] += slope[at, grades] / chance / len(score)
        by_cut[at, grades + 1] -= slope[at, grades + 1] / chance / len(score)
        cut_sums = by_cut.sum(0)[1:-1]
        later = np.cumsum(cut_sums[::-1])[::-1]
        gradient = np.concatenate([
            np.bincount(index, by_score[row_of] * value, BUCKETS) + penalty * weights,
            [later[0]], later[1:] * gaps,
        ])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient ** 2
        theta = theta - rate * (mean / (1 - 0.9 ** step)) / (
            np.sqrt(square / (1 - 0.999 ** step)) + 1e-8
        )
    thresholds = theta[BUCKETS] + np.concatenate([[0.0], np.cumsum(np.exp(theta[BUCKETS + 1:]))])
    return OrdinalModel(theta[:BUCKETS], thresholds)


def train(
    docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, grades: int | None = None
) -> OrdinalModel:
    """Fit on ``ratings`` (doc_id, grade from 0), joined with the texts of ``docs``.

    ``grades`` is the number of grades there are, which the ratings need not all have.
    """
    chosen = (
        ratings.filter("doc_id is not null and grade is not null")
        .select(F.col("doc_id").cast("long").alias("rated"), F.col("grade").cast("int"))
        .orderBy(F.xxhash64("rated"), "rated", "grade").limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    # At most ``sample`` rows are broadcast.
    rated = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["rated"]).select(
        "doc_id", "grade", "text"
    )

    def rows():
        known = _WordFeatures()

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            indexes, values = [], []
            for text in batch.column(2).to_pylist():
                index, value = features(text, known)
                distinct, back = np.unique(index, return_inverse=True)
                indexes.append(distinct.astype(np.int32))
                values.append(np.bincount(back, value).astype(np.float32))
            return batch_of(
                doc_id=batch.column(0), grade=batch.column(1),
                index=list_array(indexes, pa.int32()), value=list_array(values, pa.float32()),
            )

        return apply

    collected = map_batches(
        rated, rows, "doc_id long, grade int, index array<int>, value array<float>"
    ).orderBy("doc_id", "grade").collect()
    return fit(
        [(np.array(r["index"], np.int64), np.array(r["value"], np.float64)) for r in collected],
        np.array([r.grade for r in collected], np.int64), levels=grades,
    )


def grade(docs: DataFrame, model: OrdinalModel, least: int = 1, probability: float = 0.5) -> DataFrame:
    """Per row: doc_id, expected_grade, tails, selected.

    ``tails[j]`` is the probability of a grade above ``j``; ``selected`` says
    whether grade ``least`` or more has at least ``probability``.
    """
    packed = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    def rows():
        known, fitted = _WordFeatures(), packed.value

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = np.empty(len(batch))
            for i, text in enumerate(batch.column(1).to_pylist()):
                index, value = features(text, known)
                scores[i] = fitted.weights[index] @ value
            tails = fitted.tails(scores)
            return batch_of(
                doc_id=batch.column(0), expected_grade=pa.array(tails.sum(1)),
                tails=list_array(list(tails), pa.float64()),
                selected=pa.array(tails[:, least - 1] >= probability),
            )

        return apply

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    return map_batches(
        source, rows,
        "doc_id long, expected_grade double, tails array<double>, selected boolean",
    )


def select_rows(docs: DataFrame, model: OrdinalModel, least: int = 1, probability: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that ``grade`` selects, in one pass without a join."""
    packed = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def rows():
        known, fitted = _WordFeatures(), packed.value

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = np.empty(len(batch))
            for i, text in enumerate(batch.column(place).to_pylist()):
                index, value = features(text.encode() if text else None, known)
                scores[i] = fitted.weights[index] @ value
            return batch.filter(pa.array(fitted.tails(scores)[:, least - 1] >= probability))

        return apply

    return map_batches(docs, rows, docs.schema)


def composed_grades(labels: DataFrame) -> DataFrame:
    """Grades from the two marks of a label: 0 bad, 1 good but toxic, 2 good."""
    return labels.select(
        "doc_id",
        F.when(F.col("quality") == 0, 0)
        .when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 2 - F.col("toxic"))
        .cast("int").alias("grade"),
    )
