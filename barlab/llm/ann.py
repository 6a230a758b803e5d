"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

1. Codes. Vectors of unit length are centred and turned by learned rotations
   (each alternates between the signs of the turned sample and the rotation that
   fits them best); the signs are the bits. Several rotations give more bits
   than dimensions, which sharpens the Hamming distance.
2. Index. Rows are dealt to blocks of about ``BLOCK_ROWS`` by a hash of their id.
   In a block the codes are split into 16-bit substrings, each with a table from
   its value to the rows.
3. Probing. A code within radius ``r`` of a query's has at least one substring
   within a share of ``r`` (the shares add up to ``r - m + 1``), so looking up all
   values that close in every table finds every code within ``r``. Codes found
   are checked on all bits.
4. The rows left are ranked by their cosine in double precision on the original
   vectors; the best ``k`` of each block go on to a final ranking.

The radius is learned on the sample, so that true neighbours lie within it in
``COVERED`` of the cases. A block in which fewer than ``k`` codes lie within it
widens it until there are enough, so every query gets its full number of rows.

Rotations and radius are fitted on ``SAMPLE`` rows; every row is indexed. Queries
and blocks meet in cells of bounded size. All copies of one vector spread over
all blocks, and a block passes on ``k`` rows of them.

Vectors that are null, zero or hold a null or non-finite number, rows with a
null id, and vectors whose length differs from that of most of the sample take
no part. Rows that repeat an id count as one candidate, by their best cosine.
Scores are sums taken row by row, so equal vectors have equal scores, and equal
scores are ranked by id. No rows, or no queries, give no rows; further columns are
not read. A vector is held whole, so its length is bounded by a task's memory.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 8_192
PROBES = 256
COVERED = 0.97
ROTATIONS = 2
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 2_048
TURNS = 30
SUB = 16  # bits of a substring


class Codes:
    """Centre, rotations and radius; makes codes of rows of unit vectors."""

    def __init__(self, centre: np.ndarray, rotations: list[np.ndarray]):
        self.centre, self.rotations = centre, rotations
        self.bits = -(-sum(r.shape[1] for r in rotations) // SUB) * SUB
        self.radius = self.bits

    def substrings(self, unit: np.ndarray) -> np.ndarray:
        """One row of 16-bit numbers per vector."""
        turned = np.concatenate([(unit - self.centre) @ r for r in self.rotations], axis=1) > 0
        padded = np.zeros((len(unit), self.bits), bool)
        padded[:, :turned.shape[1]] = turned
        return np.packbits(padded, axis=1, bitorder="little").view("<u2")


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors times powers of two, so that no square overflows; cosines stay the same."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit(sample: np.ndarray, k: int, rotations: int = ROTATIONS, seed: int = 7) -> Codes:
    """Rotations and radius from a sample of vectors."""
    dimensions = sample.shape[1] if sample.ndim == 2 else 1
    if len(sample) < 2:
        return Codes(np.zeros(dimensions), [np.eye(dimensions)] * rotations)
    unit = _unit(sample)
    centre = unit.mean(0)
    moved = unit - centre
    random = np.random.default_rng(seed)
    found = []
    for _ in range(rotations):
        turn = np.linalg.qr(random.normal(size=(dimensions, dimensions)))[0]
        for _ in range(TURNS):
            signs = np.where(moved @ turn > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(moved.T @ signs)
            turn = u @ v
        found.append(turn)
    codes = Codes(centre, found)
    words = codes.substrings(unit)
    probes = random.permutation(len(unit))[:PROBES]
    far = []
    for probe in probes:
        cosine = unit @ unit[probe]
        cosine[probe] = -2.0
        near = np.argsort(-cosine)[:min(k, len(unit) - 1)]
        far += np.bitwise_count(words[near] ^ words[probe]).sum(1).tolist()
    codes.radius = int(np.quantile(far, COVERED, method="higher")) if far else codes.bits
    return codes


class Block:
    """Tables from substring values to the rows of one block."""

    def __init__(self, words: np.ndarray):
        self.words = words
        # Of each substring the values that occur, and the place of every row's value.
        self.tables = [np.unique(column, return_inverse=True) for column in words.T]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within ``radius`` of the query's."""
        m = len(self.tables)
        shares, more = divmod(max(radius - m + 1, 0), m)
        held = np.zeros(len(self.words), bool)
        for i, (values, places) in enumerate(self.tables):
            close = np.bitwise_count(values ^ query[i]) <= shares + (i < more)
            held |= close[places]
        rows = np.flatnonzero(held)
        return rows[np.bitwise_count(self.words[rows] ^ query).sum(1) <= radius]

    def candidates(self, query: np.ndarray, radius: int, least: int) -> np.ndarray:
        """Rows within the radius, widened until there are ``least`` or all."""
        least = min(least, len(self.words))
        rows = self.within(query, radius)
        while len(rows) < least:
            radius += max(1, radius // 8)
            rows = self.within(query, radius)
        return rows


def _usable(vector: Column) -> Column:
    wide = vector.cast("array<double>")
    return (
        vector.isNotNull()
        & F.forall(wide, lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)
        ))
        & F.exists(wide, lambda x: x != 0)
    )


def search(
    vectors: DataFrame, queries: Column, k: int = 5, id_column: str = "vec_id",
    vector_column: str = "embedding", sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query row.

    ``queries`` is a condition on ``vectors``; a query's own id is no candidate.
    """
    clean = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"), queries.alias("asks"),
    ).filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    drawn = clean.orderBy(F.xxhash64("id"), "id").select("vector").limit(sample).collect()
    sizes = Counter(len(r.vector) for r in drawn)
    size = max(sizes, key=lambda s: (sizes[s], s)) if sizes else 1
    codes = fit(np.array([r.vector for r in drawn if len(r.vector) == size]).reshape(-1, size), k)
    clean = clean.filter(F.size("vector") == size)
    shared = vectors.sparkSession.sparkContext.broadcast(codes)  # a few dimensions squared
    counts = clean.agg(F.count("*").alias("rows"), F.sum(F.col("asks").cast("int"))).first()
    blocks = max(1, -(-counts[0] // BLOCK_ROWS))
    packs = max(1, -(-(counts[1] or 0) // BLOCK_QUERIES))

    def cells(df: DataFrame, own: str, parts: int, other: str, copies: int, seed: int) -> DataFrame:
        """Each row in one part of its own kind, in a copy for each part of the other."""
        return df.select(
            F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(parts)).alias(own),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias(other),
            "id", "vector",
        )

    rows = cells(clean, "block", blocks, "pack", packs, 1)
    asked = cells(clean.filter("asks"), "pack", packs, "block", blocks, 2)

    def best(held: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if held.empty or wanted.empty:
            return pd.DataFrame({c: [] for c in columns})
        fitted: Codes = shared.value
        # Rows that repeat an id stay together, so each cell can rank distinct ids.
        held, wanted = held.sort_values("id"), wanted.sort_values("id")
        originals, asks = _scaled(np.stack(held["vector"])), _scaled(np.stack(wanted["vector"]))
        norms = np.linalg.norm(originals, axis=1)
        ids = held["id"].to_numpy()
        block = Block(fitted.substrings(_unit(originals)))
        words = fitted.substrings(_unit(asks))
        parts = []
        for query_id, ask, word in zip(wanted["id"], asks, words, strict=True):
            own = np.searchsorted(ids, [query_id, query_id + 1])
            copies = len(ids) - len(np.unique(ids))
            found = block.candidates(word, fitted.radius, k + int(own[1] - own[0]) + copies)
            found = found[ids[found] != query_id]
            if not len(found):
                continue
            # Row by row, so that equal vectors have equal scores wherever they stand.
            score = (originals[found] * ask).sum(axis=1) / (norms[found] * np.linalg.norm(ask))
            order = np.lexsort((ids[found], -score))
            _, first = np.unique(ids[found][order], return_index=True)
            order = order[np.sort(first)[:k]]
            parts.append(pd.DataFrame(
                {"query_id": query_id, "vec_id": ids[found][order], "score": score[order]}
            ))
        return pd.concat(parts) if parts else pd.DataFrame({c: [] for c in columns})

    near = rows.groupBy("block", "pack").cogroup(asked.groupBy("block", "pack")).applyInPandas(
        best, "query_id long, vec_id long, score double"
    )
    # Repeated query rows give the same rows again.
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn(
        "rank", F.row_number().over(nearest)
    ).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
