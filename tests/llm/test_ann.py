import numpy as np
import pytest
from pyspark.sql import functions as F

from barlab.llm import ann
from barlab.llm.queries import QUERIES


def brute(rows, queries, k):
    """{query: [(id, score), ...]} over all rows."""
    clean = {}
    for i, v in rows:
        if i is None or v is None or not len(v) or None in v:
            continue
        v = np.array(v, float)
        v = v / np.abs(v).max() if np.isfinite(v).all() and v.any() else v
        if np.isfinite(v).all() and v.any():
            clean.setdefault(i, v)
    result = {}
    for q in queries:
        if q in clean:
            scored = [
                (-(clean[q] * v).sum() / (np.linalg.norm(clean[q]) * np.linalg.norm(v)), i)
                for i, v in clean.items() if i != q
            ]
            result[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return result


def by_query(found):
    result = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        result.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(result[r.query_id])
    return result


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_recall_on_the_table(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    truth = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    found = by_query(QUERIES["op2_neighbours"](spark, path).collect())
    assert found.keys() == truth.keys() and all(len(f) == 5 for f in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits >= 0.9 * 5 * len(truth)


def test_every_code_within_the_radius_is_found():
    random = np.random.default_rng(2)
    words = random.integers(0, 2 ** 16, (500, 4)).astype("<u2")
    words[1:60] = words[0] ^ (random.random((59, 4, 16)) < 0.1).dot(1 << np.arange(16)).astype("<u2")
    block = ann.Block(words)
    for radius in (0, 3, 8, 15, 22, 30):
        distance = np.bitwise_count(words ^ words[0]).sum(1)
        assert block.within(words[0], radius).tolist() == np.flatnonzero(distance <= radius).tolist()


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]),
        (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, []), (None, [1.0, 0.0]), (8, [-1.0, 0.0]),
        (9, [1e200, 1e200]), (100, [float("inf"), 0.0]), (10, [3.0, 0.0]), (1, [2.0, 0.0]),
    ]
    df = spark.createDataFrame(
        [(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, rank string, score double"
    )
    found = by_query(ann.search(df, F.col("vec_id") % 50 == 0, k=5).collect())
    truth = brute(rows, [0, 50, 100], 5)
    assert found.keys() == truth.keys()
    for q in truth:
        assert [i for i, _ in found[q]] == [i for i, _ in truth[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in truth[q]])
    assert ann.search(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_many_copies_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    random = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else random.normal(size=3).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = by_query(ann.search(df, F.col("vec_id") % 50 == 0, k=5).collect())
    truth = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert [i for i, _ in found[0]] == [3, 6, 9, 12, 15] == [i for i, _ in truth[0]]
    assert all(len(f) == 5 for f in found.values()) and found.keys() == truth.keys()


@pytest.mark.parametrize("copies", [2, 7, 8, 33])
def test_copies_come_by_id_at_any_place(spark, copies):
    """Equal vectors have equal scores, so the smaller ids come first, in many dimensions too."""
    for seed in range(6):
        random = np.random.default_rng(seed)
        same = random.normal(size=64)
        rows = [(i, same.tolist()) for i in range(1, copies + 1)]
        rows += [(50 * i, (same + random.normal(size=64) / 9).tolist()) for i in range(2, 5)]
        rows += [(1_000 + i, random.normal(size=64).tolist()) for i in range(1, 12)]
        random.shuffle(rows)
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
        found = by_query(ann.search(df, F.col("vec_id") == 100, k=5).collect())
        near = [i for i, _ in found[100] if i <= copies]
        assert near == sorted(near) and near == list(range(1, len(near) + 1))
        assert len(near) >= min(copies, 3)
        assert [i for i, _ in found[100]] == [i for i, _ in brute(rows, [100], 5)[100]]
