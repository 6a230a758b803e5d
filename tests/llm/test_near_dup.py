import random

import pytest

from barlab.llm import near_dup
from barlab.llm.common import components


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in low.replace("\t", " ").replace("\n", " ").replace("\x0b", " ")
            .replace("\x0c", " ").replace("\r", " ").split(" ") if w]


def shingles(text, size):
    words = words_of(text)
    size = min(size, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def expected(rows, size, percent=80):
    """{id: (set size, component)} by comparing all pairs."""
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text, size))
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def linked(a, b):
        return a and b and 100 * len(a & b) >= percent * len(a | b)

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if any(linked(a, b) for a in sets[i] for b in sets[j]):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i in ids}


def check(docs, rows, size):
    found = near_dup.near_duplicates(docs, size).collect()
    truth = expected(rows, size)
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == truth[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    assert sorted(r.n_shingles for r in found) == sorted(len(shingles(t, size)) for _, t in rows)


@pytest.mark.parametrize("size", [2, 5])
def test_equals_all_pairs_on_the_table(documents, texts, size):
    check(documents, list(texts.items()), size)


def family(rng, n, edits, length=150, words=400):
    base = [f"w{rng.randrange(words)}" for _ in range(length)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(length)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    return rows


def test_equals_all_pairs_near_the_limit(make_docs):
    """A large group of edited copies, many pairs of which lie close to the limit."""
    rng = random.Random(5)
    rows = family(rng, 220, 16)
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, passage + " " + " ".join(f"q{i}_{j}" for j in range(30)))
             for i in range(80)]
    check(make_docs(rows), rows, 2)


def test_blocks_equal_all_pairs(make_docs, monkeypatch):
    monkeypatch.setattr(near_dup, "LARGE", 4)
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", 5)
    monkeypatch.setattr(near_dup, "CROWD_SHINGLES", 500)
    rows = family(random.Random(6), 90, 22)
    check(make_docs(rows), rows, 2)


def test_odd_rows(make_docs):
    long = " ".join(f"a{i}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\x0btwo "),
        (8, "É é"), (9, "é é"), (10, long), (11, long + " b"), (None, "one two"), (12, "one two"),
        (12, "one two"), (13, "a b c d e f g h i j k"), (14, "a b c d e f g h i j k l"),
        (15, "ä b c"), (4, "one"),
    ]
    check(make_docs(rows), rows, 2)


def test_empty_table(make_docs):
    assert near_dup.near_duplicates(make_docs([(1, "a")]).limit(0)).collect() == []


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def texts_of(n):
    return " ".join(f"{n}{i}" for i in range(60))


def ids_with_two_texts():
    x, y, z = texts_of("x"), texts_of("y"), texts_of("z")
    return [(1, x), (3, x), (3, z), (5, z + " more"), (11, x + " w"), (11, y), (15, y + " more"), (3, ""),
            (20, "é"), (20, ""), (21, y + " more still")]


def test_ids_with_two_texts_join_their_classes(make_docs):
    for rows in (ids_with_two_texts(), ids_with_two_texts()[::-1]):
        check(make_docs(rows), rows, 2)


def test_the_pipeline_keeps_one_row_of_each_group_of_texts(spark, make_docs):
    import corpus_pipeline

    x, y, z = texts_of("x"), texts_of("y"), texts_of("z")
    rows = [*ids_with_two_texts(), (1, x), (None, x), (None, x), (1, x.upper())]
    found = corpus_pipeline.keep_distinct(spark, make_docs(rows), "").collect()
    kept = [(r.doc_id, r.text) for r in found]
    assert len([r for r in kept if r[0] == 1 and r[1].lower() == x]) == 1
    rest = [r for r in kept if r[0] != 1]
    assert sorted(rest, key=str) == sorted(
        [(None, x), (None, x), (3, z), (11, y), (3, ""), (20, "é"), (20, "")], key=str
    )
    assert list(found[0].asDict()) == make_docs(rows).columns


def test_loss_at_the_limit_is_as_stated(spark):
    from math import comb

    from pyspark.sql import functions as F

    needed = spark.range(1).select(near_dup._needed(F.lit(10 ** 9), 128, 0.8)).first()[0]
    loss = sum(comb(128, i) * 0.8 ** i * 0.2 ** (128 - i) for i in range(int(needed)))
    assert loss < 2.5e-7


@pytest.mark.parametrize("limit", [0, 2_000_000])
def test_more_compared_documents_than_a_broadcast_holds(make_docs, monkeypatch, limit):
    monkeypatch.setattr(near_dup, "BROADCAST_ROWS", limit)
    rows = family(random.Random(8), 60, 14) + [(None, "a b c d"), (900, None), (901, "a b c d")]
    check(make_docs(rows), rows, 2)
