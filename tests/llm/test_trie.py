import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from barlab.llm import trie


def expected(rows, group=5, longest=8):
    """The nodes by whole prefixes held as tuples."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:3])] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (longest + 1)
        lender = c - (c % group if c >= 0 else -(-c % group))
        whole[c] = own.get(lender, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs in members.items():
        gain = (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += gain
    return sorted((
        min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
        children[path], leaves[path], saved[path],
        hashlib.sha256(",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(path))
                       .encode()).hexdigest(),
    ) for path, convs in members.items())


def found(spark, rows, **options):
    turns = spark.createDataFrame(
        [(*r, 7, "x", 1) for r in rows],
        "conv_id long, turn long, role string, text string, depth int, owner string, chunk int",
    )
    table = trie.prefix_trie(turns, **options)
    assert table.columns == [part.split()[0] for part in trie.RESULT.split(", ")]
    return sorted(map(tuple, table.collect()), key=lambda r: (r[0], r[1]))


def conversations(rng, count, depth, texts):
    return [
        (c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]),
         rng.choice(texts))
        for c in rng.sample(range(-20, 3 * count), count) for t in range(rng.randrange(1, depth))
    ]


@pytest.mark.parametrize("spread", [trie.SPREAD, 3])
def test_equals_whole_prefixes(spark, spread):
    """Also with every key above three rows dealt over several."""
    rng = random.Random(spread)
    rows = conversations(rng, 60, 12, ["a", "é", "", None])
    # Equal turns come in the order of their digests, so their texts are made equal.
    seen, kept = {}, []
    for c, t, role, text in rows:
        kept.append((c, t, *seen.setdefault((c, t), (role, text))))
    assert found(spark, kept, spread=spread) == expected(kept)


def test_one_long_conversation_and_copies(spark):
    """A chain as deep as half the nodes, which rounds have to halve, in several chunks."""
    rows = [(0, t, "user", f"turn {t}") for t in range(700)]
    rows += [(c, t, "user", f"turn {t}") for c in range(1, 40) for t in range(c * 17)]
    rows += [(c, t, "user", "end") for c in range(40, 60) for t in range(3)]
    assert found(spark, rows, spread=50) == expected(rows)


def test_paths_longer_than_a_stride(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRIDE", 7)
    rows = [(0, t, "user", "x" * (t % 5)) for t in range(120)]
    assert found(spark, rows) == expected(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "dropped"), (3, None, None, None), (3, 1, "user", "x" * 300_000),
        (4, 1, "user", "one turn, replaced"), (-7, 2, "", "é"), (-7, -2, "user", ""),
        (3, 2, "user", "same"), (3, 2, "user", "same"), (2**62, 1, "user", "far"),
    ]
    assert found(spark, rows) == expected(rows)
    assert found(spark, rows[:1]) == [] and found(spark, []) == []
    assert found(spark, [(6, 1, "u", "alone")]) == expected([(6, 1, "u", "alone")])
