import random
import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from barlab.llm import filter_audit

WORD = re.compile("[^\x20\x09-\x0d]+")


def failing(doc_id, text, firsts):
    text = text or ""
    words = WORD.findall(text)
    first = firsts.get(text)
    return "".join(name for name, fails in {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        "D": re.search("[#$%&*|]", text),
        "E": doc_id is not None and first is not None and first < doc_id,
    }.items() if fails)


def expected(rows, labels, filters="ABCDE"):
    """Every order run over the documents one after another."""
    firsts = {}
    for i, text, _ in rows:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = [(part or "", failing(i, text, firsts), i in good, i in toxic) for i, text, part in rows]
    out, credit = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in permutations(filters):
            left, gone = [d for d in docs if d[0] == part], []
            for step, name in enumerate(order, 1):
                removed = [d for d in left if name in d[1]]
                redundant = sum(name in d[1] for d in gone)
                left = [d for d in left if name not in d[1]]
                gone += removed
                unique = sum(d[0] == part and d[1] == name for d in docs)
                credit[part, name] += len(removed)
                out[part, "".join(order), step] = [
                    name, len(left), len(removed), redundant, unique,
                    sum(d[2] for d in removed), sum(d[3] for d in removed),
                ]
    return {k: (*v[1:], credit[k[0], v[0]]) for k, v in out.items()}


def found(spark, rows, labels):
    docs = spark.createDataFrame(
        [(i, t, p, 1, "x", True, "E") for i, t, p in rows],
        "doc_id long, text string, lang string, documents int, failed string, good boolean, E string",
    )
    marks = spark.createDataFrame(
        [(*label, "y") for label in labels], "doc_id long, quality int, toxic int, part string"
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = filter_audit.with_copies(docs, filter_audit.text_conditions(text), marks)
    table = filter_audit.audit(counts, list("ABCDE")).drop("filter").collect()
    assert len({r[:3] for r in table}) == len(table)
    return {tuple(r[:3]): tuple(r[3:]) for r in table}


def texts_of_all_kinds(rng):
    words = [f"w{i}" for i in range(200)]
    text = " ".join(rng.sample(words, 150) if rng.random() < 0.5 else rng.choices(words[:40], k=120))
    if rng.random() < 0.3:
        text = text[:100]
    if rng.random() < 0.3:
        text = text.upper()
    return text + rng.choice(["", " 100%", "\x0b#", " |\n"])


def test_equals_running_every_order(spark):
    rng = random.Random(5)
    pool = [texts_of_all_kinds(rng) for _ in range(25)]
    rows = [(i, rng.choice(pool), rng.choice(["en", "de", None, ""])) for i in range(120)]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 150, 2)]
    truth = expected(rows, labels)
    assert len({k[0] for k in truth}) == 3
    assert found(spark, rows, labels) == truth


def test_odd_rows(spark):
    same = "one text " * 60
    rows = [
        (None, None, None), (None, same, "en"), (4, same, "en"), (4, same, "de"), (4, same, "en"),
        (2, same, "fr"), (2, same, "fr"), (9, None, "en"), (10, "", "en"), (-3, "", "en"),
        (11, " \t\n\x0b\x0c\r ", "en"), (12, "É" * 30 + "A" * 3, "en"), (13, "É" * 30 + "A" * 4, "en"),
        (14, "  x y", "en"), (15, "long " * 50_000, "en"),
    ]
    labels = [(4, 1, None), (4, 0, 1), (None, 1, 1), (9, None, None), (99, 1, 1), (2, 1, 1)]
    assert found(spark, rows, labels) == expected(rows, labels)


def test_copies_cross_parts_and_tables_without_rows(spark):
    rows = [(1, "a b", "en"), (2, "a b", "de"), (3, "a  b", "de")]
    table = found(spark, rows, [])
    assert table["de", "EABCD", 1][1] == 1 and table["en", "EABCD", 1][1] == 0
    assert found(spark, [], [(1, 1, 1)]) == {}
    assert {v[4:6] for v in found(spark, rows, []).values()} == {(0, 0)}
