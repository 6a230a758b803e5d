import hashlib
import re

from barlab.llm import decontaminate


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(rows, items, size=10):
    grams = {}
    for item, text in items:
        words = words_of(text)
        n = min(size, len(words))
        for p in range(len(words) - n + 1 if words else 0):
            grams.setdefault(tuple(words[p:p + n]), set()).add(item)
    widths = {len(g) for g in grams}
    result = []
    for doc, text in rows:
        words, hit, found = words_of(text), set(), set()
        for n in widths:
            for p in range(len(words) - n + 1):
                owners = grams.get(tuple(words[p:p + n]))
                if owners:
                    hit.update(range(p, p + n))
                    found |= owners
        listed = ",".join(sorted(map(str, found)))
        result.append((doc, len(words), len(hit), len(found),
                       hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return result


def check(docs, rows, benchmark, items):
    found = decontaminate.contamination(docs, benchmark).drop("text_hash").collect()
    order = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, found), key=order) == sorted(expected(rows, items), key=order)


def test_equals_all_windows_on_the_table(spark, documents, texts):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    check(documents, list(texts.items()), benchmark, items)


def odd(spark, make_docs):
    ten = "a b c d e f g h i j"
    items = [
        (1, ten + " k l"), (2, "Short ITEM"), (3, "one"), (4, None), (5, "--- !!"), (10, ten),
        (6, "É é straße " * 5), (7, "x1 x2 x3 x4 x5 x6 x7 x8 x9"), (2, "short item"),
    ]
    rows = [
        (1, "z " + ten.upper() + ". y"), (2, ten.replace(" ", "--")), (3, "a b c d e f g h i"),
        (4, None), (5, ""), (6, "... one!"), (7, "a short\titem, a SHORT item"), (8, "É é straße " * 9),
        (9, "é é straße " * 9), (None, ten), (10, ten), (10, "no"), (10, ten),
        (11, "x1 x2 x3 x4 x5 x6 x7 x8 x9"), (12, "y " * 30_000 + ten + " y" * 7),
    ]
    for shift in range(12):
        rows.append((100 + shift, "q " * shift + ten + " k l" + " r" * shift))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return make_docs(rows), rows, benchmark, items


def test_odd_rows(spark, make_docs):
    check(*odd(spark, make_docs))


def test_empty_tables(spark, make_docs):
    docs, rows, benchmark, items = odd(spark, make_docs)
    check(docs, rows, benchmark.limit(0), [])
    check(docs.limit(0), [], benchmark, items)


def test_shuffled_instead_of_broadcast(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    check(*odd(spark, make_docs))


def test_removal_of_documents_and_spans(spark, make_docs):
    docs, rows, benchmark, items = odd(spark, make_docs)
    dirty = {(d, t) for (d, t), r in zip(rows, expected(rows, items), strict=True) if r[5]}
    kept = decontaminate.remove_documents(docs, benchmark)
    assert kept.columns == docs.columns
    wanted = [(d, t) for d, t in rows if (d, t) not in dirty]
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=order) == sorted(wanted, key=order)
    cut = decontaminate.remove_spans(docs, benchmark)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert texts[1] == "z y" and texts[7] == "a a" and texts[3] == "a b c d e f g h i"


def test_main_path_runs_no_python(spark, make_docs):
    docs, _, benchmark, _ = odd(spark, make_docs)
    plan = decontaminate.contamination(docs, benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)
