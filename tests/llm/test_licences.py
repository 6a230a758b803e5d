import math
import re

from barlab.llm import licences


def rows():
    filler = "some words of plain prose that go on and on for a while"
    return [
        ("a/LICENSE", "Released under the MIT License.\n" + filler),
        ("a/x.txt", filler), ("a/b/y.txt", filler),
        ("a/b/c/LICENSE.md", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/c/z.txt", filler), ("a/b/c/d/w.txt", filler + "\nLicensed under CC BY-NC 4.0.\n" + filler),
        ("e/only.txt", filler), ("/abs/COPYING", "Licensed under the Apache License, Version 2.0"),
        ("/abs/f", filler), ("/g", filler), ("top.txt", None), (None, "Released under the MIT License"),
        ("h/big.txt", (filler + "\n") * 5_000 + "RELEASED*** under the MIT&&& license."), ("e/only.txt", filler),
        ("i/n.txt", ""),
    ]


def expected_scores(files):
    """{row: (licence, score)} of the best line, by dense vectors."""
    words = lambda t: [w for w in re.split("[^a-z0-9]+", (t or "").lower()) if w]
    templates = [(n, words(t)) for n, t in licences.TEMPLATES]
    vocabulary = sorted({w for _, t in templates for w in t})
    n = len(files)
    held = {w: sum(w in set(words(t)) for _, t in files) for w in vocabulary}

    def vector(tokens):
        counts = {w: tokens.count(w) for w in vocabulary}
        raw = [
            (1 + math.log(counts[w])) * (1 + math.log((1 + n) / (1 + held[w]))) if counts[w] else 0
            for w in vocabulary
        ]
        size = math.sqrt(sum(x * x for x in raw))
        return [x / size for x in raw] if size else raw

    unit = [(name, vector(t)) for name, t in templates]
    result = []
    for _, text in files:
        best = (0.0, None)
        for line in set(re.split("[\n\r]+", text or "")):
            own = vector(words(line))
            for name, template in unit:
                score = round(sum(x * y for x, y in zip(own, template, strict=True)), 9)
                if score >= licences.LEAST and (-score, name) < (-best[0], best[1] or "~"):
                    best = (score, name)
        result.append((best[1], best[0]))
    return result


def test_headers_files_and_directories(spark):
    files = rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in files], "path string, text string, licence string, score int")
    found = licences.scan(df).collect()
    assert len(found) == len(files)
    own = {(p, l) for (p, _), (l, _) in zip(files, expected_scores(files), strict=True)}
    for r in found:
        if r.origin == "header":
            assert (r.path, r.licence) in own
    by = {r.path: (r.licence, r.origin) for r in found}
    assert by["a/LICENSE"] == ("MIT", "header") and by["a/x.txt"] == ("MIT", "inherited")
    assert by["a/b/y.txt"] == ("MIT", "inherited") and by["a/b/c/z.txt"] == ("GPL-3.0", "inherited")
    assert by["a/b/c/d/w.txt"] == ("CC-BY-NC-4.0", "header") and by["e/only.txt"] == (None, None)
    assert by["/abs/f"] == ("Apache-2.0", "inherited") and by["/g"] == (None, None)
    assert by["top.txt"] == (None, None) and by[None] == ("MIT", "header")
    assert by["h/big.txt"] == ("MIT", "header") and by["i/n.txt"] == (None, None)


def test_scores_equal_dense_vectors(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr(
        "cast(doc_id as string) AS path", "text"
    )
    files = [tuple(r) for r in docs.collect()] + rows()[:8]
    df = spark.createDataFrame(files, "path string, text string")
    best = {}
    for r in licences.licence_lines(df).collect():
        best[r.path] = min(best.get(r.path, (0, "~")), (-r.score, r.licence))
    truth = {p: (-s, l) for (p, _), (l, s) in zip(files, expected_scores(files), strict=True) if l}
    assert best.keys() == truth.keys() and len(truth) > 5
    for path in truth:
        assert best[path][1] == truth[path][1] and abs(best[path][0] - truth[path][0]) < 1e-8


def test_empty_table(spark):
    df = spark.createDataFrame(rows(), "path string, text string").limit(0)
    assert licences.scan(df).collect() == []


def test_main_path_runs_no_python(spark):
    df = spark.createDataFrame(rows(), "path string, text string").repartition(2)
    plan = licences.scan(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_query_keeps_null_and_negative_ids(spark, tmp_path):
    from barlab.llm.queries import QUERIES

    docs = [(None, "Released under the MIT License", "s", "en"), (-7, "plain words", "s", "en"),
            (3, None, None, None), (None, None, "s", None), (-7, "plain words", "s", "en")]
    spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").write.parquet(
        str(tmp_path / "documents.parquet"))
    found = QUERIES["op7_licences"](spark, str(tmp_path)).collect()
    key = lambda i: (i is not None, i or 0)
    assert sorted((r.doc_id for r in found), key=key) == sorted((d[0] for d in docs), key=key)
    assert {r.licence for r in found if r.path == "s/en/-7.txt"} == {"MIT"}
    assert [r.origin for r in found if r.path == "s/en/.txt"] == ["header"]
