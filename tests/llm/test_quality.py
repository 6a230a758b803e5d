import numpy as np
import pytest

from barlab.llm import quality


def test_gradient_and_order_of_thresholds():
    random = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(600):
        x = int(random.integers(0, 4))
        rows.append((np.array([x]), np.array([1.0])))
        grades.append(min(3, max(0, x + int(random.integers(-1, 2)))))
    model = quality.fit(rows, np.array(grades))
    assert np.all(np.diff(model.thresholds) > 0)
    assert np.all(np.diff(model.weights[:4]) > 0)
    tails = model.tails(model.weights[:4])
    for x in range(4):
        own = np.array([g for (i, _), g in zip(rows, grades, strict=True) if i[0] == x])
        assert abs(tails[x].sum() - own.mean()) < 0.35


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    grades = quality.composed_grades(spark.read.parquet(f"{folder}/labels.parquet"))
    model = quality.train(docs, grades.filter("doc_id % 2 = 0"))
    rated = grades.filter("doc_id % 2 = 1")
    rows = quality.grade(docs.join(rated.select("doc_id"), "doc_id"), model).join(
        rated, "doc_id"
    ).collect()
    right = np.mean([r.selected == (r.grade >= 1) for r in rows])
    clean = np.mean([r.selected for r in rows if r.grade >= 1])
    bad = np.mean([not r.selected for r in rows if r.grade == 0])
    assert right > 0.97 and clean > 0.98 and bad > 0.9
    means = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]


def test_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "good text " * 30), (4, "b@d*** " * 30), (None, "good"), (3, "x"),
            (5, "w " * 200_000)]
    docs = make_docs(rows)
    ratings = spark.createDataFrame(
        [(3, 1), (4, 0), (None, 1), (1, None), (4, 0), (99, 1)], "doc_id long, grade int"
    )
    model = quality.train(docs, ratings)
    graded = quality.grade(docs, model).collect()
    assert len(graded) == len(rows) and all(0 <= r.expected_grade <= 1 for r in graded)
    kept = quality.select_rows(docs, model)
    assert kept.columns == docs.columns
    assert {r.text for r in kept.collect()} >= {"good text " * 30}
    assert quality.select_rows(docs.limit(0), model).collect() == []
    empty = quality.train(docs, ratings.limit(0))
    assert quality.grade(docs, empty).count() == len(rows)


@pytest.mark.parametrize("quality_mark, toxic, grade", [
    (0, 0, 0), (0, 1, 0), (1, 1, 1), (1, 0, 2), (None, 0, None), (1, None, None),
])
def test_composed_grades(spark, quality_mark, toxic, grade):
    labels = spark.createDataFrame([(1, quality_mark, toxic)], "doc_id long, quality int, toxic int")
    assert quality.composed_grades(labels).first().grade == grade


def loss(model_rows, grades, weights, thresholds):
    """Mean negative log-likelihood of the grades, by the formula of the model."""
    total = 0.0
    for (index, value), grade in zip(model_rows, grades, strict=True):
        tails = [1.0, *(1 / (1 + np.exp(-(weights[index] @ value - t))) for t in thresholds), 0.0]
        total -= np.log(tails[grade] - tails[grade + 1])
    return total / len(grades)


def test_fit_is_where_the_likelihood_has_no_slope():
    """Numeric slopes of the likelihood, written out, vanish at the fitted parameters."""
    random = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(300):
        x = random.integers(0, 5, 2)
        rows.append((x, np.array([0.5, 0.5])))
        grades.append(int(np.clip(x.mean() / 2 + random.normal(), 0, 2)))
    model = quality.fit(rows, np.array(grades), steps=3_000, penalty=0.0, rate=0.02)
    best = loss(rows, grades, model.weights, model.thresholds)
    for place in range(5):
        for step in (1e-3, -1e-3):
            moved = model.weights.copy()
            moved[place] += step
            assert abs(loss(rows, grades, moved, model.thresholds) - best) < 2e-6
    for place in range(2):
        moved = model.thresholds.copy()
        moved[place] += 1e-3
        assert abs(loss(rows, grades, model.weights, moved) - best) < 2e-6


@pytest.mark.parametrize("labels", [
    [], [(1, 0, 0), (2, 1, 1)], [(1, 0, 0)], [(None, 1, 0), (1, None, 0), (2, 1, None)], [(1, 1, 0)],
])
def test_query_with_labels_that_lack_grades(spark, tmp_path, labels):
    from barlab.llm.queries import QUERIES

    docs = [(1, "some words"), (2, "Other words, here."), (None, "no id"), (-5, None), (2, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    rows = QUERIES["op9_quality"](spark, str(tmp_path)).collect()
    assert len(rows) == len(docs)
    assert all(1 >= r.p_good >= r.p_best >= 0 for r in rows)
