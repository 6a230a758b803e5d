import os

import pyarrow as pa
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from barlab.llm.oracles import ORACLES
from barlab.llm.queries import QUERIES
from compare import check, duck

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLES) <= set(QUERIES) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert check(spark, duck(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER) == ""


@pytest.mark.parametrize("name", ["op4_pieces", "op7_licences"])
def test_rows_without_sql(spark, documents, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert len(rows) == documents.count()
    if name == "op4_pieces":
        assert all(r.round_trip and len(r.ids) == r.n_ids for r in rows)


def test_pipeline_equals_its_stages_by_brute_force(spark, documents):
    """Every stage against a plain version over its own input."""
    from test_decontaminate import expected as leaks
    from test_near_dup import expected as linked
    from test_pii import expected as personal

    docs, inputs = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs.collect()
        docs = stage(spark, docs, FOLDER)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    last = docs.collect()
    for name in list(inputs)[:4]:
        assert list(inputs[name][0].asDict()) == documents.columns
    texts = {name: {r.doc_id: r.text for r in rows} for name, rows in inputs.items()}
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    gone = texts["quality"].keys() - texts["near_duplicates"].keys()
    good = [i for i, r in labels.items() if r.quality and not r.toxic]
    assert sum(i in gone for i in good) <= 0.03 * len(good)
    assert gone
    truth = linked(list(texts["near_duplicates"].items()), 5)
    assert texts["decontamination"].keys() == {i for i, c in truth.items() if i == c}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {r[0] for r in leaks(list(texts["decontamination"].items()), items) if r[5]}
    assert texts["personal_data"].keys() == texts["decontamination"].keys() - dirty
    for i, text in texts["personal_data"].items():
        if not personal(text):
            assert texts["pieces"][i] == text
        else:
            assert not [p for p in personal(texts["pieces"][i]) if p[1] < 2]
    assert {r.doc_id for r in last} == texts["personal_data"].keys()
    assert all(r.round_trip and r.n_chars == len(texts["pieces"][r.doc_id]) for r in last)


def test_pipeline_over_odd_and_empty_tables(spark, documents, tmp_path):
    """Null and repeated ids, null and empty texts, further columns; then no rows at all."""
    rows = [(None, None), (None, ""), (3, "some words of plain prose"), (3, "some words of plain prose"),
            (-4, "x " * 50_000), (5, None)]
    odd = spark.createDataFrame(
        [(i, t, None, "s", None, 1.0) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, ids double",
    )
    for name, docs in (("odd", odd), ("empty", odd.limit(0))):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
            f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(
            f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, folder).collect()
        assert len(found) <= docs.count() and all(r.ids is None or len(r.ids) == r.n_ids for r in found)
        for stage in corpus_pipeline.STAGES[1:4]:
            kept = stage[1](spark, docs, folder)
            assert kept.columns == docs.columns and kept.count() == docs.dropDuplicates().count() + (
                stage[0] != "near_duplicates" and name == "odd")


def test_stages_pass_on_small_batches(spark, documents):
    """Tens of MB of texts at a time are held at both ends of each task."""

    def sizes(spark, docs, folder):
        return docs.mapInArrow(
            lambda batches: (b.slice(0, 1).set_column(0, "id", pa.array([len(b)])) for b in batches),
            "id long",
        )

    key, rows = corpus_pipeline.BATCH_KEY, spark.range(0, 3_000, 1, 1)
    try:
        for before, most in (("10000", corpus_pipeline.ROWS_A_BATCH), ("0", corpus_pipeline.ROWS_A_BATCH),
                             ("70", 70)):
            spark.conf.set(key, before)
            found = corpus_pipeline.in_small_batches(sizes)(spark, rows, "").collect()
            assert max(r.id for r in found) == most and sum(r.id for r in found) == 3_000
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(key, "10000")
            stage(spark, documents.limit(0), FOLDER)
            assert int(spark.conf.get(key)) == corpus_pipeline.ROWS_A_BATCH
    finally:
        spark.conf.unset(key)


def test_library_does_not_need_the_corpus_operators():
    root = os.path.dirname(driver.__file__)
    for folder, _, files in os.walk(os.path.join(root, "barlab")):
        if os.path.basename(folder) == "llm":
            continue
        for file in files:
            if file.endswith(".py"):
                with open(os.path.join(folder, file)) as source:
                    assert "llm" not in source.read()
