import os

import pytest

FOLDER = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = REPO


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with further columns of clashing names."""

    def build(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or ""), 1.0, "x", 7, "y") for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, score double, "
            "component string, hit_id int, ids string",
        )

    return build
