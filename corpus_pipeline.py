"""The corpus pipeline: quality, near duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
to the shared folder and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.

All stages read whole texts and take rows as they are: null and repeated ids, null
and empty texts, further columns of any name, and empty tables, which stay empty.
A null or empty text is graded like any other, has no near duplicate, no benchmark
window and no personal data, and a null one has null ids of pieces.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import decontaminate, near_dup, pieces, pii, quality
from barlab.llm.common import table
from barlab.session import fresh_dir, scratch

# Dropped ids are broadcast up to so many (about 80 MB in memory), else shuffled.
BROADCAST_ROWS = 2_000_000
# Words a worker remembers in the last stage, when it still holds what earlier ones left it.
REMEMBERED_WORDS = 80_000
# Rows that an executor and its Python workers pass on at a time; more are only held longer.
ROWS_A_BATCH = 500
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(stage):
    """The stage with batches of at most ``ROWS_A_BATCH`` rows, also while its result is read.

    Spark's own batches hold 10,000 rows, that is tens of MB of texts at both ends of each
    task. Groups that a function gets as one table stay whole.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        set_rows = int(spark.conf.get(BATCH_KEY))
        if not 0 < set_rows <= ROWS_A_BATCH:
            spark.conf.set(BATCH_KEY, str(ROWS_A_BATCH))
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of at least grade 1; the model is fitted on the labelled ones.

    Without labels every grade is as likely as the thresholds' first values say. A
    probability of exactly the limit keeps a row.
    """
    ratings = quality.composed_grades(table(spark, sf_dir, "labels"))
    return quality.select_rows(docs, quality.train(docs, ratings, grades=3))


@in_small_batches
def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of each group of near duplicate texts.

    Equal rows are one; of texts with equal sets and ids the smallest hash stays.
    Rows without an id or words stay.
    """
    gone, once = near_dup.copies(docs, shingle_words=5, percent=80)
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    row = (F.col("doc_id").cast("long"), near_dup.text_hash())
    keyed = docs.withColumn("of_id", row[0]).withColumn("of_hash", row[1])
    left = keyed.join(
        gone, (F.col("of_id") == gone["gone_id"]) & (F.col("of_hash") == gone["gone_hash"]),
        "left_anti",
    )
    if once.isEmpty():
        return left.drop("of_id", "of_hash")
    same = (F.col("of_id") == once["once_id"]) & (F.col("of_hash") == once["once_hash"])
    repeated = left.join(once, same, "left_semi").dropDuplicates(["of_id", "of_hash"])
    return left.join(once, same, "left_anti").union(repeated).drop("of_id", "of_hash")


@in_small_batches
def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; an empty benchmark removes none."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind.

    ``n_chars`` is that of the new text, and stays for a null one. Spans that
    overlap are replaced as one, by the kind of the first.
    """
    redacted = pii.redact(docs)
    return redacted.withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))
    )


@in_small_batches
def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and whether they decode to its text."""
    decoded = pieces.encode(docs, with_decoded=True, remembered=REMEMBERED_WORDS)
    return decoded.select(
        "doc_id", "lang", "source", "n_chars", "ids", F.size("ids").alias("n_ids"),
        F.col("decoded").eqNullSafe(pieces.normalised(F.col("text"))).alias("round_trip"),
    )


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_unleaked),
    ("personal_data", redact_personal),
    ("pieces", to_pieces),
]

# Trained models, links and a token search have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, f"stage-{name}")
        with scratch(spark, f"scratch-{name}"):  # what the stage writes for itself goes with it
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
            schema = result.schema
        docs = spark.read.schema(schema).parquet(path)
    return docs
