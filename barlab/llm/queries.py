"""The named queries over the corpus tables, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from . import (
    ann, decontaminate, filter_audit, licences, near_dup, pages, pieces, pii, quality,
    substring_dedup, token_files, toxicity, trie,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op3_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(
        table(spark, folder, "documents"), shingle_words=2, percent=80
    )


@query
def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


@query
def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text back."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    decoded = pieces.encode(docs, with_decoded=True)
    return decoded.select(
        "doc_id", "ids", F.size("ids").alias("n_ids"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(pieces.normalised(F.col("text"))).alias("round_trip"),
    )


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs, model, least=0.7)


@query
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        pii.spelled(F.concat("spans", "found")).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )


@query
def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id.txt``, a null id as ``source/lang/.txt``."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(".txt"))
    path = F.concat_ws("/", "source", "lang", name)
    files = table(spark, folder, "documents").select("doc_id", path.alias("path"), "text")
    return licences.scan(files, keep=("doc_id",)).select(
        "doc_id", "path", "licence", "origin", "score", "licence_file"
    )


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"), length=50)


@query
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities of at least grade 1 and 2, from the two marks of a label."""
    docs = table(spark, folder, "documents")
    model = quality.train(docs, quality.composed_grades(table(spark, folder, "labels")), grades=3)
    return quality.grade(docs, model).select(
        "doc_id", "expected_grade", F.col("tails")[0].alias("p_good"),
        F.col("tails")[1].alias("p_best"), "selected",
    )


@query
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ).drop("text_hash")


@query
def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Written to a new folder of files, and read back from them."""
    import public_tokenizers

    path = fresh_dir(spark, "token-files")
    token_files.write(
        table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json")
    )
    return token_files.read(spark, path).select(
        "doc_id", "start", (F.length("tokens") / 4).cast("long").alias("n_tokens"),
        F.crc32("tokens").alias("ids_crc32"),
    )


@query
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Filters A to E in all 120 orders, per language."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counts = filter_audit.with_copies(
        table(spark, folder, "documents"), filter_audit.text_conditions(text),
        table(spark, folder, "labels"),
    )
    return filter_audit.audit(counts, list("ABCDE")).drop("filter")


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))
