"""Interaction of filters that are applied one after another, in every order.

A document is described by the set of filters it fails, its mask. In an order of
the filters, the inverse permutation gives each filter its position; the step at
which a document goes is the smallest position among the filters it fails, which
is the min-plus product of the mask matrix (0 where failed, else infinite) with
the position matrix. Documents of one mask fare alike, so they are counted per
part and mask first, and the product runs over masks times orders. The removal
step then scatters the counts of a mask: to ``removed`` at that step, to
``redundant`` at the later steps of filters it fails too, to ``kept`` at earlier
ones.

Counting combines before the shuffle. At most 2^k masks a part are left for k
filters, and 2^k * k! * k rows of the product, whatever the corpus size; the
product is exploded from the counts and joins nothing. All of it is DataFrame
functions.

Copies: a text is identical to another if the SHA-256 digests are equal. The
first document of a text is found per (text, part) before the parts of a text
meet, so a text that a third of all rows repeat is one row per task there.

Nulls: a null text is an empty one, a null part the empty string. A row without
an id is no copy and has none, and no label. Rows that share an id are documents
of their own; none of them is a copy of another with the same id. Of several
labels of an id, a mark counts if any row has it. A part exists if a document
has it; no documents give no rows. Further columns are not read. Texts of any
length are read whole; their words are held by one task at a time.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPACE = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WEIGHTS = ("documents", "good", "toxic")


def text_conditions(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides."""
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+")
    )
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def with_copies(docs: DataFrame, conditions: dict[str, Column], labels: DataFrame) -> DataFrame:
    """(part, failed, documents, good, toxic): counts per part and set of failed filters.

    ``failed`` maps nothing but the names of ``conditions`` and E, as booleans.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("said"),
        F.struct(*(c.alias(name) for name, c in conditions.items())).alias("failed"),
    )
    rows = slim.groupBy("doc_id", "part", "said", "failed").agg(F.count("*").alias("n"))
    marks = (
        labels.filter("doc_id is not null and (quality = 1 or toxic = 1)")
        .groupBy(F.col("doc_id").cast("long").alias("of"))
        .agg(F.max((F.col("quality") == 1).cast("long")).alias("good"),
             F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    )
    marked = rows.join(marks, rows["doc_id"] == marks["of"], "left").select(
        "doc_id", "part", "said", "failed", F.col("n").alias("documents"),
        *((F.coalesce(F.col(m), F.lit(0)) * F.col("n")).alias(m) for m in ("good", "toxic")),
    )
    named = F.col("doc_id").isNotNull()
    weights = F.struct(*WEIGHTS)
    # Of each (text, part): all rows, and those of its smallest id.
    grouped = marked.groupBy("said", "part", "failed", named.alias("named")).agg(
        *(F.sum(w).alias(w) for w in WEIGHTS),
        F.min(F.when(named, F.struct("doc_id", weights.alias("held")))).alias("first"),
    )
    smallest = F.min("first.doc_id").over(Window.partitionBy("said"))
    judged = grouped.withColumn("leads", F.col("named") & (F.col("first.doc_id") == smallest))
    none = F.struct(*(F.lit(0).cast("long").alias(w) for w in WEIGHTS))
    every = F.struct(*WEIGHTS)
    originals = (
        F.when(~F.col("named"), every).when(F.col("leads"), F.col("first.held")).otherwise(none)
    )
    return (
        judged.withColumn("original", originals)
        .withColumn("split", F.explode(F.array(
            F.struct(F.lit(False).alias("copy"), *(F.col(f"original.{w}").alias(w) for w in WEIGHTS)),
            F.struct(F.lit(True).alias("copy"),
                     *((F.col(w) - F.col(f"original.{w}")).alias(w) for w in WEIGHTS)),
        )))
        .filter("split.documents > 0")
        .withColumn("failed", F.struct(
            *(F.col(f"failed.{name}") for name in conditions), F.col("split.copy").alias("E")
        ))
        .groupBy("part", "failed")
        .agg(*(F.sum(f"split.{w}").alias(w) for w in WEIGHTS))
    )


def orders_of(filters: list[str]) -> Column:
    """An array of all orders, each with the position of every filter from 1."""
    return F.array(*(
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            *(F.lit(order.index(f) + 1).alias(f) for f in filters),
        )
        for order in permutations(filters)
    ))


def audit(counts: DataFrame, filters: list[str]) -> DataFrame:
    """One row per part, order and step, from the counts of masks.

    ``counts`` has part, ``failed`` (a struct of booleans named as the filters,
    one letter each) and the weights.
    """
    after = len(filters) + 1
    failed = {f: F.col(f"failed.{f}") for f in filters}
    position = {f: F.col(f"order.{f}") for f in filters}
    # Infinity is any step after the last.
    removal = F.array_min(F.array(
        *(F.when(failed[f], position[f]).otherwise(after) for f in filters), F.lit(after)
    ))
    alone = sum((c.cast("int") for c in failed.values()), F.lit(0)) == 1
    ranked = counts.withColumn("order", F.explode(orders_of(filters))).select(
        "part", "failed", *WEIGHTS, "order", removal.alias("goes"), alone.alias("alone")
    )
    steps = ranked.withColumn("step", F.explode(F.array(*map(F.lit, range(1, after)))))
    letter = F.substring("order.filter_order", F.col("step"), F.lit(1))
    fails = F.coalesce(*(F.when(letter == f, failed[f]) for f in filters))
    here = F.col("goes") == F.col("step")

    def total(condition: Column, weight: str = "documents") -> Column:
        return F.sum(F.when(condition, F.col(weight)).otherwise(0)).cast("long")

    table = (
        steps.withColumn("filter", letter).withColumn("fails", fails)
        .groupBy("part", F.col("order.filter_order").alias("filter_order"), "step", "filter")
        .agg(
            total(F.col("goes") > F.col("step")).alias("kept"),
            total(here).alias("removed"),
            total(F.col("fails") & (F.col("goes") < F.col("step"))).alias("redundant"),
            total(F.col("fails") & F.col("alone")).alias("unique_fails"),
            total(here, "good").alias("good_lost"),
            total(here, "toxic").alias("toxic_lost"),
        )
    )
    return table.withColumn(
        "shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))
    )
