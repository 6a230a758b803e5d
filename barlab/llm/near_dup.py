"""Near-duplicate documents by bottom-k sketches of one hash function.

1. A task hashes the word shingles of each text and keeps the ``k`` smallest
   values, the sketch. Texts with equal shingle sets form a class at once; one
   text per class, that of the smallest id, goes on.
2. Inverted lists. If two sets reach the similarity, their sketches share at
   least ``_needed`` values, so they share one among the few rarest values of
   each. Only those values are listed; a value that very many documents hold is
   rare in no ordinary document and is listed for none. Nothing is dropped:
   any order of the values keeps all pairs, and this one keeps the lists short.
3. A pair that meets in a list is estimated from the union of its sketches:
   each sketch is folded into ``BITS`` bits, and more differing bits than the
   similarity allows rule the pair out. The bits never differ in more places
   than the sketches do, so no similar pair is lost.
4. Stars. In each list the members are compared with the most central one, which
   holds the most widely held values. A group of copies so costs one comparison
   a member, not one a pair.
5. What is not connected then is compared with the rest of its lists: in short
   lists pair by pair, in crowded lists and with large components in cells of two
   blocks, with an inverted index of the full sets in each cell. Cells send on
   only what connects, so no group emits its pairs.
6. Every link is confirmed on the full shingle sets (64-bit hashes of all
   shingles) by ``100 * intersection >= percent * union``. Full sets are made of
   the documents that stars, pairs and cells compare, of no others.

A wrong answer needs a linked pair whose sketch overlap falls ``SIGMAS``
standard deviations below its mean (about 2 in 10 million by the exact binomial
for pairs right at the limit and ``k`` 128), in every list chain that connects the two documents.

Nulls: a null or empty text, or one without words, has an empty set and no
links. A row with a null id is kept and linked with nothing (its component is
null). Ids name documents: rows that share an id are one node, linked if any of
their texts is, and joined with all classes their texts are in. ``copies`` takes texts
as nodes instead: it tells which rows go so that one text of each group stays. An
empty table gives an empty one; further columns are not read. Texts of any length
are read whole; the set of a text is held by one task. Of equally central members
of a list the smaller number counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import (
    WordHashes, ascii_words, batch_of, components, list_array, longs, map_batches, mix, pair_hash,
    text_bytes,
)

SIGMAS = 5.5
BITS = 256
# Components and lists from this size on are compared in blocks, of about so many
# documents for components, and of so many shingles (8 bytes each) for lists.
LARGE = 64
BLOCK_DOCS = 512
CROWD_SHINGLES = 1_000_000
# Ids of compared documents are broadcast up to so many (about 80 MB in memory).
BROADCAST_ROWS = 2_000_000


def shingle_hashes(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words are one run."""
    if not words:
        return np.empty(0, np.uint64)
    single = hashes.of(words)
    size = min(size, len(words))
    run = mix(single)
    for step in range(1, size):
        run = pair_hash(run[:-1], single[step:])
    return np.unique(run)


def text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def sketches(docs: DataFrame, size: int, k: int, id_column: str = "doc_id") -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, set_key (equal for equal sets), sketch, bits.

    ``bits`` has the place of each sketch value modulo ``BITS`` set.
    """

    def rows():
        hashes = WordHashes()
        from hashlib import blake2b

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, keys, kept, bits = [], [], [], []
            for text in batch.column(2).to_pylist():
                values = shingle_hashes(ascii_words(text and text.lower()), size, hashes)
                counts.append(len(values))
                keys.append(blake2b(values.tobytes(), digest_size=16).digest())
                kept.append(values[:k].view(np.int64))
                marks = np.zeros(BITS, bool)
                marks[values[:k] % np.uint64(BITS)] = True
                bits.append(np.packbits(marks).view(np.int64))
            return batch_of(
                doc_id=batch.column(0), text_hash=batch.column(1), n_shingles=longs(counts),
                set_key=pa.array(keys, pa.binary()), sketch=list_array(kept, pa.int64()),
                bits=list_array(bits, pa.int64()),
            )

        return apply

    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), text_hash().alias("text_hash"),
        text_bytes().alias("text"),
    )
    return map_batches(
        source, rows, "doc_id long, text_hash long, n_shingles long, set_key binary, sketch array<long>, "
        "bits array<long>"
    )


def _needed(n: Column, k: int, similarity: float) -> Column:
    """Values that the sketches of two similar sets share at least, given one set's size."""
    # The union is at most so large, and the sketch of a small union is most of it.
    union = n / similarity
    left = F.greatest(union - k, F.lit(0)) / F.greatest(union - 1, F.lit(1))
    spread = SIGMAS * F.sqrt(left * (similarity * (1 - similarity) * k))
    whole = F.ceil(n * similarity - 1e-9)          # both sketches hold their whole sets
    part = F.ceil(F.least(n, F.lit(k)) * similarity - spread - 1e-9)
    return F.greatest(F.when(n <= int(k * similarity), whole).otherwise(part), F.lit(1))


def _lists(units: DataFrame, k: int, similarity: float) -> DataFrame:
    """(value, doc, held) for the rarest values of each sketch that others hold too.

    ``held`` sums up how widely the document's shared values are held.
    """
    listed = units.select("doc", F.explode("sketch").alias("value"))
    common = (
        listed.groupBy("value").agg(F.count("*").alias("holders")).filter("holders > 1")
    )
    of_doc = Window.partitionBy("doc")
    placed = listed.join(common, "value").select(
        "value", "doc",
        F.row_number().over(of_doc.orderBy("holders", "value")).alias("nth"),
        F.count("*").over(of_doc).alias("shared"),
        F.sum("holders").over(of_doc).alias("held"),
    )
    bound = units.select(
        F.col("doc").alias("of"), F.size("sketch").alias("kept"),
        (F.size("sketch") - _needed(F.col("n"), k, similarity) + 1).alias("last"),
    )
    # Values that no other sketch holds come first; they need no list.
    return placed.join(bound, placed["doc"] == bound["of"]).filter(
        F.col("kept") - F.col("shared") + F.col("nth") <= F.col("last")
    ).select("value", "doc", "held")


def _possible(one: str, other: str, k: int, percent: int) -> Column:
    """Whether sizes and folded sketches leave the similarity possible.

    The arguments name structs with n, needed, kept and bits.
    """
    n, m = F.col(f"{one}.n"), F.col(f"{other}.n")
    differing = F.lit(0)
    for i in range(BITS // 64):
        differing = differing + F.bit_count(
            F.col(f"{one}.bits")[i].bitwiseXOR(F.col(f"{other}.bits")[i])
        )
    needed = F.greatest(F.col(f"{one}.needed"), F.col(f"{other}.needed"))
    most = F.col(f"{one}.kept") + F.col(f"{other}.kept") - 2 * needed
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (differing <= most)


def _similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= percent * (len(left) + len(right) - common)


def _confirm(percent: int):
    """Keeps the pairs whose full shingle sets are similar enough."""

    def rows():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            a, b, left, right = batch.columns
            keep = [
                _similar(x.values.to_numpy(), y.values.to_numpy(), percent)
                for x, y in zip(left, right, strict=True)
            ]
            return batch_of(a=a, b=b).filter(pa.array(keep, pa.bool_()))

        return apply

    return rows


class _Sets:
    """An inverted index of the full sets of some documents."""

    def __init__(self, sets: list[np.ndarray]):
        values = np.concatenate(sets)
        self.sizes = np.array([len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        self.values = values[order]
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def near(self, own: np.ndarray, percent: int) -> np.ndarray:
        """Numbers of the documents whose sets are similar enough to ``own``."""
        low = np.searchsorted(self.values, own, "left")
        runs = np.searchsorted(self.values, own, "right") - low
        at = np.repeat(low - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= percent * (self.sizes + len(own) - common))


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [x.values.to_numpy() for x in column]


def _against_block(percent: int):
    """Links between outside documents and the members of one block of a component."""

    def links(members: pa.Table, asked: pa.Table) -> pa.Table:
        a, b = [], []
        if len(members) and len(asked):
            index = _Sets(_arrays(members.column("shingles")))
            names = members.column("doc").to_numpy()
            for doc, own in zip(
                asked.column("asker").to_pylist(), _arrays(asked.column("wanted")), strict=True
            ):
                near = names[index.near(own, percent)]
                if len(near):  # the members are connected, so one link to them says it all
                    a.append(doc)
                    b.append(int(near.min()))
        return pa.table({"a": longs(a), "b": longs(b)})

    return links


def _within_cell(percent: int):
    """Links that connect what is similar in a cell, one fewer than it connects at most."""

    def links(cell: pa.Table) -> pa.Table:
        sets, names = _arrays(cell.column("shingles")), cell.column("doc").to_pylist()
        index = _Sets(sets)
        group = list(range(len(sets)))

        def first(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        a, b = [], []
        for i, own in enumerate(sets):
            for j in index.near(own, percent).tolist():
                x, y = first(i), first(j)
                if x != y:
                    group[max(x, y)] = min(x, y)
                    a.append(names[i])
                    b.append(names[j])
        return pa.table({"a": longs(a), "b": longs(b)})

    return links


def class_table(docs: DataFrame, size: int, k: int) -> DataFrame:
    """The sketches of all rows, written once."""
    return written(sketches(docs, size, k), "sketches")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, k: int = 128
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Rows are linked if ``100 * intersection >= percent * union`` of their sets
    of ``shingle_words``-word runs; ``component_id`` is the smallest id that
    links lead to.
    """
    rows, units, links = _graph(docs, shingle_words, percent, k)
    named = rows.filter("doc_id is not null")
    classes = units.select("set_key", F.col("id").alias("least"))
    # Ids are the nodes: links join those of two classes, and an id the classes it appears in.
    several = (
        named.groupBy("doc_id").agg(
            F.min(F.xxhash64("set_key")).alias("low"), F.max(F.xxhash64("set_key")).alias("high")
        ).filter("low <> high").select(F.col("doc_id").alias("of"))
    )
    meant = named.join(several, named["doc_id"] == several["of"]).join(classes, "set_key").select(
        F.col("doc_id").alias("a"), F.col("least").alias("b")
    )
    ids = units.select(F.col("doc").alias("unit"), "id")
    edges = (
        links.join(ids.toDF("a", "one"), "a").join(ids.toDF("b", "other"), "b")
        .select(F.col("one").alias("a"), F.col("other").alias("b"))
    )
    joined = components(edges.union(meant))
    found = classes.join(joined, classes["least"] == joined["node"], "left").select(
        "set_key", F.coalesce("component", "least").alias("component_id")
    )
    columns = ("doc_id", "n_shingles", "component_id")
    with_sets = rows.filter("n_shingles > 0").join(found, "set_key", "left").select(*columns)
    # Empty sets are linked with nothing, but their ids may have other texts.
    empty = rows.filter("n_shingles = 0").join(
        joined, F.col("doc_id") == joined["node"], "left"
    ).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    return with_sets.union(empty).withColumn(
        "component_id",
        F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component_id")), "doc_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _graph(docs: DataFrame, size: int, percent: int, k: int):
    """The sketches of all rows, one unit per class, and links (a, b) of units.

    A unit has a number ``doc`` and the smallest ``id`` that its class has.
    """
    rows = class_table(docs, size, k)
    classes = (
        rows.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("set_key").agg(F.min("doc_id").alias("id"))
    )
    # The id is part of the key, so a class of very many copies meets in no single task.
    units = written(
        rows.withColumnRenamed("doc_id", "id").join(classes, ["set_key", "id"])
        .select("set_key", "id", F.col("n_shingles").alias("n"), "sketch", "bits")
        .dropDuplicates(["set_key", "id"])
        .withColumn("doc", F.monotonically_increasing_id()),
        "units",
    )
    return rows, units, _links(docs, units, size, percent, k)


def copies(
    docs: DataFrame, shingle_words: int = 5, percent: int = 80, k: int = 128
) -> tuple[DataFrame, DataFrame]:
    """What goes so that one row of each group of linked texts stays.

    The first table, (gone_id, gone_hash), names rows that go. The second,
    (once_id, once_hash), names equal rows that share an id, of which one stays.
    Texts are the nodes here, so one text of an id may go and another stay. Rows
    without an id or words stay.
    """
    rows, units, links = _graph(docs, shingle_words, percent, k)
    joined = components(written(links, "text-links"), "text-components")
    grouped = units.join(joined, units["doc"] == joined["node"], "left").select(
        "set_key", "id", F.coalesce("component", "doc").alias("component")
    )
    kept = grouped.groupBy("component").agg(
        F.min(F.struct("id", "set_key")).alias("kept")
    ).select(F.col("kept.set_key").alias("set_key"), F.col("kept.id").alias("doc_id"))
    texts = (
        rows.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("set_key", "doc_id", "text_hash").agg(F.count("*").alias("times"))
    )
    # Of texts with equal sets in the kept class and id, that with the smallest hash stays.
    stays = texts.join(kept, ["set_key", "doc_id"]).groupBy("set_key", "doc_id").agg(
        F.min("text_hash").alias("first")
    )
    marked = written(
        texts.join(stays, ["set_key", "doc_id"], "left").select(
            "doc_id", "text_hash", "times",
            F.coalesce(F.col("text_hash") == F.col("first"), F.lit(False)).alias("stays"),
        ).filter("not stays or times > 1"),
        "copies",
    )
    return (
        marked.filter("not stays").select(
            F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")
        ),
        marked.filter("stays").select(
            F.col("doc_id").alias("once_id"), F.col("text_hash").alias("once_hash")
        ),
    )


def _shingles(docs: DataFrame, listed: DataFrame, size: int) -> DataFrame:
    """(doc, shingles): the full sets, sorted, of the listed units (doc, id, set_key)."""

    def rows():
        from hashlib import blake2b

        hashes = WordHashes()

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, own = [], []
            for text, key in zip(
                batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                values = shingle_hashes(ascii_words(text and text.lower()), size, hashes)
                # An id may have other texts, which are other units.
                own.append(blake2b(values.tobytes(), digest_size=16).digest() == key)
                found.append(np.sort(values.view(np.int64)))
            return batch_of(
                doc=batch.column(0), shingles=list_array(found, pa.int64()),
            ).filter(pa.array(own, pa.bool_()))

        return apply

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_bytes().alias("text"))
    ids = listed.select("id").distinct()
    if ids.count() <= BROADCAST_ROWS:
        # Only texts that are compared are moved to the join.
        texts = texts.join(F.broadcast(ids), "id", "left_semi")
    return map_batches(
        texts.join(listed, "id").select("doc", "text", "set_key"), rows,
        "doc long, shingles array<long>",
    )


def _links(docs: DataFrame, units: DataFrame, size: int, percent: int, k: int) -> DataFrame:
    """(a, b): enough confirmed links to connect all that links connect."""
    similarity = percent / 100
    lists = written(_lists(units, k, similarity), "lists")
    several = lists.groupBy("value").agg(
        F.max_by("doc", F.struct("held", -F.col("doc"))).alias("centre"),
        F.count("*").alias("members"),
    ).filter("members > 1").drop("members")
    outline = units.select(F.col("doc").alias("of"), F.struct(
        "n", F.size("sketch").alias("kept"),
        _needed(F.col("n"), k, similarity).cast("int").alias("needed"), "bits",
    ).alias("outline"))
    met = lists.select("value", "doc").join(several, "value").filter("doc <> centre").select(
        F.col("centre").alias("a"), F.col("doc").alias("b")
    ).distinct()
    x = outline.select(F.col("of").alias("a"), F.col("outline").alias("x"))
    y = outline.select(F.col("of").alias("b"), F.col("outline").alias("y"))
    stars = written(
        met.join(x, "a").join(y, "b").filter(_possible("x", "y", k, percent)).select("a", "b"),
        "stars",
    )
    def full_sets(wanted: DataFrame, label: str) -> DataFrame:
        """The full sets of documents (doc), which are compared; no others are made."""
        named = written(wanted.distinct().join(units.select("doc", "id", "set_key"), "doc"), label)
        return written(_shingles(docs, named, size), f"{label}-sets")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("doc")).union(pairs.select("b"))

    def confirmed(pairs: DataFrame, sets: DataFrame, label: str) -> DataFrame:
        left = _sets_of(sets, pairs, "a").toDF("a", "left")
        right = _sets_of(sets, pairs, "b").toDF("b", "right")
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
        return written(map_batches(both, _confirm(percent), "a long, b long"), label)

    sets = full_sets(ends(stars), "starred")
    links = confirmed(stars, sets, "star-links")
    joined = components(links)
    labelled = lists.select("value", "doc").join(several, "value").join(
        joined, F.col("doc") == joined["node"], "left"
    ).select("value", "doc", "centre", F.coalesce("component", "doc").alias("component"))
    split = (
        labelled.groupBy("value")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high").select("value")
    )
    sizes = joined.groupBy("component").agg(F.count("*").alias("docs")).filter(
        F.col("docs") >= LARGE
    )
    still = written(
        labelled.join(split, "value").join(sizes, "component", "left")
        .join(outline, F.col("doc") == outline["of"])
        .select("value", "doc", "centre", "component", "docs", "outline"),
        "open-lists",
    )
    small = still.filter("docs is null")
    crowded = small.groupBy("value").agg(F.count("*").alias("crowd")).filter(
        F.col("crowd") >= LARGE
    )
    crowds = written(
        small.join(crowded, "value").select("centre", "doc", F.col("outline.n").alias("n")).distinct(),
        "crowds",
    )
    small = small.join(crowded, "value", "left_anti")
    one, other = small.alias("one"), small.alias("other")
    pairs = written(one.join(
        other,
        (F.col("one.value") == F.col("other.value")) & (F.col("one.doc") < F.col("other.doc"))
        & (F.col("one.component") != F.col("other.component"))
        & _possible("one.outline", "other.outline", k, percent),
    ).select(F.col("one.doc").alias("a"), F.col("other.doc").alias("b")).distinct(), "small-pairs")
    wanted = written(_asked_of_large(still), "asked")
    # Members of large components are in stars.
    more = ends(pairs).union(crowds.select("doc")).union(wanted.select("doc")).join(
        sets.select("doc"), "doc", "left_anti"
    )
    sets = sets.union(full_sets(more, "further"))
    links = links.union(confirmed(pairs, sets, "small-links"))
    links = links.union(written(_crowd_links(crowds, sets, percent), "crowd-links"))
    return links.union(written(_large_links(wanted, joined, sets, percent), "large-links"))


def _numbers(upto: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), upto - 1))


def _crowd_links(crowds: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the members of crowded lists, which have their lists' centre in common."""
    blocks = crowds.groupBy("centre").agg(
        (F.floor(F.sum("n") / CROWD_SHINGLES) + 1).alias("blocks")
    )
    dealt = crowds.join(blocks, "centre").select(
        "centre", "doc", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("own"),
        _numbers(F.col("blocks")).alias("other"),
    )
    # Every two blocks of a crowd meet in one cell.
    cells = dealt.join(_sets_of(sets, crowds, "doc"), "doc").select(
        "centre", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "doc", "shingles",
    )
    return cells.groupBy("centre", "low", "high").applyInArrow(
        _within_cell(percent), "a long, b long"
    )


def _sets_of(sets: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """(doc, shingles) of the documents in a column, so that no others are moved."""
    meant = rows.select(F.col(column).alias("doc")).distinct()
    return sets.join(meant, "doc", "left_semi").select("doc", "shingles")


def _asked_of_large(still: DataFrame) -> DataFrame:
    """(component, docs, doc): the large components, and members of their lists outside.

    Of two large components the members of the smaller one are looked up in the
    blocks of the larger one.
    """
    large = still.filter("docs is not null").groupBy("value", "component").agg(
        F.max("docs").alias("docs")
    )
    outside = still.select("value", "doc", F.col("component").alias("own"), "docs")
    size = F.coalesce(F.col("o.docs"), F.lit(0))
    return large.alias("l").join(
        outside.alias("o"),
        (F.col("l.value") == F.col("o.value"))
        & (F.struct(F.col("l.docs"), F.col("l.component")) > F.struct(size, F.col("o.own"))),
    ).select("l.component", "l.docs", "o.doc").distinct()


def _large_links(
    wanted: DataFrame, joined: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links from the large components to the documents asked of them."""
    # Blocks of members meet packs of askers, so a cell is bounded on both sides.
    parts = F.floor(F.col("docs") / BLOCK_DOCS) + 1
    packs = wanted.groupBy("component").agg(
        (F.floor(F.count("*") / BLOCK_DOCS) + 1).alias("packs")
    )

    asked = wanted.join(packs, "component").select(
        "component", _numbers(parts).alias("part"),
        F.pmod(F.xxhash64("doc"), F.col("packs")).alias("pack"), "doc",
    ).join(_sets_of(sets, wanted, "doc"), "doc").select(
        "component", "part", "pack", F.col("doc").alias("asker"),
        F.col("shingles").alias("wanted"),
    ).toDF("to", "of_part", "of_pack", "asker", "wanted")
    sizes = wanted.groupBy("component").agg(F.max("docs").alias("docs"))
    inside = written(
        joined.join(sizes, "component").select("component", "docs", F.col("node").alias("doc")),
        "large-members",
    )
    members = inside.join(packs, "component").select(
        "component", F.pmod(F.xxhash64("doc"), parts).alias("part"),
        _numbers(F.col("packs")).alias("pack"), "doc",
    ).join(_sets_of(sets, inside, "doc"), "doc").select("component", "part", "pack", "doc", "shingles")
    return members.groupBy("component", "part", "pack").cogroup(
        asked.groupBy("to", "of_part", "of_pack")
    ).applyInArrow(_against_block(percent), "a long, b long")
