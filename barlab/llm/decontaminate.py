"""Benchmark decontamination with DataFrame functions only.

The word windows of the benchmark items are kept as a hash set. A window of
``w`` words always holds one whole block of ``b = (w + 1) / 2`` words that
starts at a multiple of ``w - b + 1``, so only those aligned blocks of a
document are hashed and looked up: one position in six for ten words. Around
each block found, and nowhere else, the windows are built and joined with the
items' windows as strings, which verifies them.

The set of block hashes is broadcast up to ``BROADCAST_ROWS`` rows, and so are
the keys of documents with a block found; beyond that Spark shuffles them.

Nulls: a null or empty text has no words and no hits; a benchmark item without
words has no window. Rows are told apart by id and text, so rows with a null or
repeated id get their own results, and repeated rows get equal ones. Items are
listed in the order of their ids as strings; items of one id are one. Empty tables
give empty ones, or no hits; further columns are not read, and those of documents
stay where documents are returned. Texts of any length are read whole, by one task
each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written

WINDOW = 10
# At about 40 bytes a row in memory, 80 MB at most.
BROADCAST_ROWS = 2_000_000

# What separates words, in ASCII.
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; ``translate`` is slow, and plain ASCII texts need only ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def words_of(text: Column) -> Column:
    return F.coalesce(
        F.array_remove(F.split(ascii_lower(text), _SEPARATORS), ""), F.array().cast("array<string>")
    )


def _block(width: int) -> int:
    return (width + 1) // 2


def _stride(width: int) -> int:
    return width - _block(width) + 1


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, width, gram): the windows of each item, as words joined by a space."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words"))
    sized = words.filter(F.size("words") > 0).withColumn(
        "width", F.least(F.size("words"), F.lit(window))
    )
    starts = F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)
    return sized.select("item_id", "width", "words", F.explode(starts).alias("start")).select(
        "item_id", "width",
        F.array_join(F.slice("words", F.col("start"), F.col("width")), " ").alias("gram"),
    ).distinct()


def _item_blocks(windows: DataFrame, width: int) -> DataFrame:
    """Hashes of all runs of a block's length in the windows of one width."""
    size = _block(width)
    words = windows.filter(F.col("width") == width).select(F.split("gram", " ").alias("words"))
    return words.select(
        F.explode(F.transform(
            F.sequence(F.lit(1), F.lit(width - size + 1)),
            lambda i: F.xxhash64(F.slice("words", i, size)),
        )).alias("block")
    ).distinct()


def _aligned(width: int) -> Column:
    """Hashes of a document's aligned blocks, in order."""
    size, stride = _block(width), _stride(width)
    count = F.size("words")
    return F.when(
        count >= width,
        F.transform(
            F.sequence(F.lit(1), count - size + 1, F.lit(stride)),
            lambda i: F.xxhash64(F.slice("words", i, size)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW):
    """The outlines of all rows, and (doc_id, text_hash, start, width, item_id) of every hit.

    ``start`` counts words from 1.
    """
    windows = written(item_windows(benchmark, window), "item-windows")
    # At most ``window`` values.
    widths = sorted(r.width for r in windows.select("width").distinct().collect())
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    outline = written(
        keyed.withColumn("words", words_of(F.col("text"))).select(
            "doc_id", "text_hash", F.size("words").cast("long").alias("n_words"),
            *(_aligned(width).alias(f"blocks_{width}") for width in widths),
        ),
        "outlines",
    )
    places = None
    for width in widths:
        blocks = written(_item_blocks(windows, width), f"blocks-{width}")
        at = outline.select(
            "doc_id", "text_hash", F.posexplode(f"blocks_{width}").alias("nth", "block")
        ).join(_small(blocks, blocks.count()), "block")
        found = at.groupBy("doc_id", "text_hash").agg(F.collect_set("nth").alias("nths")).select(
            "doc_id", "text_hash", F.lit(width).alias("width"), "nths"
        )
        places = found if places is None else places.union(found)
    if places is None:
        none = outline.select("doc_id", "text_hash").limit(0)
        return outline, none.selectExpr(
            "*", "0 AS start", "0 AS width", "0L AS item_id"
        )
    places = written(places, "places")
    candidates = keyed.alias("d").join(
        _small(places, places.count()).alias("p"),
        F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
        & F.col("d.text_hash").eqNullSafe(F.col("p.text_hash")),
    ).select("d.doc_id", "d.text_hash", "width", "nths", words_of(F.col("text")).alias("words"))
    size = F.floor((F.col("width") + 1) / 2).cast("int")
    stride = F.col("width") - size + 1
    starts = F.array_distinct(F.flatten(F.transform(
        "nths",
        lambda n: F.sequence(
            F.greatest(F.lit(1), n * stride + 1 - (stride - 1)),
            F.least(n * stride + 1, F.size("words") - F.col("width") + 1),
        ),
    )))
    # Built inside the row: exploding the starts would copy all words to each of them.
    grams = candidates.withColumn("starts", starts).select(
        "doc_id", "text_hash", "width",
        F.inline(F.transform("starts", lambda s: F.struct(
            s.alias("start"), F.array_join(F.slice("words", s, F.col("width")), " ").alias("gram")
        ))),
    )
    found = grams.distinct().join(
        _small(windows, windows.count()), ["width", "gram"]
    ).select("doc_id", "text_hash", "start", "width", "item_id")
    return outline, written(found, "hits")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated."""
    outline, found = hits(docs, benchmark, window)
    key = ["doc_id", "text_hash"]
    covered = (
        found.select(*key, "start", "width").distinct()
        .select(*key, F.explode(
            F.sequence(F.col("start"), F.col("start") + F.col("width") - 1)
        ).alias("word"))
        .distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    )
    items = found.select(*key, "item_id").distinct().groupBy(*key).agg(
        F.count("*").alias("n_items"),
        F.array_join(
            F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ","
        ).alias("items"),
    )
    dirty = covered.alias("c").join(
        items.alias("i"),
        F.col("c.doc_id").eqNullSafe(F.col("i.doc_id"))
        & F.col("c.text_hash").eqNullSafe(F.col("i.text_hash")),
    ).select(F.col("c.doc_id").alias("hit_id"), F.col("c.text_hash").alias("hit_hash"),
             "n_hit", "n_items", "items")
    zero = F.lit(0).cast("long")
    return outline.join(
        dirty,
        F.col("doc_id").eqNullSafe(F.col("hit_id"))
        & F.col("text_hash").eqNullSafe(F.col("hit_hash")),
        "left",
    ).select(
        "doc_id", "text_hash", "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of an item."""
    _, found = hits(docs, benchmark, window)
    dirty = written(
        found.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
        .distinct(),
        "contaminated",
    )
    return docs.alias("d").join(
        _small(dirty, dirty.count()).alias("x"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("x.hit_id"))
        & F.xxhash64(F.col("d.text").cast("string")).eqNullSafe(F.col("x.hit_hash")),
        "left_anti",
    )


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with the hit words taken out.

    A text with hits becomes its remaining words, lower-cased as they were
    compared and joined by one space; other texts stay as they are.
    """
    _, found = hits(docs, benchmark, window)
    spans = found.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
        F.collect_set(F.struct("start", "width")).alias("spans")
    )
    words = words_of(F.col("d.text").cast("string"))
    rest = F.filter(
        words,
        lambda w, i: ~F.exists(
            "x.spans", lambda s: (i + 1 >= s["start"]) & (i + 1 < s["start"] + s["width"])
        ),
    )
    joined = docs.alias("d").join(
        spans.alias("x"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("x.hit_id"))
        & F.xxhash64(F.col("d.text").cast("string")).eqNullSafe(F.col("x.hit_hash")),
        "left",
    )
    text = F.when(F.col("x.spans").isNull(), F.col("d.text")).otherwise(F.array_join(rest, " "))
    return joined.select(*(
        text.alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns
    ))
