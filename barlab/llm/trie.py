"""Trie of conversation prefixes, with sums over subtrees by centroid decomposition.

Turns become 128-bit digests at once; texts are not moved. The key of a prefix is
the exclusive or of the digests of (depth, turn) of its turns, so it is a running
aggregate, and that of the parent is the same without the last turn. A node is
named after the smallest conversation through it and its depth.

Running aggregates along a conversation are taken in chunks: rows are dealt by
ranges of (conversation, turn), a window runs inside each (conversation, chunk),
and what earlier chunks give is added from one row per chunk. So a conversation
that holds a third of all rows is worked on by many tasks.

Sums over subtrees (``rollup``) come from a centroid decomposition of the forest
of parent edges. All components are split at once, in rounds. With 2^k the largest
power of two that a component's number of nodes reaches, its centroid is the
lowest node with 2^k nodes at or below it; there is one path of such nodes, as
two subtrees of that size do not fit. The weights of the centroid and all that is
below it are added up, and the total is added to each node on the path from the
centroid to the component's top. Then the subtree of each child, and what is left
above, are components of their own, each with fewer than 2^k nodes. So there are
at most log2(nodes) + 1 rounds, however deep the trie is, and a finished centroid
is not read again. Paths and children are looked up in the table of prefixes, since the
ancestors of a node are the prefixes of the conversation it is named after.

Rows join what is known of their component or node. Where one of those has more
than ``SPREAD`` rows, its rows are dealt over several keys (``attach``); the list
of such ones is broadcast and has at most rows / ``SPREAD`` entries. The members
that end in a node are joined to text in pieces, and one task hashes the pieces
of a node in order, as a hash has to be.

Nulls: rows without a conversation id take no part; a null role or text is an
empty one, a null turn comes first. Equal turns of a conversation are ordered by
role, then by digest; repeated rows stay and take a place each. A conversation
without turns ends at the root. No rows give no nodes, not even the root.
Further columns are not read. Digests of different turns are taken to differ:
the chance of a clash among a billion nodes is below 1 in 10^20.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import written
from .common import batch_of

SPREAD = 200_000
GROUP = 5
LONGEST_LOAN = 8
STRIDE = 4096

_NODE = ("conv_id", "depth")


def attach(
    rows: DataFrame, info: DataFrame, on: list[str], weight: str, most: int, spread: int = SPREAD,
) -> DataFrame:
    """``rows`` with the columns of ``info``, which has one row per key.

    ``weight`` is a column of ``info``, not less than the number of rows of its
    key, and ``most`` not less than any weight. Keys above ``spread`` are split:
    their rows are dealt over several copies of the row of ``info``.
    """
    if most <= spread:
        return rows.join(info, on)
    parts = F.ceil(F.col(weight) / spread).cast("int")
    large = info.filter(F.col(weight) > spread).select(*on, parts.alias("_parts"))
    dealt = rows.join(F.broadcast(large), on, "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("_parts")).cast("int"), F.lit(0))
    ).drop("_parts")
    copies = info.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(parts - 1, F.lit(0)))))
    return dealt.join(copies, [*on, "_part"]).drop("_part")


def in_order(turns: DataFrame) -> DataFrame:
    """(conv_id, chunk, place, d1, d2, bytes): turns with their place from 1."""
    said = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    slim = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.xxhash64(F.lit(1), role, said).alias("d1"), F.xxhash64(F.lit(2), said, role).alias("d2"),
        F.octet_length(said).cast("long").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "d1", "d2"]
    dealt = written(
        slim.repartitionByRange("conv_id", *order).withColumn("chunk", F.spark_partition_id()),
        "trie-turns",
    )
    chunk = Window.partitionBy("conv_id", "chunk")
    placed = dealt.withColumn("place", F.row_number().over(chunk.orderBy(*order)).cast("long"))
    sizes = dealt.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = sizes.select(
        "conv_id", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    return written(
        placed.join(before, ["conv_id", "chunk"]).select(
            "conv_id", "chunk", (F.col("place") + F.col("before")).alias("place"),
            "d1", "d2", "bytes",
        ),
        "trie-places",
    )


def rebuilt(
    places: DataFrame, group: int = GROUP, longest: int = LONGEST_LOAN, spread: int = SPREAD
) -> tuple[DataFrame, DataFrame]:
    """Each conversation with its first turns taken from the first of its group.

    Gives its turns (conv_id, chunk, depth, d1, d2, bytes) and the conversations
    (conv_id, n_turns). Conversation c takes crc32(c) modulo ``longest`` + 1 turns.
    """
    sizes = places.groupBy("conv_id").agg(F.count("*").alias("n"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(longest + 1))
    convs = sizes.select(
        "conv_id", "n", taken.alias("h"),
        (F.col("conv_id") - F.col("conv_id") % group).alias("lender"),
    )
    lent = F.least("h", F.coalesce("n_lender", F.lit(0)))
    lenders = sizes.select(F.col("conv_id").alias("lender"), F.col("n").alias("n_lender"))
    convs = written(
        convs.join(lenders, "lender", "left").select(
            "conv_id", "lender", "n", "h", lent.alias("lent"),
            (lent + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"),
        ),
        "trie-conversations",
    )
    own = attach(
        places, convs.select("conv_id", "n", "h", "lent"), ["conv_id"], "n", places.count(), spread
    ).filter("place > h")
    loans = places.filter(F.col("place") <= longest).withColumnRenamed("conv_id", "lender").join(
        convs.select("conv_id", "lender", "lent"), "lender"
    ).filter("place <= lent")
    rows = own.select(
        "conv_id", "chunk", (F.col("place") - F.col("h") + F.col("lent")).alias("depth"),
        "d1", "d2", "bytes",
    ).union(loans.select("conv_id", F.lit(-1), F.col("place"), "d1", "d2", "bytes"))
    return rows, convs.select("conv_id", "n_turns")


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, bytes): the key of each prefix and of its parent."""
    hashed = rows.select(
        "conv_id", "chunk", "depth", "bytes",
        F.xxhash64("depth", "d1", "d2").alias("g1"),
        F.xxhash64("d2", "depth", "d1", F.lit(3)).alias("g2"),
    )
    hashed = written(hashed, "trie-rebuilt")
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0
    )
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0).cast("long")
    whole = hashed.groupBy("conv_id", "chunk").agg(
        F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2")
    )
    before = whole.select(
        "conv_id", "chunk",
        F.coalesce(F.bit_xor("x1").over(earlier), zero).alias("b1"),
        F.coalesce(F.bit_xor("x2").over(earlier), zero).alias("b2"),
    )
    running = hashed.withColumn("r1", F.bit_xor("g1").over(inside)).withColumn(
        "r2", F.bit_xor("g2").over(inside)
    )
    keyed = running.join(before, ["conv_id", "chunk"]).select(
        "conv_id", "depth", "bytes", "g1", "g2",
        F.col("r1").bitwiseXOR(F.col("b1")).alias("k1"),
        F.col("r2").bitwiseXOR(F.col("b2")).alias("k2"),
    )
    return keyed.select(
        "conv_id", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("g1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("g2")).alias("p2"), "bytes",
    )


def owned(keys: DataFrame, root: int, spread: int = SPREAD) -> tuple[DataFrame, DataFrame]:
    """The nodes below the root, and the table of prefixes.

    Nodes: (conv_id, depth, parent, n_convs, bytes). Prefixes: (conv_id, depth,
    owner, parent), where ``owner`` names the node of the prefix.
    """
    keys = written(keys, "trie-keys")
    most = keys.count()
    nodes = written(
        keys.groupBy("depth", "k1", "k2").agg(
            F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"),
            F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.min("bytes").alias("bytes"),
        ),
        "trie-keyed-nodes",
    )
    # Children of a node are not more than its conversations.
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("owner").alias("above"), F.col("n_convs").alias("weight"),
    )
    below = attach(nodes.filter("depth > 1"), above, ["depth", "p1", "p2"], "weight", most, spread)
    # Two prefixes of one conversation have one path, hence the same parent.
    first = nodes.filter("depth = 1").select("depth", "k1", "k2", "owner", "n_convs", "bytes",
                                             F.lit(root).cast("long").alias("above"))
    nodes = written(
        below.select(*first.columns).union(first).withColumnRenamed("above", "parent"),
        "trie-nodes",
    )
    table = attach(
        keys.select("conv_id", "depth", "k1", "k2"),
        nodes.select("depth", "k1", "k2", "owner", "parent", "n_convs"),
        ["depth", "k1", "k2"], "n_convs", most, spread,
    ).select("conv_id", "depth", "owner", "parent")
    named = nodes.select(F.col("owner").alias("conv_id"), "depth", "parent", "n_convs", "bytes")
    return named, written(table, "trie-prefixes")


def sizes(table: DataFrame, convs: DataFrame, spread: int = SPREAD) -> DataFrame:
    """(conv_id, depth, size): the number of nodes in the subtree of each node but the root.

    A conversation names the nodes from some depth on to its end. Below one of
    its prefixes lie all nodes it names that are not above that prefix.
    """
    shared = table.groupBy("conv_id").agg(
        F.sum((F.col("owner") != F.col("conv_id")).cast("long")).alias("shared")
    )
    ends = convs.filter("n_turns > 0").join(shared, "conv_id")
    held = F.col("n_turns") - F.greatest(F.col("shared"), F.col("depth") - 1)
    return (
        attach(table, ends, ["conv_id"], "n_turns", table.count(), spread)
        .groupBy(F.col("owner").alias("conv_id"), "depth")
        .agg(F.sum(held).alias("size"))
    )


def _between(splits: DataFrame) -> DataFrame:
    """A row for each depth from the top to the centroid."""
    # Two steps keep the arrays of a very long path short.
    by = F.explode(F.sequence("top_depth", "c_depth", F.lit(STRIDE).cast("long")))
    last = F.least(F.col("from") + STRIDE - 1, F.col("c_depth"))
    return splits.withColumn("from", by).withColumn("depth", F.explode(F.sequence("from", last)))


def rollup(
    nodes: DataFrame, table: DataFrame, weights: list[str], root: int, spread: int = SPREAD
) -> DataFrame:
    """(conv_id, depth, weights): the sums of the weights over the subtree of each node.

    ``nodes`` has conv_id, depth, size and the weights, the root included;
    ``table`` has the node and the parent of each prefix but the root. A
    component is named after its top.
    """
    gained = [f"gained_{w}" for w in weights]
    top = ["top_conv", "top_depth"]
    state = written(
        nodes.select(
            *_NODE, "size", *weights, *(F.lit(0).cast("long").alias(g) for g in gained),
            F.lit(root).cast("long").alias("top_conv"), F.lit(0).cast("long").alias("top_depth"),
            F.lit(False).alias("done"),
        ),
        "trie-state",
    )
    # The prefix one turn longer than a centroid's tells which child a node is below.
    child = table.select(
        "conv_id", F.col("depth").alias("at"), F.col("owner").alias("child"),
        F.col("parent").alias("child_parent"),
    )
    most = state.count()
    finished = []
    while most:
        # The highest power of two first, and of the nodes that reach it the lowest.
        power = F.length(F.bin("size"))
        chosen = F.min(F.struct(
            (-power).alias("power"), "size", F.col("conv_id").alias("c_conv"),
            F.col("depth").alias("c_depth"),
        ))
        centroids = state.groupBy(*top).agg(chosen.alias("c"), F.count("*").alias("total")).select(
            *top, "total", "c.c_conv", "c.c_depth", F.col("c.size").alias("below")
        )
        near = attach(state, centroids, top, "total", most, spread).withColumn(
            "at", F.when(F.col("depth") > F.col("c_depth"), F.col("c_depth") + 1)
        )
        judged = written(
            near.join(child, ["conv_id", "at"], "left").select(
                *_NODE, "size", *weights, *gained, *top, "c_conv", "c_depth", "below",
                F.when(F.col("child_parent") == F.col("c_conv"), F.col("child")).alias("child"),
            ),
            "trie-judged",
        )
        is_centroid = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
        # What the centroid and all below it weigh, for each node from there to the top.
        sums = judged.filter(F.col("child").isNotNull() | is_centroid).groupBy(*top).agg(
            F.first("c_conv").alias("c_conv"), F.first("c_depth").alias("c_depth"),
            F.first("below").alias("taken"), *(F.sum(w).alias(f"sum_{w}") for w in weights),
        )
        added = ["taken", *(f"sum_{w}" for w in weights)]
        on_path = table.select(F.col("conv_id").alias("c_conv"), "depth", "owner")
        path = _between(sums).join(on_path, ["c_conv", "depth"], "left").select(
            # The root has no row among the prefixes.
            F.coalesce("owner", F.lit(root)).alias("conv_id"), "depth", *added
        )
        kept = judged.withColumn("done", is_centroid).join(path, list(_NODE), "left")
        after = written(
            kept.select(
                *_NODE, (F.col("size") - F.coalesce("taken", F.lit(0))).alias("size"), *weights,
                *((F.col(g) + F.coalesce(f"sum_{w}", F.lit(0))).alias(g)
                  for g, w in zip(gained, weights)),
                F.coalesce("child", "top_conv").alias("top_conv"),
                F.when(F.col("child").isNotNull(), F.col("c_depth") + 1)
                .otherwise(F.col("top_depth")).alias("top_depth"),
                "done",
            ),
            "trie-state",
        )
        finished.append(after.filter("done").select(
            *_NODE, *(F.col(g).alias(w) for g, w in zip(gained, weights))
        ))
        state = after.filter("not done")
        most = state.count()
    result = finished[0]
    for some in finished[1:]:
        result = result.union(some)
    return result


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of members of one node, in order, as comma-joined text."""
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        members = batch.column(2).to_pylist()
        starts = [i for i, key in enumerate(keys) if not i or key != keys[i - 1]]
        cuts = list(zip(starts, [*starts[1:], len(keys)]))
        yield batch_of(
            conv_id=pa.array([keys[a][0] for a, _ in cuts], pa.int64()),
            depth=pa.array([keys[a][1] for a, _ in cuts], pa.int64()),
            lowest=pa.array([members[a] for a, _ in cuts], pa.int64()),
            piece=pa.array([",".join(map(str, members[a:b])) for a, b in cuts], pa.string()),
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the pieces of each node, which follow each other in order."""

    def result(found: list) -> pa.RecordBatch:
        return batch_of(
            conv_id=pa.array([k[0] for k, _ in found], pa.int64()),
            depth=pa.array([k[1] for k, _ in found], pa.int64()),
            ends_sha256=pa.array([h.hexdigest() for _, h in found], pa.string()),
        )

    key, state = None, None
    for batch in batches:
        found = []
        columns = (c.to_pylist() for c in batch.columns)
        for conv_id, depth, piece in zip(*columns):
            if (conv_id, depth) == key:
                state.update(b"," + piece.encode())
                continue
            if key is not None:
                found.append((key, state))
            key, state = (conv_id, depth), hashlib.sha256(piece.encode())
        if found:
            yield result(found)
    if key is not None:
        yield result([(key, state)])


def ends(table: DataFrame, convs: DataFrame, root: int) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes in which a conversation ends."""
    last = convs.filter("n_turns > 0").select("conv_id", F.col("n_turns").alias("depth"))
    members = table.join(last, ["conv_id", "depth"]).select(
        F.col("owner").alias("conv_id"), "depth", F.col("conv_id").alias("member")
    ).union(convs.filter("n_turns = 0").select(
        F.lit(root).cast("long"), F.lit(0).cast("long"), "conv_id"
    ))
    order = ["conv_id", "depth", "member"]
    # Written, as dealing by ranges looks at its rows twice.
    dealt = written(members, "trie-ends").repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = dealt.mapInArrow(_joined, "conv_id long, depth long, lowest long, piece string")
    met = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "lowest")
    return met.select("conv_id", "depth", "piece").mapInArrow(
        _hashed, "conv_id long, depth long, ends_sha256 string"
    )


def prefix_trie(turns: DataFrame, spread: int = SPREAD) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``rebuilt``)."""
    spark = turns.sparkSession
    rows, convs = rebuilt(in_order(turns), spread=spread)
    known = convs.agg(F.min("conv_id").alias("root"), F.count("*").alias("n")).first()
    if known.root is None:
        return spark.createDataFrame([], RESULT)
    root = known.root
    nodes, table = owned(prefixes(rows), root, spread)
    inner = nodes.join(sizes(table, convs, spread), list(_NODE))
    zero = F.lit(0).cast("long")
    top = spark.createDataFrame(
        [(root, 0, None, known.n, 0, nodes.count() + 1)],
        "conv_id long, depth long, parent long, n_convs long, bytes long, size long",
    )
    children = nodes.groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children")
    )
    every = written(
        inner.select(*top.columns).union(top).join(children, list(_NODE), "left").select(
            *top.columns, F.coalesce("n_children", zero).alias("n_children"),
            (F.coalesce("n_children", zero) == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"),
        ),
        "trie-nodes",
    )
    sums = rollup(
        every.select(*_NODE, "size", "n_leaves", "saved_tokens"), table,
        ["n_leaves", "saved_tokens"], root, spread,
    )
    shown = every.select(*_NODE, F.col("parent").alias("parent_conv_id"), "n_convs", "n_children")
    return shown.join(sums, list(_NODE)).join(ends(table, convs, root), list(_NODE), "left").select(
        *shown.columns, "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
