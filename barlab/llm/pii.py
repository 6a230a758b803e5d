"""Personal data by bootstrapped contextual extraction.

1. Four plain rules find the base spans (email, ip, card, phone). They are the
   seeds; whatever else looks like an identifier is a candidate: words with a
   digit or @, and rows of numbers, such as phone numbers written with spaces, of
   at least ``LEAST_SIGNS`` signs and ``LEAST_ALNUM`` letters and digits.
2. Each occurrence of a seed or candidate gives lexical patterns: the two words
   before it, and the words on both sides. Patterns and instances (the strings
   found) make up a graph.
3. Spark scores the graph in ``turns`` turns, a parameter of ``find``. A pattern is as trustworthy, for a kind, as
   the instances it finds are likely of that kind; a candidate is as likely as
   its patterns make it together. Seeds stay certain.
4. Candidates that end up likely enough by trusted patterns are added as spans.

Instances count once for a pattern, however often copies repeat them. All sums
combine before the shuffle; a pattern with very many instances meets in no task.

Nulls: a null or empty text has no spans. Rows are told apart by id and text, so
rows with a null or repeated id get their own results. Of equally likely kinds of
a candidate the first in the order above counts. An empty table gives an empty
one; further columns are not read, and ``redact`` keeps them. Texts are searched
whole, in time about in proportion to their length; the spans of one text are
held by one task.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import batch_of, longs, map_batches

KINDS = ("email", "ip", "card", "phone")
TURNS = 3
# A pattern needs so many different seeds of a kind, and this trust, to add spans.
LEAST_SEEDS = 3
TRUST = 0.8
# Keeps a pattern with few instances from being trusted.
PRIOR = 1.0

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Addresses and card numbers lie inside such runs, so a text is searched for digits once.
_DIGITS = re.compile(r"[0-9](?:[0-9.\x20-]*[0-9])?")
# A match never starts inside a run of digits, so the test before it changes nothing but cost.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGIT = re.compile("[0-9]")
# A number as it is written in a row of them, and what may stand between two.
_NUMERIC = re.compile(r"\+?[0-9][0-9.()/-]*")
_BETWEEN = re.compile(r"[^\S\r\n]+(?:[-./()]+[^\S\r\n]+)?")
_EDGES = ".,;:?!\"'()[]{}<>=*&%#$"
# Longer context words stand in patterns by their digest.
LONG_WORD = 60
LEAST_SIGNS, LEAST_ALNUM = 6, 5

Span = tuple[int, int, int]  # start, kind, end


def _luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, 0, free))
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """The spans of the four rules in order, and the places of all digit runs."""
    found = _emails(text) if "@" in text else []
    runs = []
    for run in _DIGITS.finditer(text):
        start, end = run.span()
        runs.append((start, end))
        if end - start < 7:
            continue
        for match in _IP.finditer(text, start, end):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.group().split(".")):
                found.append((match.start(), 1, match.end()))
        for match in _CARD.finditer(text, start, end):
            digits = _NOT_DIGIT.sub("", match.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", match.group())) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found), runs


class _Cover:
    """Whether a stretch touches any of the given spans."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, start: int, end: int) -> bool:
        last = bisect_left(self.starts, end) - 1
        return last >= 0 and self.ends[last] > start


def _candidates(text: str, base: list[Span], runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What looks like an identifier and touches no base span.

    Words with a digit or @, and rows of numbers written with white space
    between them, dots, hyphens and brackets included, as long as no end of a
    sentence or line comes between.
    """
    places = runs
    if "@" in text:
        places = sorted([*runs, *(m.span() for m in re.finditer("@", text))])
    words, done = [], 0
    for start, upto in places:
        place: int | None = start
        if done > start:
            following = _DIGIT.search(text, done, upto)
            place = following.start() if following else None
        while place is not None:
            start, end = place, place
            while start > done and not text[start - 1].isspace():
                start -= 1
            while end < len(text) and not text[end].isspace():
                end += 1
            done = end
            words.append((start, end))
            following = _DIGIT.search(text, end, upto)
            place = following.start() if following else None
    seen, row, cover = [], [], _Cover(base)
    for start, end in words:
        first, last = start, end
        while first < last and text[first] in _EDGES:
            first += 1
        while last > first and text[last - 1] in _EDGES:
            last -= 1
        seen.append((first, last))
        if not _NUMERIC.fullmatch(text, first, last):
            row = _settled(row, seen)
            continue
        # An opening bracket before a number belongs to it, and a closing one after it.
        if row and not (_BETWEEN.fullmatch(text, row[-1][1], start) and text[start:first] in ("", "(")):
            row = _settled(row, seen)
        if cover.touches(start, end):
            row = _settled(row, seen)
            continue
        row.append((start if text[start:first] == "(" else first, end, last))
        if text[last:end] not in ("", ")"):
            row = _settled(row, seen)
    _settled(row, seen)
    return [
        (start, end) for start, end in sorted(set(seen))
        if end - start >= LEAST_SIGNS
        and sum(c.isalnum() for c in text[start:end]) >= LEAST_ALNUM
        and not cover.touches(start, end)
    ]


def _settled(row: list[tuple[int, int, int]], seen: list[tuple[int, int]]) -> list:
    """Add a row of several numbers to what was seen, and begin a new row."""
    if len(row) > 1:
        seen.append((row[0][0], row[-1][2]))
    return []


def _context(word: str) -> str:
    if len(word) > LONG_WORD:
        return hashlib.sha256(word.lower().encode()).hexdigest()
    return re.sub(r"[0-9]+", "0", word.lower())


class _Words:
    """The whole words around places of a text that are asked for in any order."""

    def __init__(self, text: str):
        self.places = [m.span() for m in re.finditer(r"\S+", text)] if text else []
        self.starts = [start for start, _ in self.places]
        self.ends = [end for _, end in self.places]
        self.text = text

    def before(self, place: int) -> list[str]:
        """Up to two; what stands in one word before the place is one of them."""
        upto = bisect_left(self.starts, place)
        return [self.text[s:min(e, place)] for s, e in self.places[max(0, upto - 2):upto]]

    def after(self, place: int) -> str:
        first = bisect_left(self.ends, place + 1)
        if first == len(self.places):
            return ""
        start, end = self.places[first]
        return self.text[max(start, place):end]


def _patterns(words: _Words, start: int, end: int) -> list[str]:
    """Two words before; one word before and one after."""
    left = [_context(w) for w in words.before(start)]
    after = words.after(end)
    right = _context(after) if after else ""
    found = []
    if len(left) == 2:
        found.append(f"{left[0]} {left[1]} _")
    if left and right:
        found.append(f"{left[-1]} _ {right}")
    return found


def written_as(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_OCCURRENCE = "struct<start:int,stop:int,kind:int,instance:string,patterns:array<string>>"


def outlines(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash, counts and digest of the base spans, spans, occurrences."""
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())])
    occurrence = pa.struct([
        ("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.int32()),
        ("instance", pa.string()), ("patterns", pa.list_(pa.string())),
    ])

    def rows():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [[], [], [], []]
            digests, spans, occurrences = [], [], []
            for text in batch.column(2).to_pylist():
                text = text or ""
                base, runs = base_spans(text)
                for kind, column in enumerate(counts):
                    column.append(sum(k == kind for _, k, _ in base))
                digests.append(hashlib.sha256(written_as(base).encode()).hexdigest())
                spans.append([{"start": s, "kind": k, "stop": e} for s, k, e in base])
                seen = [(s, e, k) for s, k, e in base]
                seen += [(s, e, -1) for s, e in _candidates(text, base, runs)]
                words = _Words(text if seen else "")
                occurrences.append([
                    {"start": s, "stop": e, "kind": k, "instance": text[s:e].lower(),
                     "patterns": _patterns(words, s, e)}
                    for s, e, k in seen
                ])
            return batch_of(
                doc_id=batch.column(0), text_hash=batch.column(1),
                **{f"n_{kind}": longs(c) for kind, c in zip(KINDS, counts, strict=True)},
                base_sha256=pa.array(digests, pa.string()),
                spans=pa.array(spans, pa.list_(span)),
                occurrences=pa.array(occurrences, pa.list_(occurrence)),
            )

        return apply

    text = F.col("text").cast("string")
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    found = map_batches(
        source, rows,
        f"doc_id long, text_hash long, {counts}, base_sha256 string, "
        f"spans array<struct<start:int,kind:int,stop:int>>, occurrences array<{_OCCURRENCE}>",
    )
    return written(found.withColumn("unit", F.monotonically_increasing_id()), "pii-outlines")


def _likely(kind: int) -> Column:
    return F.col(f"likely_{kind}")


def score_graph(edges: DataFrame, turns: int = TURNS) -> tuple[DataFrame, DataFrame]:
    """The patterns that can be trusted, and the candidates they make likely.

    ``edges``: (pattern, instance, kind), kind -1 for candidates. Returns
    (pattern, kind, trust) and (instance, kind, likely).
    """
    numbers = range(len(KINDS))
    instances = written(
        edges.groupBy("instance").agg(
            *(F.max((F.col("kind") == k).cast("double")).alias(f"likely_{k}") for k in numbers),
            F.max(F.col("kind") >= 0).alias("seed"),
        ),
        "pii-instances",
    )
    edges = written(edges.select("pattern", "instance").distinct(), "pii-edges")
    patterns = None
    for _ in range(turns):
        patterns = written(
            edges.join(instances, "instance").groupBy("pattern").agg(
                *(
                    (F.sum(_likely(k)) / (F.count("*") + F.lit(PRIOR))).alias(f"trust_{k}")
                    for k in numbers
                ),
                *(
                    F.sum(F.when(F.col("seed"), _likely(k)).otherwise(0)).alias(f"seeds_{k}")
                    for k in numbers
                ),
            ).select("pattern", *(
                F.when(F.col(f"seeds_{k}") >= LEAST_SEEDS, F.least(F.col(f"trust_{k}"), F.lit(0.999)))
                .otherwise(0.0).alias(f"trust_{k}")
                for k in numbers
            )).filter(F.greatest(*(f"trust_{k}" for k in numbers)) > 0),
            "pii-patterns",
        )
        doubt = edges.join(patterns, "pattern").groupBy("instance").agg(*(
            F.sum(F.log1p(-F.col(f"trust_{k}"))).alias(f"doubt_{k}") for k in numbers
        ))
        instances = written(
            instances.join(doubt, "instance", "left").select(
                "instance", "seed",
                *(
                    F.when(F.col("seed"), _likely(k))
                    .otherwise(1 - F.exp(F.coalesce(f"doubt_{k}", F.lit(0.0)))).alias(f"likely_{k}")
                    for k in numbers
                ),
            ),
            "pii-instances",
        )

    def tall(df: DataFrame, key: str, value: str) -> DataFrame:
        return df.select(key, F.posexplode(
            F.array(*(f"{value}_{k}" for k in numbers))
        ).alias("kind", value))

    trusted = tall(patterns, "pattern", "trust").filter(F.col("trust") >= TRUST)
    likely = tall(instances.filter("not seed"), "instance", "likely").filter(
        F.col("likely") >= TRUST
    )
    return trusted, likely


def find(docs: DataFrame, turns: int = TURNS) -> DataFrame:
    """Per row: doc_id, text_hash, n_email, n_ip, n_card, n_phone, base_sha256, spans, found.

    ``spans`` are the base spans (start, kind number, stop) in code points, and
    ``found`` those that trusted patterns add.
    """
    rows = outlines(docs)
    seen = rows.select("unit", F.inline("occurrences"))
    edges = seen.select("instance", "kind", F.explode("patterns").alias("pattern"))
    trusted, likely = score_graph(edges, turns)
    hits = (
        seen.filter("kind = -1").drop("kind")
        .select("unit", "start", "stop", "instance", F.explode("patterns").alias("pattern"))
        .join(trusted, "pattern").join(likely, ["instance", "kind"])
    )
    best = hits.groupBy("unit", "start", "stop").agg(
        F.max(F.struct("likely", -F.col("kind"))).alias("best")
    )
    # A number inside a found row of numbers is part of it.
    before = Window.partitionBy("unit").orderBy("start", F.col("stop").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    best = best.withColumn("reached", F.max("stop").over(before)).filter(
        F.coalesce(F.col("stop") > F.col("reached"), F.lit(True))
    )
    added = best.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct(
        "start", (-F.col("best.col2")).alias("kind"), "stop"
    ))).alias("found"))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    return rows.drop("occurrences").join(added, "unit", "left").withColumn(
        "found", F.coalesce("found", none)
    ).drop("unit")


def spelled(spans: Column) -> Column:
    """kind:start:end of all spans by start, then kind, joined by commas."""
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")
    )), ",")


def redact(docs: DataFrame, small: int = 2_000_000) -> DataFrame:
    """The rows of ``docs``, all columns, with every span replaced by its kind in brackets.

    Spans that overlap are replaced as one, by the kind of the first. Rows with
    spans are broadcast up to ``small`` of them and shuffled beyond that.
    """
    spans = written(
        find(docs).select(
            "doc_id", "text_hash", F.array_sort(F.concat("spans", "found")).alias("all_spans")
        ).filter(F.size("all_spans") > 0).dropDuplicates(["doc_id", "text_hash"]),
        "pii-spans",
    )
    if spans.count() <= small:
        spans = F.broadcast(spans)
    text = F.col("d.text").cast("string")
    joined = docs.alias("d").join(
        spans.alias("s"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("s.doc_id"))
        & F.xxhash64(text).eqNullSafe(F.col("s.text_hash")),
        "left",
    )
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    # (text so far, place up to which it is settled)
    done = F.aggregate(
        "s.all_spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("upto")),
        lambda acc, span: F.when(span["start"] < acc["upto"], F.struct(
            acc["out"].alias("out"), F.greatest(acc["upto"], span["stop"]).alias("upto")
        )).otherwise(F.struct(
            F.concat(
                acc["out"], F.substring(text, acc["upto"] + 1, span["start"] - acc["upto"]),
                F.element_at(names, span["kind"] + 1),
            ).alias("out"),
            span["stop"].alias("upto"),
        )),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["upto"] + 1, F.length(text))),
    )
    return joined.select(*(
        F.when(F.col("s.doc_id").isNull() & F.col("s.text_hash").isNull(), F.col("d.text"))
        .otherwise(done).alias("text") if c == "text" else F.col(f"d.`{c}`")
        for c in docs.columns
    ))
