"""Token ids in files of patched frame-of-reference blocks.

Documents are dealt to files by ranges of their ids, so that file after file,
and document after document in each, the ids of all texts stand in ascending
order of document id. Numbers are stored in blocks of 4,096: the smallest of a
block is subtracted, a width is chosen that holds a given percentage of what is
left, the low bits of all are packed at that width, and the places and high bits
of the outliers follow in an exception list.

A file is a sequence of records, each ended by a line feed as Spark's text
writer does it: the id blocks, blocks of the document ids (as differences) and
of the token counts, then the index with the byte offset of each block, and a
trailer of fixed size. So any range of tokens is read by decoding only the
blocks that hold it (``ids_between``). Files are written by Spark's own
committer, hence a lost or repeated task leaves no half or double file, and they
are read by Spark's ``binaryFile`` reader from any store that Spark can reach.

Texts are encoded with the tokenizers library. Where its file splits texts as
byte-level BPE does, a token never crosses the place before a space that a
non-space follows; the different parts between such places in some MB of texts are
encoded once, and not at all while they are remembered, which also bounds what the
library holds for a very long text. New parts of plain signs (ASCII and Latin-1
letters, digits, marks, usual white space) are split further here, by the same
expression as byte-level BPE, and the library merges their different words and marks,
thousands at a time; other new parts go through the whole library.
For other files, texts are encoded whole. Strings of special tokens inside a text
are ordinary text.

Bounds: a task holds one sort run of its texts, the parts and ids of
``TEXT_BYTES_AT_ONCE`` of them (or of one text), ``PARTS`` remembered parts, 64
blocks, and, when reading, one file. A file takes about ``BYTES_A_FILE`` bytes
of text, or one document if that is longer.

Nulls: a null text is an empty one; each document ends with ``end_id``, so an
empty one has a single token. Null document ids come first, as one run. Rows
that share an id follow each other by a hash of their text, equal rows in any
order, each as a document of its own. No rows give no document. Further columns
are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_bytes

BLOCK = 4096
LANES = 64
BLOCKS_AT_ONCE = 64
PERCENT = 95
BYTES_A_FILE = 32 << 20
# Parts of texts and characters in them that a task remembers before it starts over.
PARTS, PART_CHARS = 500_000, 8_000_000
PARTS_AT_ONCE = 2048
# Bytes of text that are encoded together, and bytes of ids that are read together.
TEXT_BYTES_AT_ONCE = 8 << 20
BYTES_AT_ONCE = 4 << 20

# base, numbers, outliers, width, bytes of a high part
_HEAD = struct.Struct("<qHHBB")
# file number, null ids, tokens, then blocks of ids, of document ids, of counts,
# documents, offset of the index, magic
_TRAILER = struct.Struct(">qqqqqqqq4s")
MAGIC = b"PFB1"


def _width(largest: int) -> int:
    return int(largest).bit_length()


def pack(values: np.ndarray, percent: int = PERCENT) -> list[bytes]:
    """One record for each block of up to 4,096 64-bit numbers."""
    heads: list[tuple] = []
    by_width: dict[int, list[int]] = {}
    rest = np.zeros((-(-len(values) // BLOCK), BLOCK), np.uint64)
    for i in range(len(rest)):
        part = values[i * BLOCK:(i + 1) * BLOCK].astype(np.int64)
        base = part.min()
        rest[i, :len(part)] = part.astype(np.uint64) - base.astype(np.uint64)
        kept = -(-len(part) * percent // 100) - 1
        width = _width(np.partition(rest[i, :len(part)], kept)[kept])
        high = rest[i] >> np.uint64(width) if width < 64 else np.zeros(BLOCK, np.uint64)
        places = np.flatnonzero(high)
        size = 4 if not len(places) or high.max() < 1 << 32 else 8
        heads.append((
            _HEAD.pack(int(base), len(part), len(places), width, size),
            places.astype("<u2").tobytes() + high[places].astype(f"<u{size}").tobytes(),
        ))
        by_width.setdefault(width, []).append(i)
    packed = [b""] * len(rest)
    for width, held in by_width.items():
        words = _packed(rest[held], width).astype("<u8")
        for row, i in enumerate(held):
            packed[i] = words[row].tobytes()
    return [head + body + tail for (head, tail), body in zip(heads, packed)]


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """The low bits of each row's numbers, 64 lanes side by side in 64-bit words."""
    rows = values.reshape(len(values), BLOCK // LANES, LANES)
    if width < 64:
        rows = rows & np.uint64((1 << width) - 1)
    words = np.zeros((len(values), width, LANES), np.uint64)
    for j in range(BLOCK // LANES if width else 0):
        word, shift = divmod(j * width, 64)
        words[:, word] |= rows[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= rows[:, j] >> np.uint64(64 - shift)
    return words


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    rows = np.zeros((len(words), BLOCK // LANES, LANES), np.uint64)
    for j in range(BLOCK // LANES if width else 0):
        word, shift = divmod(j * width, 64)
        rows[:, j] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            rows[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    if width < 64:
        rows &= np.uint64((1 << width) - 1)
    return rows.reshape(len(words), BLOCK)


def unpack(content: bytes, offsets: np.ndarray) -> np.ndarray:
    """The numbers of the blocks that start at the given offsets."""
    heads = [_HEAD.unpack_from(content, o) for o in offsets.tolist()]
    bodies = offsets + _HEAD.size
    values = np.zeros((len(heads), BLOCK), np.uint64)
    for width in {h[3] for h in heads}:
        rows = [i for i, h in enumerate(heads) if h[3] == width]
        words = np.stack([
            np.frombuffer(content, "<u8", width * LANES, int(bodies[i])) for i in rows
        ]).reshape(len(rows), width, LANES)
        values[rows] = _unpacked(words.astype(np.uint64), width)
    numbers = []
    for i, (base, count, outliers, width, size) in enumerate(heads):
        if outliers:
            at = int(bodies[i]) + width * LANES * 8
            places = np.frombuffer(content, "<u2", outliers, at)
            high = np.frombuffer(content, f"<u{size}", outliers, at + 2 * outliers)
            values[i, places] |= high.astype(np.uint64) << np.uint64(width)
        numbers.append((values[i, :count] + np.int64(base).astype(np.uint64)).astype(np.int64))
    return np.concatenate(numbers) if numbers else np.empty(0, np.int64)


class Shelf:
    """Packs numbers that arrive in any portions; keeps count of blocks."""

    def __init__(self, percent: int):
        self.percent, self.held, self.size = percent, [], 0

    def add(self, values: np.ndarray) -> list[bytes]:
        self.held.append(values)
        self.size += len(values)
        return self._take(BLOCK * BLOCKS_AT_ONCE) if self.size >= BLOCK * BLOCKS_AT_ONCE else []

    def _take(self, whole: int) -> list[bytes]:
        values = np.concatenate(self.held) if self.held else np.empty(0, np.int64)
        cut = len(values) - len(values) % whole
        self.held, self.size = [values[cut:]], len(values) - cut
        return [
            record for start in range(0, cut, BLOCK * BLOCKS_AT_ONCE)
            for record in pack(values[start:min(cut, start + BLOCK * BLOCKS_AT_ONCE)], self.percent)
        ]

    def rest(self) -> list[bytes]:
        return self._take(1)


_CUT = re.compile(r" (?=\S)")
_BEFORE_SPACE = re.compile(r" (?!\S)")
# Signs that are letters, digits, white space or neither by any version of Unicode.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[\t\n\r -~{_LETTERS}]*")
# How byte-level BPE splits a text before it merges, for plain signs.
_SPLIT = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"
)
# Stand between pieces, before and after their bytes are written as signs; in neither.
_ZERO, _LINE = "\0", "\n"


def _cut(ids: bytes, stops: np.ndarray) -> list[bytes]:
    """The bytes up to the first place, and those between each place and the next."""
    ends = stops.tolist()
    return [ids[low:high] for low, high in zip([0, *ends], ends)]


class _Known(dict):
    """Texts mapped to their ids; two generations, so what comes often is not forgotten."""

    def __init__(self):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.chars = 0

    def put(self, texts: list[str], ids: list[bytes]) -> None:
        """Remember texts that the newer generation does not hold, each once."""
        self.chars += sum(map(len, texts))
        self.update(zip(texts, ids))

    def find(self, texts: list[str]) -> list[bytes | None]:
        """The ids of each text, or None; what is found in the older generation moves on."""
        found = list(map(self.get, texts))
        if self.older:
            held = self.older.get
            moved = []
            for i, ids in enumerate(found):
                if ids is None and (ids := held(texts[i])) is not None:
                    found[i] = ids
                    moved.append(i)
            self.put([texts[i] for i in moved], [found[i] for i in moved])
        return found

    def turn(self) -> None:
        """Drop the older generation and begin a new one."""
        self.older = dict(self)
        self.clear()
        self.chars = 0


class _Pieces(_Known):
    """Pieces of plain signs as the split leaves them, which the model merges.

    Marks, and words with no space before them, are remembered; the others are parts,
    or begin one, and are remembered there.
    """

    def __init__(self, library, sizes: np.ndarray):
        super().__init__()
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        self.sizes = sizes
        # The same model, held once, for texts that are split already.
        self.merger = Tokenizer(library.model)
        self.merger.pre_tokenizer = CharDelimiterSplit(_LINE)
        bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = np.zeros(256, "<u2")
        for sign in filter(_PLAIN.fullmatch, map(chr, range(1, 256))):
            for byte, written in zip(sign.encode(), bytewise.pre_tokenize_str(sign)[0][0]):
                self.signs[byte] = ord(written)
        self.signs[ord(_ZERO)] = ord(_LINE)

    def merged(self, pieces: tuple[str, ...]) -> list[bytes]:
        """The ids of each piece, from the model in one call."""
        raw = np.frombuffer(_ZERO.join([*pieces, ""]).encode(), np.uint8)
        written = self.signs[raw[:-1]].tobytes().decode("utf-16-le")
        found = self.merger.encode_batch_fast([written], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        cuts = np.flatnonzero(raw == 0) - np.arange(len(pieces))
        return _cut(ids.tobytes(), 4 * _places(self.sizes[ids], cuts))

    def ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece; the model gets those that are not remembered, each once."""
        once = list(dict.fromkeys(pieces))
        known = dict(zip(once, self.find(once)))
        new = tuple(piece for piece, ids in known.items() if ids is None)
        if new:
            known.update(zip(new, self.merged(new)))
            kept = [piece for piece in new if piece[0] != " "]
            self.put(kept, [known[piece] for piece in kept])
        return list(map(known.__getitem__, pieces))


def _places(sizes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many of the things of the given sizes end up to each cut."""
    ends = np.cumsum(sizes)
    places = np.searchsorted(ends, cuts)
    if len(cuts) and (places[-1] >= len(ends) or (ends[places] != cuts).any()):
        raise ValueError("a token crosses the end of a part")
    return places + 1


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers.

    A text is cut before each space that a non-space follows. The different parts of
    many texts are looked up once; those of plain signs that are not remembered are
    split as above, and the model merges their different pieces in one call. Other
    parts are encoded many at a time as one text, whose ids are told apart by the bytes
    their tokens stand for.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses every core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        self.library.encode_special_tokens = True
        asked = json.loads(model)
        split = asked.get("pre_tokenizer") or {}
        self.by_part = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space") and not asked.get("normalizer")
            and all(added.get("special") for added in asked.get("added_tokens") or [])
        )
        if self.by_part:
            # One sign of a byte-level token stands for one byte.
            tokens = map(self.library.id_to_token, range(self.library.get_vocab_size()))
            self.sizes = np.array([len(t or "") for t in tokens], np.int64)
            self.pieces = _Pieces(self.library, self.sizes)
            self.known = _Known()

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _split(self, parts: list[str]) -> list[bytes]:
        """The ids of each part of plain signs with a space before it."""
        pieces = _SPLIT.findall(" " + " ".join(parts))
        ids = self.pieces.ids(pieces)
        cuts = np.cumsum([len(part) + 1 for part in parts])
        last = _places(np.fromiter(map(len, pieces), np.int64, len(pieces)), cuts) - 1
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        return _cut(b"".join(ids), ends[last])

    def _unsplit(self, parts: list[str]) -> list[bytes]:
        """The ids of each part with a space before it, by the whole library."""
        ids = self._whole([" " + " ".join(parts)])[0]
        cuts = np.cumsum([len(part.encode()) + 1 for part in parts])
        return _cut(ids, 4 * _places(self.sizes[np.frombuffer(ids, "<u4")], cuts))

    def _learn(self, parts: list[str]) -> None:
        """Remember the ids of parts with a space before them."""
        other: list[str] = []
        for start in range(0, len(parts), PARTS_AT_ONCE):
            some = parts[start:start + PARTS_AT_ONCE]
            if not _PLAIN.fullmatch(" ".join(some)):
                other += [p for p in some if not _PLAIN.fullmatch(p)]
                some = [p for p in some if _PLAIN.fullmatch(p)]
            if some:
                self.known.put(some, self._split(some))
        for start in range(0, len(other), PARTS_AT_ONCE):
            some = other[start:start + PARTS_AT_ONCE]
            self.known.put(some, self._unsplit(some))

    def _forget(self) -> None:
        """Drop the older generations when the newer ones hold half of what may be remembered."""
        held = (self.known, self.pieces)
        if 2 * sum(map(len, held)) > PARTS or 2 * sum(h.chars for h in held) > PART_CHARS:
            for known in held:
                known.turn()

    def _joined(self, lists: pa.Array) -> list[bytes]:
        """The ids of each text, given as a list of its parts; the first has no space before it."""
        starts, values = lists.offsets.to_numpy(), lists.values
        first = np.zeros(len(values), bool)
        first[starts[:-1]] = True
        parts = values.filter(pa.array(~first)).dictionary_encode()
        names = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self.known.find(names)
        self._learn([name for name, found in zip(names, ids) if found is None])
        ids = [self.known[name] if found is None else found for name, found in zip(names, ids)]
        ids += self._whole(values.filter(pa.array(first)).to_pylist())
        codes = np.empty(len(values), np.int64)
        codes[first] = np.arange(len(names), len(ids))
        codes[~first] = parts.indices.to_numpy()
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begins = (np.cumsum(sizes) - sizes)[codes]
        sizes = sizes[codes]
        ends = np.cumsum(sizes)
        # Each part's ids stand together; a token lies as far from their begin here as there.
        places = np.repeat(begins - ends + sizes, sizes)
        places += np.arange(len(places))
        content = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
        return _cut(content, 4 * ends[starts[1:] - 1])

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_part:
            return self._whole(texts)
        self._forget()
        # Where each space is followed by a non-space, a split at spaces is the cut.
        spaced = [i for i, text in enumerate(texts) if _BEFORE_SPACE.search(text)]
        found = dict.fromkeys(range(len(texts)), b"")
        even = [i for i in found if i not in set(spaced)] if spaced else list(found)
        if even:
            some = pa.array([texts[i] for i in even], pa.large_string())
            found.update(zip(even, self._joined(pc.split_pattern(some, " "))))
        if spaced:
            cuts = [_CUT.split(texts[i]) for i in spaced]
            some = pa.array(cuts, pa.list_(pa.large_string()))
            found.update(zip(spaced, self._joined(some)))
        return list(found.values())


@lru_cache(maxsize=1)
def _encoder(model: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(model)


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of (doc_id, text) in order, about ``TEXT_BYTES_AT_ONCE`` or one row at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(batch):
        full = int(ends[start]) - int(sizes[start]) + TEXT_BYTES_AT_ONCE
        stop = max(start + 1, int(np.searchsorted(ends, full, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _file(number: int, batches: Iterator[pa.RecordBatch], encoder: Encoder, end_id: int,
          percent: int) -> Iterator[bytes]:
    """The records of one file, from batches of (doc_id, text) in order."""
    end = struct.pack("<I", end_id)
    tokens, ids, counts = Shelf(percent), Shelf(percent), Shelf(percent)
    later: dict[str, list[bytes]] = {"ids": [], "counts": []}
    starts: list[int] = []
    offset = nulls = total = documents = 0
    before: int | None = None

    def put(record: bytes) -> bytes:
        nonlocal offset
        starts.append(offset)
        offset += len(record) + 1
        return record

    for batch in batches:
        for some in _portions(batch):
            texts = [(t or b"").decode("utf-8", "replace") for t in some.column(1).to_pylist()]
            encoded = [e + end for e in encoder.encode(texts)]
            sizes = np.array([len(e) // 4 for e in encoded], np.int64)
            names = np.array([i for i in some.column(0).to_pylist() if i is not None], np.int64)
            nulls += len(some) - len(names)
            documents += len(some)
            total += int(sizes.sum())
            if len(names):
                # Differences wrap around at 64 bits, and adding them up does so again.
                first = 0 if before is None else before
                later["ids"] += ids.add(np.diff(names, prepend=np.int64(first)))
                before = int(names[-1])
            later["counts"] += counts.add(sizes)
            for record in tokens.add(np.frombuffer(b"".join(encoded), "<u4").astype(np.int64)):
                yield put(record)
    blocks = []
    for records in (tokens.rest(), later["ids"] + ids.rest(), later["counts"] + counts.rest()):
        for record in records:
            yield put(record)
        blocks.append(len(starts) - sum(blocks))
    yield np.array(starts, "<i8").tobytes() + _TRAILER.pack(
        number, nulls, total, *blocks, documents, offset, MAGIC
    )


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, percent: int = PERCENT,
    bytes_a_file: int = BYTES_A_FILE,
) -> None:
    """The ids of (doc_id, text) into files below ``path``."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        model = spark.sparkContext.broadcast(file.read())  # a few MB, read on the driver
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"),
        F.xxhash64("text").alias("order"),
    )
    size = slim.agg(F.sum(F.length("text"))).first()[0] or 0
    files = max(-(-size // bytes_a_file), spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        for record in _file(TaskContext.get().partitionId(), batches, encoder, end_id, percent):
            yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["value"])

    dealt = slim.repartitionByRange(files, "doc_id", "order")
    ordered = dealt.sortWithinPartitions("doc_id", "order").select("doc_id", "text")
    records = ordered.mapInArrow(run, "value binary")
    # The writer puts down the bytes of a string as they are.
    records.select(F.col("value").cast("string")).write.option("compression", "none").text(path)


class File:
    """A file's trailer and index over its content."""

    def __init__(self, content: bytes):
        self.content = content
        at = len(content) - 1 - _TRAILER.size
        (self.number, self.nulls, self.tokens, ids, names, counts, self.documents,
         index, magic) = _TRAILER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a file of token blocks")
        starts = np.frombuffer(content, "<i8", ids + names + counts, index)
        self.blocks, self._names, self._counts = np.split(starts, [ids, ids + names])

    def ids_between(self, first: int, last: int) -> np.ndarray:
        """Tokens ``first`` up to, without, ``last`` of this file."""
        low = first // BLOCK
        found = unpack(self.content, self.blocks[low:-(-last // BLOCK)])
        return found[first - low * BLOCK:last - low * BLOCK]

    def names(self) -> list[int | None]:
        return [None] * self.nulls + np.cumsum(unpack(self.content, self._names)).tolist()

    def counts(self) -> np.ndarray:
        return unpack(self.content, self._counts)


def _documents(file: File) -> Iterator[pa.RecordBatch]:
    """Batches of (file, place, doc_id, from, tokens), a bounded number of bytes each."""
    names, counts = file.names(), file.counts()
    ends = np.cumsum(counts)
    starts = ends - counts
    place = 0
    while place < len(names):
        last = max(place + 1, int(np.searchsorted(ends, starts[place] + BYTES_AT_ONCE // 4, "right")))
        ids = file.ids_between(int(starts[place]), int(ends[last - 1])).astype("<u4")
        cuts = (starts[place:last] - starts[place]).tolist() + [len(ids)]
        yield pa.RecordBatch.from_arrays([
            pa.array([file.number] * (last - place), pa.int64()),
            pa.array(range(place, last), pa.int64()),
            pa.array(names[place:last], pa.int64()),
            pa.array(starts[place:last], pa.int64()),
            pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
        ], names=["file", "place", "doc_id", "offset", "tokens"])
        place = last


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def _totals(spark: SparkSession, path: str) -> DataFrame:
    """The number of tokens before each file; one row a file."""
    trailer = F.substring("content", -1 - _TRAILER.size, _TRAILER.size)

    def number(field: int):
        return F.conv(F.hex(F.substring(trailer, 8 * field + 1, 8)), 16, 10).cast("long")

    rows = _files(spark, path).select(number(0).alias("file"), number(2).alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, tokens) of all files: ``tokens`` as little-endian 32-bit numbers.

    ``start`` counts the tokens of all documents before it, in all files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield from _documents(File(content.as_py()))

    schema = "file long, place long, doc_id long, offset long, tokens binary"
    found = _files(spark, path).select("content").mapInArrow(run, schema)
    # One row of 16 bytes for each file of ``BYTES_A_FILE`` bytes of text.
    return found.join(F.broadcast(_totals(spark, path)), "file").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "tokens", "file", "place"
    )


def window(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """(start, ids): the tokens from ``start`` on, of each file that holds some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, before in zip(batch.column(0), batch.column(1).to_pylist()):
                file = File(content.as_py())
                first, last = max(0, start - before), min(file.tokens, start + length - before)
                if first < last:
                    ids = file.ids_between(first, last)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([before + first]), pa.array([ids], pa.list_(pa.int64()))],
                        names=["start", "ids"],
                    )

    number = F.conv(
        F.hex(F.substring("content", -1 - _TRAILER.size, 8)), 16, 10
    ).cast("long").alias("file")
    held = _files(spark, path).select("content", number)
    return held.join(F.broadcast(_totals(spark, path)), "file").select(
        "content", "before"
    ).mapInArrow(run, "start long, ids array<long>")
