"""SentencePiece encoding and decoding by a streaming Viterbi search.

The pieces and scores of a model file are read as they are; the ids of a text
are the segmentation with the largest sum of scores. The search walks through
the text and keeps scores and back pointers of a window of boundaries. Whenever
the back pointers of all boundaries that are still open lead through one
boundary, the ids before it are final: they are emitted and forgotten. The window
is at least four times the longest piece and doubles until the paths agree. So a
text of any length needs a small window and time in proportion, and no text is
cut.

Where no piece of the model crosses the start of a word, all paths agree there,
and what follows does not depend on what came before. Then the search runs word
by word, and a worker remembers the ids of a number of words; longer words
than ``LONGEST_REMEMBERED`` are searched again, to bound its memory.

As the model files ask: one space is put before the text, spaces become ``▁``,
nothing else is normalised; a character in no piece becomes its UTF-8 byte
pieces, or the unknown id if the model has none. Equal sums prefer the longest
last piece. Decoding undoes all of this; a ``▁`` in the text itself comes back
as a space.

Nulls: a null text has null ids, an empty one has none. Rows need no id; repeated
rows stay. An empty table gives an empty one. Columns of ``docs`` stay, but those
of the names that are added are replaced.
"""

from __future__ import annotations

import re
import weakref
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import list_array, map_batches

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED = 240_000
LONGEST_REMEMBERED = 64

_NEVER = float("-inf")


class Vocabulary:
    """Pieces, scores and special ids of a model file."""

    def __init__(self, path: str = DEFAULT_MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[float, int]] = {}
        self.bytes: list[int] = [-1] * 256
        self.surface: list[bytes] = []
        self.unknown = model.unk_id()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.surface.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i):
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.pieces[piece] = (model.get_score(i), i)
                self.surface.append(piece.replace(SPACE, " ").encode())
        self._derive()

    def _derive(self) -> None:
        self._encoder: Encoder | None = None
        # The pieces letter by letter: to each letter, what may follow, and the score and
        # id of the piece that ends there, if one does.
        leaf: dict = {}
        kids: dict[str, dict] = {"": {}}
        for piece in sorted({p[:n] for p in self.pieces for n in range(1, len(p) + 1)},
                            key=len, reverse=True):
            node = (kids.pop(piece, leaf), *self.pieces.get(piece, (None, None)))
            kids.setdefault(piece[:-1], {})[piece[-1]] = node
        self.letters: dict = kids[""]
        self.longest = max(map(len, self.pieces), default=1)
        self.lowest = min((s for s, _ in self.pieces.values()), default=0.0) - 10.0
        # Words are independent if the mark of a word's start only starts pieces.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        letters = {c for p in self.pieces for c in p}
        # Characters in no piece end what comes before them, like a word's start does.
        apart = "".join(re.escape(c) for c in "\n\t\r" if c not in letters)
        self.words = re.compile(f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+|[{apart}]" if apart
                                else f"{SPACE}*[^{SPACE}]+|{SPACE}+")


    def encoder(self, remembered: int) -> Encoder:
        if self._encoder is None:
            # The encoder goes with its vocabulary at once, not when cycles are looked for.
            self._encoder = Encoder(weakref.proxy(self), remembered)
        return self._encoder


def _bytes(vocabulary: Vocabulary, letter: str) -> list[int]:
    found = [vocabulary.bytes[b] for b in letter.encode()]
    return found if min(found) >= 0 else [vocabulary.unknown]


def stream_ids(vocabulary: Vocabulary, text: str) -> Iterator[list[int]]:
    """Lists of final ids, each as soon as all open paths agree on a boundary.

    Boundaries are counted from the last one agreed on. Agreement is looked for
    each time their number has doubled since it was last looked for, which walks
    the back pointers once, so the time is in proportion to the text.
    """
    pieces, letters, lowest = vocabulary.pieces, vocabulary.letters, vocabulary.lowest
    n, settled, longest = len(text), 0, vocabulary.longest
    least = 4 * longest
    attempt = least
    # Of each boundary: best score, start of the last piece, its id (None: unknown).
    room = min(n, attempt + longest) + 1
    score, back, known = [0.0, *[_NEVER] * (room - 1)], [0] * room, [None] * room
    for start in range(n):
        here = start - settled
        if here >= attempt:
            common = _meeting(back, here, score)
            if common:
                yield _path(vocabulary, text, back, known, common, settled)
                settled += common
                here -= common
                score, known = score[common:], known[common:]
                back = [max(b - common, 0) for b in back[common:]]
            attempt = max(least, 2 * here)
            more = min(n - settled, attempt + longest) + 1 - len(score)
            if more > 0:
                score += [_NEVER] * more
                back += [0] * more
                known += [None] * more
        following, reached, at = letters, score[here], here
        for letter in text[start:start + longest]:
            node = following.get(letter)
            if node is None:
                break
            at += 1
            following, worth, number = node
            if worth is not None and reached + worth > score[at]:
                score[at], back[at], known[at] = reached + worth, here, number
        if text[start] not in pieces and reached + lowest > score[here + 1]:
            score[here + 1], back[here + 1], known[here + 1] = reached + lowest, here, None
    if settled < n:
        yield _path(vocabulary, text, back, known, n - settled, settled)


def _meeting(back: list[int], here: int, score: list[float]) -> int:
    """The last boundary that the paths to ``here`` and all reached beyond it share."""
    ends = [here, *(i for i in range(here + 1, len(back)) if score[i] != _NEVER)]
    open_at = set(ends)
    place = ends[-1]
    while len(open_at) > 1:
        # The furthest open boundary steps back; where only one is left, all paths meet.
        if place in open_at:
            open_at.discard(place)
            open_at.add(back[place])
        place -= 1
    return open_at.pop()


def _path(
    vocabulary: Vocabulary, text: str, back: list[int], known: list[int | None], upto: int,
    settled: int,
) -> list[int]:
    path, at = [], upto
    while at:
        start, number = back[at], known[at]
        if number is None:
            path += reversed(_bytes(vocabulary, text[settled + start:settled + at]))
        else:
            path.append(number)
        at = start
    path.reverse()
    return path


class Encoder(dict):
    """Words, mapped to their ids as 32-bit numbers.

    Two generations are remembered, so words that come often are not forgotten
    when the newer one is full. The tasks of one worker share them.
    """

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        super().__init__()
        self.vocabulary, self.remembered = vocabulary, remembered
        self.older: dict[str, bytes] = {}

    def _search(self, text: str) -> bytes:
        return b"".join(array("i", ids).tobytes() for ids in stream_ids(self.vocabulary, text))

    def __missing__(self, word: str) -> bytes:
        if len(word) > LONGEST_REMEMBERED:
            return self._search(word)
        value = self.older.get(word)
        if value is None:
            value = self._search(word)
        if 2 * len(self) >= self.remembered:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.intc)
        marked = SPACE + text.replace(" ", SPACE)
        if self.vocabulary.by_word:
            found = b"".join(map(self.__getitem__, self.vocabulary.words.findall(marked)))
        else:
            found = self._search(marked)
        return np.frombuffer(found, np.intc)


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """The text of ids, in UTF-8."""
    text = b"".join(map(vocabulary.surface.__getitem__, ids.tolist()))
    return text[1:] if text.startswith(b" ") else text


def _shared(df: DataFrame, model: str | Vocabulary):
    """The vocabulary, read on the driver; its size is that of the model file."""
    held = model if isinstance(model, Vocabulary) else Vocabulary(model)
    return df.sparkSession.sparkContext.broadcast(held)


def _with(df: DataFrame, *added: str) -> StructType:
    new = StructType.fromDDL(", ".join(added)).fields
    names = {f.name for f in new}
    return StructType([f for f in df.schema if f.name not in names] + new)


def encode(
    docs: DataFrame, model: str | Vocabulary = DEFAULT_MODEL, with_decoded: bool = False,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The columns of ``docs`` and ``ids``; columns of the added names are replaced.

    ``with_decoded`` adds ``decoded``, what the ids decode to, in the same pass. A
    worker keeps the ids of ``remembered`` words (about 230 bytes each); fewer take
    more time and give the same ids.
    """
    shared = _shared(docs, model)
    added = ["ids array<int>", "decoded string"] if with_decoded else ["ids array<int>"]
    names = [a.split()[0] for a in added]
    kept = [i for i, c in enumerate(docs.columns) if c not in names]
    place = docs.columns.index("text")

    def rows():
        # A worker holds a broadcast value, and what it remembers of it, across tasks.
        vocabulary = shared.value
        encoder = vocabulary.encoder(remembered)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [
                None if text is None else encoder.ids(text)
                for text in batch.column(place).to_pylist()
            ]
            columns = [*(batch.column(i) for i in kept), list_array(found, pa.int32())]
            if with_decoded:
                columns.append(pa.array([
                    None if f is None else decode_ids(vocabulary, f).decode("utf-8", "replace")
                    for f in found
                ], pa.string()))
            return pa.RecordBatch.from_arrays(
                columns, names=[*(batch.schema.names[i] for i in kept), *names]
            )

        return apply

    return map_batches(docs, rows, _with(docs, *added))


def decode(encoded: DataFrame, model: str | Vocabulary = DEFAULT_MODEL) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the text of its ``ids``."""
    shared = _shared(encoded, model)
    kept = [i for i, c in enumerate(encoded.columns) if c != "decoded"]
    place = encoded.columns.index("ids")

    def rows():
        vocabulary = shared.value

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column(place)
            texts = [
                decode_ids(vocabulary, ids.values.to_numpy()).decode("utf-8", "replace")
                if ids.is_valid else None
                for ids in column
            ]
            columns = [batch.column(i) for i in kept]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string())],
                names=[*(batch.schema.names[i] for i in kept), "decoded"],
            )

        return apply

    return map_batches(encoded, rows, _with(encoded, "decoded string"))


def normalised(text: Column) -> Column:
    """What decoding the ids of a text gives back."""
    return F.translate(text, SPACE, " ")
