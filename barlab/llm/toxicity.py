"""Toxicity of whole texts, scored after undoing disguised spelling.

1. A character trigram model is counted over the words of all documents. Each
   task counts its words and sends trigram totals, of which there are at most
   ``len(ALPHABET) ** 3``.
2. A noisy channel turns a disguised word into a lattice: every character stays,
   stands for a letter it looks like, is a separator to drop, or repeats the
   letter before it. Viterbi decoding finds the likeliest letters under the
   trigram model. Letters set apart by white space are joined into one word first.
   Every word that mixes letters with look-alike signs is decoded, of any length;
   plain words have one path only and are taken as they are. A ``!`` at the end
   of a word and brackets around it are punctuation.
3. The restored words give the features: the words and their beginnings. Those
   that tell the labelled rows apart best (chi-squared over a bounded sample of
   labelled rows) enter a logistic regression by their presence anywhere in the
   text, so one passage decides, however long the text around it. A beginning
   that two different words of a text share is a feature of its own.

Only labels outside the held-out fold are read: rows whose ``crc32`` of the id
as text has remainder ``HELD_OUT`` modulo ``FOLDS`` are never learned from.
Language, source and id are no inputs of a score.

Nulls: a null or empty text has no words and the score of the intercept. A row
with a null id is scored and counts as not held out; labels with a null id or
mark are not used. Rows that repeat an id are scored each. Texts of any length are
read whole, by one task each. Of equally telling features the smaller code is
chosen, of equally likely readings the later one in code order. An empty table, or
one without labels, gives scores of the intercept alone, for each row there is;
further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import batch_of, list_array, longs, map_batches

SAMPLE = 12_000
FEATURES = 600
LEAST_ROWS = 5
MARKED_WEIGHT = 3.0
FOLDS, HELD_OUT = 3, 1
REMEMBERED = 200_000
BEGINNINGS = (3, 4, 5, 6, 7, 8)
SHORT = 6  # a beginning of up to so many signs, its mark included, is remembered

# The letters the trigram model tells apart; any other one is the last symbol.
ALPHABET = " abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþßÿ?"
_SYMBOL = {c: i for i, c in enumerate(ALPHABET)}
_OTHER, _EDGE, _N = len(ALPHABET) - 1, 0, len(ALPHABET)
# The symbol of each code point; the last is that of all further ones, a line end is an edge.
_CODES = np.full(max(map(ord, ALPHABET)) + 2, _OTHER, np.int64)
_CODES[list(map(ord, ALPHABET))] = range(_N)
_CODES[ord("\n")] = _EDGE

# Letters that a digit or sign is often written for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e",
    "£": "l", "¡": "i", "§": "s", "µ": "u",
}
_SEPARATORS = frozenset("._-*~'`^·​‌‍­")

# Logarithms of the channel's probabilities.
_KEEP, _STANDS_FOR, _REPEAT = 0.0, np.log(0.2), np.log(0.5)
_DROP_SEPARATOR, _DROP_SIGN, _DROP_LETTER = np.log(0.3), np.log(0.05), np.log(1e-6)

_EDGES = ".,;:?!\"'()[]{}<>*%&#=/\\~`_-…«»“”„’‘"
_DISGUISE = re.compile(
    r"[^\W\d_][0-9@$!|+(<€£¡§µ.\-*~'`^·​‌‍­_]+[^\W\d_]"
    r"|([^\W\d_])\1\1"
)
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_LETTER = re.compile(r"[^\W\d_]")
_SIGN = re.compile(f"[{re.escape(''.join(LOOKS_LIKE))}]")
_SPACED = re.compile(
    r"(?<!\S)(?:[^\W\d_]|[0-9@$!|])\s++(?:[^\W_]|[@$!|])(?:\s++(?:[^\W_]|[@$!|]))+(?!\S)"
)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(code, times): how often each symbol follows two others, over all words of all texts."""

    def run(batches):
        seen: Counter = Counter()
        totals = np.zeros(_N ** 3, np.int64)

        def settle() -> None:
            nonlocal totals
            totals += _trigrams(seen)
            seen.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(text.lower().split())
                    if len(seen) > REMEMBERED:
                        _keep_plain(seen)
                        settle()
        _keep_plain(seen)
        settle()
        codes = np.flatnonzero(totals)
        yield batch_of(code=longs(codes), times=longs(totals[codes]))

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "code long, times long")
    return counted.groupBy("code").agg(F.sum("times").alias("times"))


def _trigrams(words: Counter) -> np.ndarray:
    """Counts of all trigrams of the words, each with two edges before it and one after."""
    if not words:
        return np.zeros(_N ** 3, np.int64)
    # An edge is written as a line end, which no word has.
    said = np.frombuffer(("\n\n" + "\n\n\n".join(words) + "\n").encode("utf-32-le"), "<u4")
    codes = _CODES[np.minimum(said, len(_CODES) - 1)]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 3
    times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), lengths)
    # The first two places of a word are its edges, and no trigram ends there.
    ends = np.ones(len(codes), bool)
    starts = np.cumsum(lengths) - lengths
    ends[starts] = ends[starts + 1] = False
    at = np.flatnonzero(ends)
    index = (codes[at - 2] * _N + codes[at - 1]) * _N + codes[at]
    return np.bincount(index, times[at], _N ** 3).astype(np.int64)


def _keep_plain(seen: Counter) -> None:
    """Keep plain words only, without the signs around them."""
    plain: Counter = Counter()
    for word, times in seen.items():
        core = word.strip(_EDGES)
        if core.isalpha():
            plain[core] += times
    seen.clear()
    seen.update(plain)


class CharacterModel:
    """Logarithms of trigram probabilities, smoothed with bigrams and unigrams."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(_N, _N, _N).astype(float)
        bi = tri.sum(0)
        one = bi.sum(0)
        p_one = (one + 1) / (one.sum() + _N)
        p_bi = (bi + 5 * p_one) / (bi.sum(1, keepdims=True) + 5)
        p_tri = (tri + 5 * p_bi[None, :, :]) / (tri.sum(2, keepdims=True) + 5)
        self.log = np.log(p_tri).reshape(-1).tolist()
        # Paths that go on alike differ in two trigrams, and in one that another repeats.
        self.behind = -3 * min(self.log) + 1

    def restore(self, word: str) -> str:
        """The likeliest letters behind a disguised word (Viterbi over its lattice).

        A state is the last two letters; a step keeps the best path to each state, as
        (letters before, letter). The cost is linear in the length: states that even the
        rarest trigrams of another path could not bring back to the front are left out.
        """
        log = self.log
        drawn_out = {c for c, again, more in zip(word, word[1:], word[2:]) if c == again == more}
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(_EDGE, _EDGE): (0.0, None)}
        for c in word:
            step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            options = [(c, _KEEP)] if c.isalpha() else []
            options += [(o, _STANDS_FOR) for o in LOOKS_LIKE.get(c, "")]
            drop = (
                _DROP_SEPARATOR if c in _SEPARATORS
                else _DROP_LETTER if c in LOOKS_LIKE else _DROP_SIGN
            )
            for (before, last), (score, letters) in best.items():
                for letter, cost in options:
                    code = _SYMBOL.get(letter, _OTHER)
                    new = score + cost + log[(before * _N + last) * _N + code]
                    key = (last, code)
                    if key not in step or new > step[key][0]:
                        step[key] = (new, (letters, letter))
                    if c in drawn_out and letters and letters[1] == letter:
                        again = score + cost + _REPEAT
                        key = (before, last)
                        if key not in step or again > step[key][0]:
                            step[key] = (again, letters)
                if not c.isalpha():
                    gone = score + drop
                    key = (before, last)
                    if key not in step or gone > step[key][0]:
                        step[key] = (gone, letters)
            best = step
            if len(best) > 32:
                least = max(score for score, _ in best.values()) - self.behind
                best = {key: state for key, state in best.items() if state[0] >= least}
        ends = [
            (score + log[(before * _N + last) * _N + _EDGE], letters)
            for (before, last), (score, letters) in best.items()
        ]
        top = max(score for score, _ in ends)
        return max(_spelled(letters) for score, letters in ends if score == top)


def _spelled(letters: tuple | None) -> str:
    found = []
    while letters:
        letters, letter = letters
        found.append(letter)
    return "".join(reversed(found))


def character_model(docs: DataFrame) -> CharacterModel:
    counts = np.zeros(_N ** 3, np.int64)
    for row in trigram_counts(docs).collect():  # at most _N ** 3 rows
        counts[row.code] = row.times
    return CharacterModel(counts)


class Restorer(dict):
    """Words as written, mapped to their restored lower-case form."""

    def __init__(self, model: CharacterModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> str:
        if len(self) >= REMEMBERED:
            self.clear()
        lower = word.lower()
        core = lower.strip(_EDGES)
        if core.isalpha() and "!" not in word and not _TRIPLE.search(core):
            self[word] = core
            return core
        disguised = lower.strip(".,;:?\"'")
        if not core.isalpha() or _DISGUISE.search(core) or disguised[:1] == "!":
            mixed = _SIGN.search(core) or disguised[:1] == "!"
            if mixed and _LETTER.search(core) or _DISGUISE.search(disguised):
                core = self.model.restore(disguised)
        self[word] = core
        return core

    def words(self, text: str | None) -> set[str]:
        if not text:
            return set()
        written_words = text.split()
        found = set(map(self.__getitem__, set(written_words)))
        if _spaced(written_words):
            for run in _SPACED.finditer(text):
                found.add(self.model.restore("".join(run.group().split()).lower()))
        return found


def _spaced(words: list[str]) -> bool:
    """Whether three words in a row have a single sign, as spaced letters do."""
    lengths = list(map(len, words))
    if lengths.count(1) < 3:
        return False
    single = np.array(lengths) == 1
    return bool((single[:-2] & single[1:-1] & single[2:]).any())


def _word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}~" for n in BEGINNINGS if len(word) >= n)]


def _code(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode()) - (1 << 63)


class _Beginnings(dict):
    """Codes of the shorter beginnings of words, which are far fewer than words."""

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[feature] = _code(feature)
        return value


def _codes_of(word: str, known: _Beginnings) -> list[int]:
    if not word:
        return []
    whole, *beginnings = _word_features(word)
    return [_code(whole), *(known[b] if len(b) <= SHORT else _code(b) for b in beginnings)]


# Turns the code of a feature into that of several words having it.
_SHARED = 0x5DEECE66D


class _Codes(dict):
    def __init__(self):
        super().__init__()
        self.beginnings = _Beginnings()

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = _codes_of(word, self.beginnings)
        return value


class ToxicityModel:
    """The chosen features with their weights, and the character model they rest on."""

    def __init__(self, characters: CharacterModel, weights: dict[int, float], intercept: float):
        self.characters, self.weights, self.intercept = characters, weights, intercept
        self._tools: tuple[Restorer, _Scorer] | None = None

    def tools(self) -> tuple[Restorer, _Scorer]:
        """What remembers words; the tasks of a worker share the broadcast model, and so this."""
        if self._tools is None:
            self._tools = Restorer(self.characters), _Scorer(self.weights)
        return self._tools


class _Scorer(dict):
    """The chosen features of a restored word: mostly none."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.chosen = weights.keys() | {c ^ _SHARED for c in weights}
        self.beginnings = _Beginnings()

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        codes = _codes_of(word, self.beginnings)
        if self.chosen.isdisjoint(codes):
            value = self[word] = ()
        else:
            value = self[word] = tuple(c for c in codes if c in self.chosen)
        return value


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _with_shared(counts: Counter) -> set[int]:
    """The features of a text, and apart those that several of its words have."""
    return {*counts, *(c ^ _SHARED for c, n in counts.items() if n > 1)}


def _features_of(texts: list[str | None], restorer: Restorer, codes: _Codes) -> list[set[int]]:
    return [_with_shared(Counter(c for w in restorer.words(t) for c in codes[w])) for t in texts]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic) outside the held-out fold."""
    spark = docs.sparkSession
    characters = character_model(docs)
    shared = spark.sparkContext.broadcast(characters)
    chosen = (
        labels.filter("doc_id is not null and toxic is not null")
        .select(F.col("doc_id").cast("long").alias("marked"), F.col("toxic").cast("int"))
        .filter(fold(F.col("marked")) != HELD_OUT)
        .orderBy(F.xxhash64("marked"), "marked", "toxic").limit(sample)
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    # At most ``sample`` rows are broadcast.
    rows = written(
        texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["marked"])
        .select("doc_id", "toxic", "text"),
        "toxic-sample",
    )

    def count():
        restorer, codes = Restorer(shared.value), _Codes()

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            toxic, clean = Counter(), Counter()
            marks = batch.column(0).to_pylist()
            found = _features_of(batch.column(1).to_pylist(), restorer, codes)
            for mark, features in zip(marks, found, strict=True):
                (toxic if mark else clean).update(features)
            names = list(toxic | clean)
            return batch_of(
                code=longs(names), toxic=longs([toxic[c] for c in names]),
                clean=longs([clean[c] for c in names]),
            )

        return apply

    counted = map_batches(rows.select("toxic", "text"), count, "code long, toxic long, clean long")
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    a, b = F.col("toxic"), F.col("clean")
    share = (a + b) / max(n_toxic + n_clean, 1)
    lift = (a / max(n_toxic, 1) - share) / F.sqrt(share * (1 - share) + 1e-9)
    best = (
        counted.groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= LEAST_ROWS)
        .orderBy(lift.desc(), "code").limit(FEATURES)
    )
    names = sorted(r.code for r in best.collect())  # at most FEATURES rows
    place = {code: i for i, code in enumerate(names)}

    def present():
        restorer, codes = Restorer(shared.value), _Codes()

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = _features_of(batch.column(1).to_pylist(), restorer, codes)
            return batch_of(
                toxic=batch.column(0),
                index=list_array(
                    [np.array(sorted(place[c] for c in f if c in place), np.int32) for f in found],
                    pa.int32(),
                ),
            )

        return apply

    seen = map_batches(rows.select("toxic", "text"), present, "toxic int, index array<int>")
    # Rows with the same features and mark count together; at most ``sample`` are left.
    groups = seen.groupBy("toxic", "index").agg(F.count("*").alias("n")).orderBy(
        "toxic", "index"
    ).collect()
    weights, intercept = _logistic(groups, len(names))
    return ToxicityModel(
        characters, dict(zip(names, weights.tolist(), strict=True)), float(intercept)
    )


def _logistic(groups, size: int, steps: int = 1_000, penalty: float = 1e-5, rate: float = 0.2):
    """Weights and intercept by Adam on weighted groups of equal rows."""
    marks = np.array([r.toxic for r in groups], float)
    # Marked rows are few; without more weight one marked word would not outweigh the intercept.
    times = np.array([r.n * (MARKED_WEIGHT if r.toxic else 1.0) for r in groups])
    lengths = [len(r["index"]) for r in groups]
    row_of = np.repeat(np.arange(len(groups)), lengths)
    index = np.array([i for r in groups for i in r["index"]], np.int64)
    theta = np.zeros(size + 1)
    if not len(groups):
        return theta[:size], theta[size]
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    total = times.sum()
    for step in range(1, steps + 1):
        score = np.bincount(row_of, theta[index], len(groups)) + theta[size]
        error = (0.5 * (1 + np.tanh(score / 2)) - marks) * times / total
        gradient = np.append(
            np.bincount(index, error[row_of], size) + penalty * theta[:size], error.sum()
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient ** 2
        theta = theta - rate * (mean / (1 - 0.9 ** step)) / (
            np.sqrt(square / (1 - 0.999 ** step)) + 1e-8
        )
    return theta[:size], theta[size]


def score(docs: DataFrame, model: ToxicityModel, least: float = 0.7) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    packed = docs.sparkSession.sparkContext.broadcast(model)  # bounded by _N ** 3 and FEATURES

    def rows():
        fitted = packed.value
        restorer, scorer = fitted.tools()

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            sums = []
            for text in batch.column(1).to_pylist():
                counts = Counter(c for w in restorer.words(text) for c in scorer[w])
                sums.append(fitted.intercept + sum(
                    fitted.weights.get(c, 0.0) for c in sorted(_with_shared(counts))
                ))
            scores = 0.5 * (1 + np.tanh(np.array(sums) / 2))
            return batch_of(doc_id=batch.column(0), score=pa.array(scores))

        return apply

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    scored = map_batches(source, rows, "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= least).cast("int").alias("predicted"),
    )


def restored(docs: DataFrame, characters: CharacterModel) -> DataFrame:
    """(doc_id, words): the distinct restored words of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(characters)

    def rows():
        restorer = Restorer(shared.value)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [sorted(restorer.words(t)) for t in batch.column(1).to_pylist()]
            return batch_of(doc_id=batch.column(0), words=pa.array(found, pa.list_(pa.string())))

        return apply

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return map_batches(source, rows, "doc_id long, words array<string>")
