import random
import zlib

import numpy as np
import pytest

from barlab.llm import toxicity


@pytest.fixture(scope="module")
def table(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(
        f"{folder}/labels.parquet"
    )


@pytest.fixture(scope="module")
def model(table):
    return toxicity.train(*table)


def test_held_out_accuracy(spark, table, model):
    docs, labels = table
    scored = toxicity.score(docs.join(labels.select("doc_id"), "doc_id"), model)
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 900
    # Some texts of low quality were turned into junk after they had been marked.
    hit = np.mean([r.predicted for r in rows if r.toxic and r.quality])
    false = np.mean([r.predicted for r in rows if not r.toxic])
    assert hit > 0.9 and false < 0.01


def test_disguised_words_score_like_plain_ones(make_docs, model):
    clean = "the and of thion was this with that from "
    rows = [(i, clean + w + " " + clean) for i, w in enumerate(
        ["idiot", "1d10t", "i.d.i.o.t", "i d i o t", "idiooooot", "M0R0N", "w0rthl3ss", "$tup1d", "thing"]
    )]
    scores = {r.doc_id: r.score for r in toxicity.score(make_docs(rows), model).collect()}
    assert all(scores[i] >= 0.7 for i in range(8)) and scores[8] < 0.3


def test_fold_and_odd_rows(make_docs, model):
    rows = [(i, "x") for i in range(30)] + [(None, "x"), (-5, None), (7, ""), (7, "!!! ... 1234"),
                                            (9, "a " * 100_000), (10, "z" * 50_000)]
    found = toxicity.score(make_docs(rows), model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    for r in found:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert r.held_out == held and r.predicted == int(r.score >= 0.7)
    assert toxicity.score(make_docs(rows).limit(0), model).collect() == []


def test_labels_of_the_held_out_fold_are_not_read(spark, make_docs):
    rows = [(i, "good words here" if i % 2 else "bad nasty words") for i in range(60)]
    docs = make_docs(rows)
    marks = [(i, int(i % 2 == 0)) for i in range(60)]
    turned = [(i, m if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - m) for i, m in marks]
    schema = "doc_id long, toxic int"
    one = toxicity.train(docs, spark.createDataFrame([*marks, (None, 1), (3, None)], schema))
    other = toxicity.train(docs, spark.createDataFrame(turned, schema))
    assert one.weights == other.weights and one.intercept == other.intercept and one.weights


def test_no_labels_and_no_documents(spark, make_docs):
    docs = make_docs([(1, "a b")])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for d, x in ((docs, labels.limit(0)), (docs.limit(0), labels)):
        assert len(toxicity.score(docs, toxicity.train(d, x)).collect()) == 1


def test_trigrams_are_counted_over_all_words(make_docs):
    docs = make_docs([(1, "Ab, ab! a1b"), (2, "ab"), (3, None)])
    counts = {r.code: r.times for r in toxicity.trigram_counts(docs).collect()}
    n = len(toxicity.ALPHABET)
    assert counts == {1: 3, n + 2: 3, (n + 2) * n: 3}


def test_restored_texts(make_docs, model):
    docs = make_docs([(1, "the 1d10t said"), (2, None)])
    found = {r.doc_id: r.words for r in toxicity.restored(docs, model.characters).collect()}
    assert "idiot" in found[1] and found[2] == []


def test_every_mixed_or_spaced_word_is_restored(model):
    restorer = toxicity.Restorer(model.characters)
    for word in ("id107", "1d107", "!diot", "idi" + "o" * 60 + "t", ("-" * 12).join("idiot")):
        assert restorer[word] == "idiot", word
    for word in ("a55", "a$$", "pi55", "$h17", "stupid" * 20 + "5"):
        assert restorer[word].isalpha(), word
    assert restorer["idiot!"] == "idiot" and restorer["(thing)"] == "thing"
    for gap in ("  ", "\t", "\n", "  "):
        assert "idiot" in restorer.words("so " + gap.join("idiot") + " it"), gap


def test_long_mixed_words_cost_linear_time(model):
    assert len(model.characters.restore("a1b2c3$4" * 2_500)) > 10_000


def test_trigrams_equal_counting_one_by_one():
    from collections import Counter

    words = Counter({"abc": 3, "é": 2, "straße": 5, "日本": 1, "a" * 300: 2, "zz": 7})
    truth = np.zeros(toxicity._N ** 3, np.int64)
    for word, times in words.items():
        codes = [toxicity._SYMBOL.get(c, toxicity._OTHER) for c in word]
        line = [toxicity._EDGE, toxicity._EDGE, *codes, toxicity._EDGE]
        for x, y, z in zip(line, line[1:], line[2:]):
            truth[(x * toxicity._N + y) * toxicity._N + z] += times
    assert (toxicity._trigrams(words) == truth).all()
    assert toxicity._trigrams(Counter()).sum() == 0


def test_spaced_letters_are_looked_for_where_they_are():
    rng = random.Random(4)
    for _ in range(2_000):
        parts = rng.choices(["a", "b", "I", "5", "$", "word", "two", "é"], k=rng.randrange(1, 9))
        text = "".join(p + rng.choice([" ", "  ", "\n"]) for p in parts)
        if toxicity._SPACED.search(text):
            assert toxicity._spaced(text.split())


def readings(model, word):
    """{letters: best logarithm} over every path of the lattice, one by one."""
    drawn = {c for c, x, y in zip(word, word[1:], word[2:]) if c == x == y}
    found = {}

    def go(place, letters, total):
        if place == len(word):
            line = [toxicity._EDGE, toxicity._EDGE, *(toxicity._SYMBOL.get(c, toxicity._OTHER) for c in letters),
                    toxicity._EDGE]
            total += sum(model.log[(x * toxicity._N + y) * toxicity._N + z]
                         for x, y, z in zip(line, line[1:], line[2:]))
            found[letters] = max(total, found.get(letters, -np.inf))
            return
        c = word[place]
        options = [(c, toxicity._KEEP)] if c.isalpha() else []
        options += [(o, toxicity._STANDS_FOR) for o in toxicity.LOOKS_LIKE.get(c, "")]
        for letter, cost in options:
            go(place + 1, letters + letter, total + cost)
            if c in drawn and letters.endswith(letter):
                go(place + 1, letters, total + cost + toxicity._REPEAT)
        if not c.isalpha():
            drop = (toxicity._DROP_SEPARATOR if c in toxicity._SEPARATORS else
                    toxicity._DROP_LETTER if c in toxicity.LOOKS_LIKE else toxicity._DROP_SIGN)
            go(place + 1, letters, total + drop)

    go(0, "", 0.0)
    return found


def test_decoding_finds_the_best_of_all_paths():
    """Small lattices of all kinds of signs, under a model of random counts."""
    random.seed(6)
    counts = np.random.default_rng(6).integers(0, 50, toxicity._N ** 3)
    model = toxicity.CharacterModel(counts * (counts > 30))
    for _ in range(400):
        word = "".join(random.choices("abst15!6$.-*0é日", k=random.randrange(1, 7)))
        word += random.choice(["", "aaa", "555", "$$$"])
        truth = readings(model, word)
        assert truth[model.restore(word)] == pytest.approx(max(truth.values()), abs=1e-9), word
