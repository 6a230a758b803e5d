import gc
import random
import time
import weakref

import pytest

from barlab.llm import pieces
from barlab.llm.pieces import DEFAULT_MODEL, SPACE, Vocabulary


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(DEFAULT_MODEL)


def brute(vocabulary, text):
    """The whole table of the best segmentations, longest last piece on equal sums."""
    best = [(0.0, None)]
    for end in range(1, len(text) + 1):
        options = []
        for start in range(max(0, end - vocabulary.longest), end):
            held = vocabulary.pieces.get(text[start:end])
            if held:
                options.append((best[start][0] + held[0], -start, held[1]))
            elif start == end - 1:
                options.append((best[start][0] + vocabulary.lowest, -start, None))
        score, start, known = max(options, key=lambda o: (o[0], o[1]))
        best.append((score, (-start, known)))
    ids, at = [], len(text)
    while at:
        start, known = best[at][1]
        ids = (pieces._bytes(vocabulary, text[start:at]) if known is None else [known]) + ids
        at = start
    return ids


def test_stream_equals_the_whole_table(vocabulary, texts):
    encoder = pieces.Encoder(vocabulary)
    for text in list(texts.values())[:40]:
        text = text[:3_000]
        assert encoder.ids(text).tolist() == brute(vocabulary, SPACE + text.replace(" ", SPACE))


def test_stream_of_text_without_word_starts(vocabulary):
    rng = random.Random(1)
    for _ in range(20):
        text = "".join(rng.choice("abcdeintrs日本語é▁") for _ in range(rng.randrange(1, 400)))
        parts = list(pieces.stream_ids(vocabulary, text))
        assert [i for p in parts for i in p] == brute(vocabulary, text)


def test_commits_before_the_end(vocabulary):
    parts = list(pieces.stream_ids(vocabulary, "international" * 50))
    assert len(parts) > 10


@pytest.mark.parametrize("sign", ["a", "-", " ", "é", "\x00"])
def test_time_grows_with_the_run(vocabulary, sign):
    """Runs of one sign, whose paths may never agree, take time in proportion."""
    taken = []
    for n in (20_000, 100_000):
        began = time.process_time()
        parts = list(pieces.stream_ids(vocabulary, sign * n))
        taken.append(time.process_time() - began)
        assert b"".join(vocabulary.surface[i] for p in parts for i in p).decode() == sign * n
    assert taken[1] < 15 * taken[0] + 1 and taken[1] < 30


def test_window_is_agreed_on_late(vocabulary):
    """Runs that stay undecided over several windows, then end: as the whole table has it."""
    rng = random.Random(2)
    for _ in range(30):
        text = "".join(rng.choice("a-e") * rng.randrange(1, 300) for _ in range(4))
        parts = [i for p in pieces.stream_ids(vocabulary, text) for i in p]
        assert parts == brute(vocabulary, text)


def test_equals_the_library_as_a_unigram_model(vocabulary, texts):
    """The same file read as a unigram model segments plain words in the same way.

    Its lattice search is asked; the plain one adds up 32-bit floats, and the
    file's scores of -1e9 leave those too coarse.
    """
    model_proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    proto = model_proto.ModelProto()
    with open(DEFAULT_MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    encoder = pieces.Encoder(vocabulary)
    words = {w for t in texts.values() for w in t.split() if w.isascii()}
    for word in sorted(words)[::5]:
        assert encoder.ids(word).tolist() == library.nbest_encode_as_ids(word, 2)[0]


def test_round_trip_and_rows(spark, vocabulary, make_docs):
    rows = [
        (1, None), (2, ""), (3, " "), (4, "  two  spaces \n\ttabs "), (5, "日本語 🎉 é"), (None, "x"),
        (6, "a" * 20_000), (7, "word " * 20_000), (8, "\x00\x7f"), (2, ""),
    ]
    docs = make_docs(rows)
    encoded = pieces.encode(docs)
    found = pieces.decode(encoded).collect()
    assert encoded.columns == [c for c in docs.columns if c != "ids"] + ["ids"]
    assert sorted(((r.doc_id, r.decoded) for r in found), key=str) == sorted(rows, key=str)
    assert {r.ids is None for r in found if r.text is None} == {True}
    assert {len(r.ids) for r in found if r.text == ""} == {0}
    assert pieces.decode(pieces.encode(docs.limit(0))).collect() == []
    at_once = pieces.encode(docs, with_decoded=True)
    assert sorted(map(str, at_once.collect())) == sorted(map(str, found))


def test_mark_in_the_text_becomes_a_space(vocabulary):
    ids = pieces.Encoder(vocabulary).ids("a▁b")
    assert pieces.decode_ids(vocabulary, ids) == b"a b"


def test_equals_the_library_when_decoding(vocabulary, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=DEFAULT_MODEL)
    encoder = pieces.Encoder(vocabulary)
    for text in list(texts.values())[:20]:
        ids = encoder.ids(text)
        assert pieces.decode_ids(vocabulary, ids).decode() == text == library.decode(ids.tolist())


def test_what_a_worker_remembers_goes_with_the_model():
    """Without the collector of cycles, which seldom looks at what has stayed for long."""
    gc.disable()
    try:
        model = Vocabulary()
        assert len(model.encoder(100).ids("some words")) and model.encoder(100)
        held = weakref.ref(model), weakref.ref(model.encoder(100))
        del model
        assert [h() for h in held] == [None, None]
    finally:
        gc.enable()
