import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barlab.llm import token_files
from barlab.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(tokenizer):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer)
    found.encode_special_tokens = True
    return found


def expected(library, rows):
    """(doc_id, start, ids) of (doc_id, text), one whole text after the other."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


def found(spark, docs, path, tokenizer, **options):
    token_files.write(docs, path, tokenizer, **options)
    rows = token_files.read(spark, path).collect()
    return sorted(
        ((r.doc_id, r.start, np.frombuffer(r.tokens, "<u4").tolist()) for r in rows),
        key=lambda r: r[1],
    )


def offsets(records):
    return np.cumsum([0, *(len(r) for r in records)][:-1])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 63), st.integers(1, 3 * token_files.BLOCK),
       st.sampled_from([1, 50, 95, 100]))
def test_blocks_give_back_all_numbers(seed, bits, count, percent):
    rng = np.random.default_rng(seed)
    values = rng.integers(-(1 << bits) + 1, 1 << bits, count, dtype=np.int64)
    values[rng.random(count) < 0.02] = rng.integers(-(1 << 62), 1 << 62)
    records = token_files.pack(values, percent)
    assert len(records) == -(-count // token_files.BLOCK)
    assert (token_files.unpack(b"".join(records), offsets(records)) == values).all()


@pytest.mark.parametrize("values", [
    [7], [0] * 5000, [-(2**63), 2**63 - 1], [2**63 - 1] * 4096 + [-(2**63)], list(range(9000)),
])
def test_blocks_of_odd_numbers(values):
    records = token_files.pack(np.array(values, np.int64))
    back = token_files.unpack(b"".join(records), offsets(records))
    assert back.tolist() == values


def test_outliers_do_not_widen_a_block():
    """Width of the 95th percentile; what is above costs its place and high bits."""
    values = np.arange(token_files.BLOCK) % 16
    plain = len(token_files.pack(values)[0])
    values[::100] = 1 << 30
    assert len(token_files.pack(values)[0]) == plain + 41 * (2 + 4)
    assert plain == token_files._HEAD.size + token_files.BLOCK * 4 // 8


def test_files_equal_whole_texts_one_by_one(spark, documents, texts, tokenizer, library, tmp_path):
    truth = expected(library, texts.items())
    assert found(spark, documents, str(tmp_path / "a"), tokenizer) == truth
    assert found(spark, documents, str(tmp_path / "b"), tokenizer, bytes_a_file=10_000) == truth


def test_query_equals_brute_force(spark, texts, library):
    rows = QUERIES["op11_token_files"](spark, FOLDER).collect()
    truth = {
        (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for i, start, ids in expected(library, texts.items())
    }
    assert len(rows) == len(truth) and {tuple(r) for r in rows} == truth


def test_any_range_of_tokens(spark, documents, texts, tokenizer, library, tmp_path):
    path = str(tmp_path / "files")
    token_files.write(documents, path, tokenizer)
    stream = [i for _, _, ids in expected(library, texts.items()) for i in ids]
    for start, length in [(0, 1), (4095, 2), (10_000, 30_000), (len(stream) - 3, 99), (5, 0)]:
        parts = sorted(token_files.window(spark, path, start, length).collect())
        assert [i for p in parts for i in p.ids] == stream[start:start + length]


def test_odd_rows(spark, make_docs, tokenizer, library, tmp_path):
    rows = [
        (5, None), (3, ""), (-4, " \n two  spaces \t"), (9, "日本語 🎉 é <|endoftext|> x"),
        (None, "no id"), (None, None), (3, "same id"), (3, ""), (2**62, "a" * 50_000),
        (-(2**63), "low word " * 30_000), (7, "\x00\x85   x \x1c y"),
    ]
    got = found(spark, make_docs(rows), str(tmp_path / "odd"), tokenizer)
    ends = [s + len(ids) for _, s, ids in got]
    assert [s for _, s, _ in got] == [0, *ends[:-1]]
    names = [i for i, _, _ in got]
    assert names == sorted(names, key=lambda i: (i is not None, i))
    truth = sorted((str(i), ids) for i, _, ids in expected(library, rows))
    assert sorted((str(i), ids) for i, _, ids in got) == truth


def test_no_rows(spark, make_docs, tokenizer, tmp_path):
    path = str(tmp_path / "none")
    assert found(spark, make_docs([(1, "x")]).limit(0), path, tokenizer) == []
    assert token_files.window(spark, path, 0, 5).collect() == []


def test_parts_of_a_text_are_encoded_as_in_the_whole(tokenizer, library):
    """Random strings of the signs that decide where tokens may begin."""
    with open(tokenizer, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    rng = random.Random(3)
    signs = [" ", "  ", "\n", "\t", "a", "b1", "é", "'s", "'ll", "!", "\x85", "\x1c", "日", "😀",
             "᠎", "​", " ", "9", "<|endoftext|>"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(16))) for _ in range(3_000)]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_are_merged_once_whatever_stands_beside_them(tokenizer, library):
    """Texts of plain signs: each word and mark goes to the model once, as the whole text gives it."""
    with open(tokenizer, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    merged, model = [], encoder.pieces.merged
    encoder.pieces.merged = lambda piece: merged.append(piece) or model(piece)
    handed, whole = [], encoder._whole
    encoder._whole = lambda texts: handed.extend(texts) or whole(texts)
    text = "on straße, straße. straße!\nÉté straße\nÉté (straße) 12straße don't"
    got = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids
    assert handed == ["on"] and len(merged) == len(set(merged))
    rng = random.Random(4)
    signs = [*map(chr, range(32, 127)), *"\n\t\r ßéÿÀ×÷ªµº\x7f\x00\xa0²", "  ", " ", "'s", "'re", "ab", "été"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(24))) for _ in range(6_000)]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_remembered_parts_and_pieces_stay_bounded(tokenizer, library, monkeypatch):
    monkeypatch.setattr(token_files, "PARTS", 60)
    with open(tokenizer, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    for n in range(40):
        text = " ".join(f"word{n}x{i},\nnext{i % 7}" for i in range(9))
        got = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids
        for held in (encoder.known, encoder.pieces):
            assert len(held) <= 30 + 9 * 7 and len(held.older) <= 30 + 9 * 7
            assert held.chars == sum(map(len, held))


def test_new_words_of_many_texts_are_merged_in_one_call(tokenizer, library):
    """Not one call a word, which cost most of the time; and none while they are remembered."""
    with open(tokenizer, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    merged, model = [], encoder.pieces.merged
    encoder.pieces.merged = lambda pieces: merged.append(pieces) or model(pieces)
    texts = [f"on zorb{n % 50}, zörb zorblet.\nThe zörb\nzorblets (zorb) {n}" for n in range(200)]
    truth = [library.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(2):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
        assert got == truth and len(merged) == 1
    assert len(merged[0]) == len(set(merged[0])) and " zörb" in merged[0]


@pytest.mark.parametrize("limits", [(60, 3), (500_000, 2048)])
def test_texts_of_all_kinds_together(tokenizer, library, monkeypatch, limits):
    """Empty texts, doubled spaces, other scripts and plain words side by side, again and again."""
    monkeypatch.setattr(token_files, "PARTS", limits[0])
    monkeypatch.setattr(token_files, "PARTS_AT_ONCE", limits[1])
    with open(tokenizer, encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read())
    rng = random.Random(5)
    words = ["", "a", "été", "x\ny", "\t", "日本", "don't", "“so”", "12é", "\0", "<|endoftext|>", "w\n\n"]
    texts = [" ".join(rng.choices(words + [f"v{n}"], k=rng.randrange(12))) for n in range(400)]
    for start in range(0, 400, 40):
        for some in (texts[start:start + 40], texts[:7], []):
            got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(some)]
            assert got == [library.encode(text, add_special_tokens=False).ids for text in some]


def test_portions_hold_each_row_once(monkeypatch):
    monkeypatch.setattr(token_files, "TEXT_BYTES_AT_ONCE", 10)
    texts = [b"1234", None, b"123456", b"1", b"x" * 25, b"", b"123", None]
    batch = token_files.pa.RecordBatch.from_arrays(
        [token_files.pa.array(range(8)), token_files.pa.array(texts, "binary")], ["doc_id", "text"]
    )
    portions = [p.column(0).to_pylist() for p in token_files._portions(batch)]
    assert portions == [[0, 1, 2], [3], [4], [5, 6, 7]]
    assert list(token_files._portions(batch.slice(0, 0))) == []
