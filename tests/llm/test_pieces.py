"""Encoding and decoding by pieces, against the library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from carledger.llm import pieces, queries

PATH = public_tokenizers.path(queries.PIECE_BPE)
SIGNS = [" ", "  ", "▁", "a", "b", "t", "th", "e", "é", "ß", "\n", "\t", "日", "🙂", "𝔘", "\x00", ".", "<s>", "<0x41>", "ing", "return", "́"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return pieces.load(PATH)


def odd_texts(n):
    draw = random.Random(5)
    texts = ["".join(draw.choice(SIGNS) * draw.choice([1, 1, 1, 2, 5, 17, 40]) for _ in range(draw.randint(0, 14))) for _ in range(n)]
    return [*texts, "", " ", "x" * 5000, " " * 3000, "ab cd " * 4000, "▁▁ ▁"]


def test_encode_equals_library(model, library):
    texts = odd_texts(3000)
    ids, sizes = pieces.Encoder(model).encode(texts)
    want = library.encode(texts)
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_words_alone_and_together_agree(model, library):
    encoder = pieces.Encoder(model)
    draw = random.Random(6)
    words = list({"".join(draw.choice("aeinrstdlé.,") for _ in range(draw.randint(1, 30))) for _ in range(3000)})
    encoder._learn(words)
    ends = np.cumsum(encoder.size)
    for word, end, size in zip(words, ends, encoder.size, strict=True):
        assert encoder.ids[end - size : end].tolist() == encoder.word("▁" + word)


def test_forgotten_words_come_out_the_same(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_WORDS", 50)
    encoder = pieces.Encoder(model)
    texts = [t for t in odd_texts(400) if t]
    for k in range(0, len(texts), 20):
        ids, _ = encoder.encode(texts[k : k + 20])
        assert ids.tolist() == [i for t in texts[k : k + 20] for i in library.encode(t)]


def test_decode_equals_library_for_any_ids(model, library):
    draw = random.Random(7)
    kinds = [lambda: draw.randint(0, 2), lambda: draw.randint(3, 258), lambda: draw.randint(259, 31999), lambda: model.ids["▁"]]
    lists = [[draw.choice(kinds)() for _ in range(draw.randint(0, 8))] for _ in range(5000)]
    flat = np.array([i for x in lists for i in x], np.int64)
    found = pieces.Decoder(model).decode(flat, np.array([len(x) for x in lists])).to_pylist()
    assert found == [library.decode(x) for x in lists]


def test_query_on_odd_rows(spark, library, tmp_path):
    texts = [None, "", "ab cd", "ab cd", "word " * 30000, "日本 🙂"]
    rows = [(i if i != 2 else None, t, "own") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_pieces(spark, str(tmp_path)).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert pieces.decode(pieces.encode(docs, PATH), PATH).columns == ["doc_id", "text", "ids", "decoded"]
    empty = pieces.round_trip(docs.limit(0), PATH)
    assert empty.count() == 0
