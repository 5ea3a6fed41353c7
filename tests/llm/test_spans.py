"""Sliding sentence spans against a plain version of the same rule: null, equal and repeated ids, shifted and repeated passages."""

import random

import numpy as np
import pyarrow as pa
import pytest

from carledger.llm import spans, tables
from carledger.llm.bytewords import Hasher, batch_words, space_table, text_buffer


def sentences(text):
    """(words, start byte) of each sentence of a text."""
    column = pa.array([text])
    data, _ = text_buffer(column)
    (part,) = batch_words(column, space_table(), Hasher())
    found = spans.Sentences(data, part)
    words = [space_table()[data[i:j]].tobytes() for i, j in zip(part.start, part.end, strict=True)]
    cuts = found.word.tolist()
    return [(tuple(words[i:j]), int(b)) for i, j, b in zip(cuts[:-1], cuts[1:], found.start, strict=True)]


def plain(rows):
    """(doc_id, n_sentences, n_removed, text) from rows of (doc_id, text), with the text's hash in place of a third number."""
    places, cut = {}, [sentences(t) if t else [] for _, t, _ in rows]
    for (doc_id, _, mark), found in zip(rows, cut, strict=True):
        for i in range(len(found)):
            for j in range(i + 1, len(found) + 1):
                if j - i >= spans.SENTENCES and sum(len(w) for w, _ in found[i:j]) >= spans.WORDS:
                    key = tuple(w for ws, _ in found[i:j] for w in ws)
                    places.setdefault(key, []).append((doc_id is not None, doc_id or 0, mark, i, j))
                    break
    gone = {}
    for found in places.values():
        first = min(found)[:4]
        for p in found:
            if p[:4] != first:
                gone.setdefault(p[:3], set()).update(range(p[3], p[4]))
    out = []
    for (doc_id, text, mark), found in zip(rows, cut, strict=True):
        lost = gone.get((doc_id is not None, doc_id or 0, mark), set())
        kept = text
        if lost:
            data = text.encode()
            begin = [b for _, b in found] + [len(data)]
            begin[0] = 0
            kept = b"".join(data[begin[k] : begin[k + 1]] for k in range(len(found)) if k not in lost).decode().rstrip()
        out.append((doc_id, len(found), len(lost), kept))
    return out


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefgh") + str(draw.randint(0, 40)) + draw.choice(["", "", "", ".", "!", "\n"])
    own = lambda n: " ".join(word() for _ in range(n))
    passages = [own(n) for n in (25, 55, 60, 90)] + [" ".join(["same"] * 70)]
    texts = [" ".join([own(draw.randint(0, 30)), draw.choice(passages), own(draw.randint(0, 30))]) for _ in range(60)]
    texts += [passages[2] + " " + passages[2], "", None, "short. one.", passages[3], passages[3], texts[0], texts[0]]
    ids = [draw.choice([None, None, 5, 5, 6, *range(10, 60)]) for _ in texts]
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_version(spark, documents, seed):
    rows = corpus(seed)
    docs = documents(rows)
    marks = {r.text: r.mark for r in docs.selectExpr("text", "xxhash64(coalesce(text, '')) as mark").collect()}
    want = plain([(i, t, marks[t]) for i, t in rows])
    found = [(r.doc_id, r.n_sentences, r.n_removed, r.text) for r in spans.remove_repeats(docs.repartition(5)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sum(r[2] for r in want) > 100


def test_documents_without_id_are_documents_of_their_own(documents):
    passage = " ".join(f"p{i}" + ("." if i % 6 == 5 else "") for i in range(60)) + "."
    for key in (None, 5):
        found = spans.remove_repeats(documents([(key, passage + " One end."), (key, passage + " Another end.")])).collect()
        assert sorted(r.n_removed > 0 for r in found) == [False, True]


def test_filter_grows_with_its_keys(spark):
    assert tables.fitting(spark.range(10), 26) == tables.FILTER_BITS
    assert tables.fitting(spark.range(3_000_000), 26) == 26 and tables.fitting(spark.range(3_000_000), 24) == 24
    packed = tables.membership(spark.range(100).selectExpr("xxhash64(id) as k"), "k", 24)
    keys = np.array([r[0] for r in spark.range(100).selectExpr("xxhash64(id)").collect()], np.int64).view(np.uint64)
    assert tables.may_hold(packed, keys).all()
