"""The divergence of sources, against a plain version and SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from carledger.llm import divergence

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def plain(rows, least_docs=10, top=10):
    """(lang, source, part, item, value, rank) from rows of (text, lang, source)."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lower = (text or "").translate(str.maketrans(LETTERS.upper(), LETTERS))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        share = lambda of: {t: 1 + 10**9 * (of[t] + 2) // (sum(of[x] for x in kept) + 2 * len(kept)) for t in kept}  # noqa: B023, E731
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def corpus(n, seed=1):
    draw = random.Random(seed)
    words = ["the", "The", "ÉTÉ", "été", "über", "a", "日本", "x" * 9, "x" * 8, "x" * 16, "x" * 17, "don't", "it's", "4th"]
    words += ["".join(draw.choice("abcdé") for _ in range(draw.randint(1, 11))) for _ in range(120)]
    sources = [None, "", "s1", "s2", "s3", "é", "hot", "hot", "hot", "hot"]
    rows = []
    for _ in range(n):
        text = " ".join(draw.choice(words[: draw.choice([14, 40, 134])]) for _ in range(draw.randint(0, 60)))
        rows.append((draw.choice([text, text, text, None, "", "12 34"]), draw.choice(["en", "en", "en", "de", None, "xx"]), draw.choice(sources)))
    return [*rows, rows[0], rows[0], ("alone 1", "zz", "only"), ("alone 1", "zz", "other")]


def test_multikey_sort_is_a_stable_sort():
    draw = random.Random(3)
    words = ["".join(draw.choice("ab") for _ in range(draw.choice([1, 2, 7, 8, 9, 16, 17, 40]))).encode() for _ in range(3000)]
    data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    start, size = divergence.word_pointers(data)
    order, runs = divergence.multikey_sort(data, start, size)
    assert order.tolist() == sorted(range(len(words)), key=lambda i: words[i])
    ranked = sorted(words)
    assert runs.tolist() == [i for i in range(len(ranked)) if i == 0 or ranked[i] != ranked[i - 1]]


def test_equals_plain_version(spark, monkeypatch):
    rows = corpus(900)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, source string, term int")
    found = lambda: sorted(map(tuple, divergence.divergence(docs).collect()))
    want = plain(rows)
    assert {r[2] for r in want} == {"pair", "term"} and any(r[4] == 0 for r in want)
    assert found() == want
    # Many slices of terms and blocks of sources, and documents cut into several sorted slices.
    for name, value in (("SLICE_ROWS", 40), ("SOURCES", 2), ("SLICE_WORDS", 7), ("CELLS", 16)):
        monkeypatch.setattr(divergence, name, value)
    assert found() == want


def test_one_document_over_slices(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_WORDS", 5)
    docs = spark.createDataFrame([("b a " * 40 + "c", "en", "s"), ("a", "en", "s")], "text string, lang string, source string")
    found = {(r.term, r.n, r.n_docs) for r in divergence.term_counts(docs).collect()}
    assert found == {("", 0, 0), ("a", 41, 2), ("b", 40, 1), ("c", 1, 1)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert divergence.divergence(docs).collect() == []


def test_equals_sql(spark, duck, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = sorted(map(tuple, divergence.divergence(docs).collect()))
    columns = "lang, source, part, item, value, rank"
    assert found == sorted(duck.execute(f"SELECT {columns} FROM ({divergence.ORACLE})").fetchall())


def test_multikey_sort_reads_eight_bytes_of_a_word_once(monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(2000)]
    data = np.frombuffer("\0".join(words).encode(), np.uint8)
    read, clip = [], np.clip
    monkeypatch.setattr(np, "clip", lambda a, *rest: read.append(np.size(a)) or clip(a, *rest))
    order, _ = divergence.multikey_sort(data, *divergence.word_pointers(data))
    assert [words[k] for k in order] == sorted(words) and sum(read) == len(words)
