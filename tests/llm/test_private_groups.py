"""Terms that disclose entities, against plain counts; copies of long lists."""

import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from carledger.llm import private
from tests.llm import brute


def plain(texts):
    """All term spans (start, end) of each text."""
    terms = [[(m.start(), m.end()) for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", t)] for t in texts]
    low = [brute.low(t) for t in texts]
    every = [{t[i:j] for i, j in spans} for t, spans in zip(low, terms, strict=True)]
    # What a base span covers is no term, but counts as an occurrence of its words.
    base = [[s[1:] for s in brute.personal(t)] for t in texts]
    terms = [[(i, j) for i, j in spans if not any(i < b and a < j for a, b in found)] for spans, found in zip(terms, base, strict=True)]
    words = [{t[i:j] for i, j in spans} for t, spans in zip(low, terms, strict=True)]
    own = [{t[i:j].lower() if k == "email" else re.sub("[^0-9]", "", t[i:j]) if k != "ip" else t[i:j] for k, i, j in brute.personal(t)} for t in texts]
    n, nt = len(texts), Counter(w for ws in every for w in ws)
    docs = defaultdict(set)
    for d, entities in enumerate(own):
        for e in entities:
            docs[e].add(d)
    telling = defaultdict(set)
    for held in docs.values():
        if len(held) < private.SUPPORT or len(held) == n:
            continue
        both = Counter(w for d in held for w in words[d])
        for w, nte in both.items():
            if nte >= private.SUPPORT and math.log(n * nte / (nt[w] * len(held))) / math.log(n / len(held)) >= private.THRESHOLD - 1e-12:
                for d in held:
                    telling[d].add(w)
    return [[(i, j) for i, j in spans if t[i:j] in telling[d]] for d, (t, spans) in enumerate(zip(low, terms, strict=True))]


def test_terms_equal_plain_counts(spark):
    draw = random.Random(1)
    people = [(f"person{i}", f"p{i}@mail.example.com", f"+49 30 {1000000 + i}") for i in range(6)]
    texts = []
    for _ in range(160):
        words = [draw.choice("abcdefghijklmnop") * draw.randint(1, 3) for _ in range(draw.randint(3, 25))]
        if draw.random() < 0.3:
            who = draw.choice(people)
            words += [who[0]] * draw.randint(0, 2) + [who[draw.randint(1, 2)]] + draw.choice([[], ["team" + who[0][-1]]])
            draw.shuffle(words)
        texts.append(" ".join(words))
    texts += [texts[3], texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    found = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in private.find(docs).collect()}
    want = plain(texts)
    assert [found[d] for d in range(len(texts))] == want and sum(map(len, want)) > 40


def test_copies_of_a_long_list_are_one_pair_of_groups(spark):
    many = " ".join(f"a{i}@mail.example.com" for i in range(3000)) + " " + " ".join(f"word{i}" for i in range(6000))
    docs = spark.createDataFrame([(1, many), (2, many)] + [(3 + i, f"other text {i}") for i in range(30)], "doc_id long, text string")
    found = private.find(docs).where("doc_id < 3").select(F.size(F.filter("spans", lambda s: s.kind == "term")).alias("n")).collect()
    assert all(r.n >= 6000 for r in found)
