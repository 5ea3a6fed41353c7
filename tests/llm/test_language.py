"""The training sample and the languages of the language model."""

import random

from carledger.llm import language

SCHEMA = "doc_id long, text string, lang string"


def test_every_language_is_learnt(spark):
    draw = random.Random(1)
    rows = []
    for k in range(250):
        words = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(3, 8))) for _ in range(30)]
        rows += [(k * 10 + i, " ".join(draw.choices(words, k=60)), f"l{k:03d}") for i in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r for r in language.predictions(docs).collect()}
    right = [found[i].lang_pred == lang for i, _, lang in rows]
    assert sum(right) / len(right) > 0.95
    assert {found[i].lang_pred for i, _, lang in rows} == {lang for _, _, lang in rows}


def test_sample_is_bounded_by_rows(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 20)
    rows = [(8, f"one id many words {i}", "en") for i in range(600)] + [(8, "the same row", "en")] * 600
    rows += [(None, f"no id {i}", "fr") for i in range(50)] + [(i, f"text of its own {i}", "de") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    counts = {r.lang: r["count"] for r in language._sample(docs).groupBy("lang").count().collect()}
    assert counts == {"en": 20, "fr": 20, "de": 20}


def test_sample_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 30)
    docs = spark.createDataFrame([(i % 40, f"words {i % 90} of a text", "en") for i in range(400)], SCHEMA)
    one, many = (sorted(map(tuple, language._sample(docs.repartition(n)).collect())) for n in (1, 9))
    assert one == many and len(one) == 30
