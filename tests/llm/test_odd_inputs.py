"""Every operator and stage over nulls, empty, long, repeated and clashing inputs, and over nothing."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from carledger.llm import boilerplate, bpe, decontaminate, language, neardup, neighbours, pages, private, quality, spans

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def benchmark(spark):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, None), (3, ""), (None, "no id here at all"), (4, "你好")]
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumn("doc_id", F.lit(7))


@pytest.fixture
def labels(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (99, 0, 0), (6, 0, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").withColumn("_y", F.lit(3))


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def test_near_duplicates(odd, nothing):
    found = neardup.groups(odd, width=2)
    assert found.count() == 11
    got = by_id(found.where("doc_id is not null"), "n_shingles", "component_id", "kept")
    assert got[1] == (7, 1, True) and got[2] == (7, 1, False)
    assert got[3] == got[4][:1] + (3, True) == (0, 3, True) and got[5] == (0, 5, True)
    assert got[7] == (1, 7, True) and got[-8][1:] == (-8, True)
    none = found.where("doc_id is null").collect()
    assert sorted(r.n_shingles for r in none) == [0, 4] and all(r.component_id is None and r.kept for r in none)
    assert neardup.groups(nothing).collect() == []
    assert sorted(r.doc_id for r in neardup.deduplicate(odd, 2).where("doc_id is not null").collect()) == [-8, 1, 1, 3, 4, 5, 6, 7]
    assert neardup.deduplicate(odd).columns == odd.columns


def test_bpe(odd, nothing):
    coded = bpe.decode(bpe.encode(odd, PATH), PATH)
    assert coded.count() == 11 and set(coded.columns) == set(odd.columns)
    got = by_id(coded.where("doc_id is not null"), "ids", "decoded")
    assert got[3] == got[4] == got[5] == ([], "") and got[1] == got[2] and got[7][1] == "!?</w>"
    assert bpe.digests(nothing, PATH).collect() == []


def test_decontamination(odd, nothing, benchmark):
    found = decontaminate.contamination(odd, benchmark)
    assert found.count() == 11
    got = by_id(found.where("doc_id is not null"), "n_words", "n_hit", "item_ids", "contaminated")
    assert got[1] == got[2] == (8, 8, ["1"], True) and got[3] == got[4] == got[5] == got[7] == (0, 0, [], False)
    assert got[-8] == (4, 1, ["4"], True)
    kept = decontaminate.clean(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == 7
    assert decontaminate.contamination(nothing, benchmark).collect() == []
    assert decontaminate.clean(odd, benchmark.limit(0)).count() == 11


def test_quality(odd, nothing, labels):
    found = quality.score(odd, labels)
    assert found.count() == 11 and found.where("score is null or score < 0 or score > 1 or held_out is null").count() == 0
    assert quality.score(odd, labels.limit(0)).where("score = 0.5 and predicted = 1").count() == 11
    assert quality.score(nothing, labels).collect() == []


def test_private(odd, nothing):
    found = private.digests(odd)
    assert found.count() == 11
    got = by_id(found.where("doc_id is not null"), "n_email", "spans")
    at = 28 * 12_000
    assert got[6] == (1, f"email:{at}:{at + 21}") and got[3] == got[4] == (0, "")
    assert private.digests(nothing).collect() == []
    assert private.sanitise(odd).count() == 11


def test_language(odd, nothing):
    found = language.predictions(odd)
    assert found.count() == 11
    got = by_id(found.where("doc_id is not null"), "lang_pred", "score", "rejected")
    assert got[3] == got[4] == got[5] == got[7] == ("und", 0.0, True)
    assert got[6][0] == "en" and 0 < got[6][1] <= 1
    assert language.predictions(nothing).collect() == []
    assert language.keep_known(odd).columns == odd.columns
    untaught = language.predictions(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


def test_spans(odd, nothing):
    found = spans.remove_repeats(odd)
    assert found.count() == 11
    got = by_id(found.where("doc_id is not null"), "n_sentences", "n_removed", "text")
    assert got[3] == (0, 0, None) and got[4] == (0, 0, "") and got[1][2] == "a b c d e f g h"
    assert got[6][1] > 0  # it repeats itself
    assert spans.remove_repeats(nothing).collect() == []


def test_boilerplate(odd, nothing):
    found = boilerplate.remove_boilerplate(odd.drop("n_lines", "n_removed"), sites=2)
    got = by_id(found.where("doc_id is not null"), "text", "n_lines", "n_removed")
    assert got[1] == ("a b c d e f g h", 1, 0)  # a copy as a whole is left to near-duplicate removal
    assert got[3] == (None, 0, 0) and got[4] == ("", 1, 0) and got[5][1] == 2
    assert boilerplate.cleaned(odd).columns == odd.columns and boilerplate.cleaned(odd).count() == 11
    assert boilerplate.digests(nothing).collect() == []


def test_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<article><p>A&amp;b \n c<p>d</article>"), (3, "u", "<<>>&")]
    long = "<article>" + "<p>some words, and more of them.</p>" * 5_000
    odd = spark.createDataFrame([*rows, (4, "u", long)], "page_id bigint, url string, html string").withColumn("text", F.lit(1))
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in pages.extract(odd).collect()]
    assert len(got) == 6 and (1, "u", "", 0) in got and (2, None, "", 0) in got and (3, "u", "A&b c d", 7) in got
    assert max(r[3] for r in got) == 5_000 * 30 - 1
    assert pages.extract(odd.limit(0)).collect() == []


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (100, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]),
        (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (200, []),
    ]
    odd = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"node": F.lit(1), "cell": F.lit(2)})
    got = [tuple(r) for r in neighbours.search(odd, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    far = 2**0.5
    assert got == [
        (0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 8, 0.0), (0, 4, 3, far), (0, 5, 100, far),  # 8 goes on with zeros
        (100, 1, 3, 0.0), (100, 2, 0, far), (100, 3, 1, far), (100, 4, 2, far), (100, 5, 8, far),
    ]
    assert len([r for r in neighbours.search(odd, F.col("vec_id") == 0, k=2).collect()]) == 2
    assert neighbours.search(odd.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    around = [(9, [1.0, 0.0]), (8, [3.0, 0.0]), (7, [2.0, 1.0]), (6, [2.0, -1.0]), (100, [2.0, 0.0]), (5, [9.0, 9.0])]
    ties = spark.createDataFrame(around, "vec_id bigint, embedding array<float>")
    got = neighbours.search(ties, F.col("vec_id") == 100, k=2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(6, 1.0), (7, 1.0)]


def test_stages_keep_the_columns(spark, odd, nothing, tmp_path):
    benchmark = spark.createDataFrame([(1, "some words of an item that nobody has")], "item_id bigint, text string")
    benchmark.write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns in (odd.columns, nothing.columns)
        docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, "").count() == 11


def test_rows_without_id_are_judged_one_by_one(documents):
    copy, other = "one text that two rows have in common", "quite another text that stands for itself alone"
    rows = [(1, copy), (None, copy), (None, other), (None, "clean words"), (None, "clean words"), (5, "five is clean"), (5, copy)]
    docs = documents(rows)
    kept = sorted(((r.doc_id, r.text) for r in neardup.deduplicate(docs, 2).collect()), key=str)
    assert kept == sorted([(1, copy), (None, other), (None, "clean words"), (5, "five is clean")], key=str)
    assert neardup.groups(docs, 2).where("kept").count() == 4
    items = docs.where("doc_id = 1").selectExpr("doc_id as item_id", "text")
    clean = sorted(((r.doc_id, r.text) for r in decontaminate.clean(docs, items).collect()), key=str)
    assert clean == sorted([(None, other), (None, "clean words"), (None, "clean words"), (5, "five is clean")], key=str)
