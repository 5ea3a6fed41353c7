"""The registered queries over the smallest data against SQL, plain answers, the tokenizers library or held-out labels."""

import html
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from carledger.llm import boilerplate, language, neardup, private, spans, tables
from carledger.llm.queries import ORACLES, QUERIES
from carledger.session import shared_dir
from tests.llm import brute

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    found = {}

    def of(name):
        if name not in found:
            found[name] = QUERIES[name](spark, sf_dir).toPandas()
        return found[name]

    return of


def rows(frame):
    """Sorted rows; pandas holds numbers with gaps as floats."""
    plain = lambda v: None if v is None or str(v) in ("<NA>", "nan") else int(v) if isinstance(v, float) and v.is_integer() else v
    found = [tuple(map(plain, r)) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False)]
    return sorted(found, key=lambda r: tuple((v is None, "" if v is None else v) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(result, duck, name):
    want = duck.execute(ORACLES[name]).df()
    assert rows(result(name)) == rows(want)


def test_neighbours(result, tables):
    frame = tables("embeddings")
    ids, x = frame.vec_id.to_numpy(), np.stack(frame.embedding.to_numpy()).astype(float)
    found, hits = result("op1_rotated_codes"), 0
    queries = ids[ids % 100 == 0]
    assert len(found) == 10 * len(queries)
    for q in queries:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))[:10]]
        mine = found[found.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11)) and np.allclose(mine.score, [d[ids == v][0] for v in mine.vec_id])
        hits += len({*best} & {*mine.vec_id})
    assert hits >= 0.95 * 10 * len(queries)


def test_near_duplicates(result, tables):
    docs = tables("documents")[["doc_id", "text"]].itertuples(index=False)
    want = brute.near_duplicates(list(docs), 2)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in result("op2_minhash").itertuples()}
    assert got == want


def test_bpe(result, tables):
    texts = tables("documents")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in result("op3_bpe").itertuples()}
    for i, text in zip(texts.doc_id, texts.text, strict=True):
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
        decoded = TOKENIZER.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(decoded))


def test_quality(result, tables):
    found = result("op4_quality").merge(tables("labels"), on="doc_id")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found.itertuples())
    held = found[found.held_out]
    assert len(held) > 10 and (held.predicted == held.quality).mean() > 0.95


def test_contamination(result, tables):
    pairs = lambda name, key: list(tables(name)[[key, "text"]].itertuples(index=False))
    want = brute.contamination(pairs("documents", "doc_id"), pairs("benchmark", "item_id"))
    for r in result("op5_decontaminate").itertuples():
        n_words, n_hit, items, contaminated = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n_words, n_hit, len(items), contaminated)
        assert r.items_sha256 == brute.sha(",".join(items))


def test_pages(result, tables):
    found = {r.page_id: (r.text, r.n_chars) for r in result("op6_pages").itertuples()}
    for page in tables("pages").itertuples():
        article = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", page.html, re.S)[1]
        blocks = (re.sub("<br>", " ", b).replace("<b>", "") for b in re.split("</?(?:p|h1)>", article))
        want = " ".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))
        assert found[page.page_id] == (want, len(want))


def test_private(result, tables):
    texts = tables("documents").set_index("doc_id").text
    for r in result("op7_private").itertuples():
        spans = brute.personal(texts[r.doc_id])
        count = [sum(s[0] == k for s in spans) for k in brute.KINDS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == count
        joined = ",".join(f"{k}:{i}:{j}" for k, i, j in spans)
        assert r.base_sha256 == brute.sha(joined) and r.spans.startswith(joined)


def test_language(result, tables):
    found = result("op8_language").merge(tables("documents"), on="doc_id")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found.itertuples())
    assert (found[found.held_out].lang_pred == found[found.held_out].lang).mean() > 0.95
    assert found.score.between(0, 1).all() and not found.rejected.any()


def test_spans_of_the_smallest_data(result, tables):
    """No passage of 50 words is left in two documents, and first places are whole."""
    texts = tables("documents").set_index("doc_id").text
    found = result("op9_spans").set_index("doc_id")
    assert (found.text[found.n_removed == 0] == texts[found.index[found.n_removed == 0]]).all()
    seen = {}
    for i in sorted(found.index):
        words = brute.ANY_WORD.findall(brute.low(found.text[i]))
        for k in range(len(words) - 49):
            run = tuple(words[k : k + 50])
            assert seen.setdefault(run, i) == i or len(set(run)) < 25, (i, seen[run])


def test_stages_equal_plain_answers(spark, sf_dir):
    """Each stage over what its predecessor kept."""
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = tables_stored(stage(spark, docs, sf_dir))
        after = {r.doc_id: r for r in docs.collect()}
        if name == "language":
            assert after == before
        elif name == "lines":
            want = brute.without_boilerplate([(r.doc_id, r.text, r.source) for r in before.values()])
            assert {i: r.text for i, r in after.items()} == want and all(r.n_chars == len(r.text) for r in after.values())
        elif name == "near_copies":
            groups = brute.near_duplicates([(i, r.text) for i, r in before.items()], 5)
            assert after == {i: r for i, r in before.items() if groups[i][2]}
        elif name == "decontaminate":
            found = brute.contamination([(i, r.text) for i, r in before.items()], items)
            assert after == {i: r for i, r in before.items() if not found[i][3]}
        else:
            for i, r in before.items():
                ids = TOKENIZER.encode(r.text or "", add_special_tokens=False).ids
                assert after[i].ids_sha256 == brute.sha(" ".join(map(str, ids)))
            assert len(after) == len(before)
        before = after


tables_stored = tables.stored


def test_steps_of_a_run_go(spark, sf_dir):
    folder = os.path.join(shared_dir(spark).removeprefix("file:"), spark.sparkContext.applicationId)
    kept = {f for f in os.listdir(folder) if f.startswith("step-")} if os.path.isdir(folder) else set()
    found = corpus_pipeline.run(spark, sf_dir)
    new = {f for f in os.listdir(folder) if f.startswith("step-")} - kept
    assert len(new) == 1 and found.count() > 0


def test_a_large_group_of_near_copies(spark, documents):
    """Blocks of one group, members outside its largest component included, against all pairs."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(700):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 14), replace=False):
            words[at] = f"x{i}-{at}"
        texts.append((i, " ".join(words)))
    want = brute.near_duplicates(texts, 2)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.groups(documents(texts), 2).collect()}
    assert got == want and 1 < sum(k for _, _, k in want.values()) < 600


def test_terms_that_reveal_an_entity(documents):
    texts = [(i, f"common words here Rareterm{i // 4} mailto me{i // 4}@mail.example.com and common words") for i in range(8)]
    texts += [(100 + i, "common words and mailto here, and nothing else") for i in range(40)]
    found = {r.doc_id: r.spans for r in private.digests(documents(texts)).collect()}
    at = texts[0][1].index("Rareterm0")
    assert f"term:{at}:{at + 9}" in found[0] and found[0].count("term:") == 1 and found[100] == ""
    clean = {r.doc_id: r.sanitised for r in private.sanitise(documents(texts)).collect()}
    assert clean[0] == "common words here  mailto [EMAIL] and common words"


def test_passages_go_but_for_the_first(documents):
    passage = " ".join(f"p{i}" + ("." if i % 6 == 5 else "") for i in range(60)) + "."
    texts = [(1, "Own words open this text. " + passage + " It ends otherwise."), (2, passage + "\nOther words."), (3, "Clean words. All alone.")]
    found = {r.doc_id: r for r in spans.remove_repeats(documents(texts)).collect()}
    assert found[1].text == texts[0][1] and found[3].text == texts[2][1]
    assert found[2].text == "Other words." and found[2].copied_from == [1]


def test_lines_of_many_sites(documents):
    texts = [(i, f"Text number {i} says something of its own.\nAll rights reserved.\nx{i}", "en", f"s{i % 10}") for i in range(12)]
    texts.append((99, "Text of a small site, with a line\nthat few have", "en", "s0"))
    kept = {r.doc_id: r.text for r in boilerplate.cleaned(documents(texts)).collect()}
    assert kept == brute.without_boilerplate([(i, t, s) for i, t, _, s in texts]) and "rights" not in kept[0]


def test_lines_of_many_sites_go_whatever_their_share(documents):
    shared = "All rights reserved by the owners of this site.\nSubscribe to our letter for more of this."
    texts = [(i, f"{shared}\nown {i}", "en", f"s{i}") for i in range(10)] + [(20, shared, "en", "s0"), (21, shared + "\n ", "en", "s1")]
    kept = {r.doc_id: (r.text, r.n_chars) for r in boilerplate.cleaned(documents(texts)).collect()}
    assert all(kept[i] == (f"own {i}", 5) for i in range(10))
    assert kept[20][0] == shared and kept[21][0] == shared + "\n "  # nothing would be left


def test_texts_of_unseen_languages_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rng, letters = np.random.default_rng(0), np.array(list("abcdefghijklmnopqrstuvwxyz"))
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
    polish += "i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności."
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
    finnish += "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokaisella on oikeus elämään ja vapauteen."
    junk = [" ".join("".join(rng.choice(letters, rng.integers(2, 10))) for _ in range(n)) for n in (40, 100, 400, 1500)]
    strange = spark.createDataFrame([(-1 - i, t) for i, t in enumerate([polish, finnish, *junk])], "doc_id bigint, text string")
    model = language.train(docs)
    assert language.identify(strange, model).where("not rejected").collect() == []
    assert language.identify(docs.select("doc_id", "text"), model).where("rejected").collect() == []
    unseen = language.train(docs.where("lang != 'de'"))
    german = language.identify(docs.where("lang = 'de' and length(text) > 400"), unseen).collect()
    assert len(german) > 10 and sum(r.rejected for r in german) >= 0.9 * len(german)


def test_terms_far_from_an_entity_reveal_it_too(documents):
    between = "common words and nothing else stand here between the name and the address of it "
    texts = [(i, f"Rareterm {between}me@mail.example.com {between}signed rareterm") for i in range(3)]
    texts += [(100 + i, f"{between}signed") for i in range(60)]
    clean = {r.doc_id: r.sanitised for r in private.sanitise(documents(texts)).collect()}
    assert all(clean[i] == f" {between}[EMAIL] {between}signed " for i in range(3)) and clean[100] == texts[3][1]
