"""Operator 7, information-theoretic sanitisation of personal data.

Base spans (e-mail addresses, IP addresses, card and phone numbers) are protected entities. A term in the documents of an
entity reveals it as far as knowing the term lowers the information the entity holds: with document counts N, n(e), n(t),
n(t, e),

    disclosure = pmi(t, e) / ic(e) = log(N n(t, e) / (n(t) n(e))) / log(N / n(e))

which is 1 if the term occurs only with the entity and 0 if it tells nothing. All counts are of documents of the whole
corpus, wherever in the document the term stands. Terms with a disclosure of `THRESHOLD` or more, in at least `SUPPORT`
documents of the entity, are spans of kind `term` at all their places in all its documents; `sanitise` generalises them, or
removes those that reveal nearly all.

Only entities of SUPPORT documents can be revealed, and as n(t, e) <= n(e), only by terms with n(t) <= sqrt(N n(e)) for a
THRESHOLD of 0.5. The documents with entities that recur give a lower bound of n(t), which leaves out other pairs early. Entities
of the same documents count once, and so do terms of the same ones among these: pairs are of such groups, so copies of a long
list of addresses give one pair, not a product. What remains is that a document's groups of entities meet its groups of terms.

Cases: null and empty texts have no spans; repeated rows each give a row and count each; a long text is searched whole;
ties do not matter, as every term is judged alone; only doc_id and text are read, so other columns can have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.llm.bytewords import Hasher, alnum_table, batch_words, text_buffer, tidied
from carledger.llm.tables import may_hold, membership, numbered, stored

KINDS = ["email", "ip", "card", "phone", "term"]  # in the order of the digests
SUPPORT = 2  # documents that show a term and an entity, at least
THRESHOLD = 0.5  # least disclosure of a term that is generalised
REMOVE = 0.9  # least disclosure of a term that is removed

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Each match of these starts at the first digit of a run, also without the look-behind, which only saves attempts.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_TERM = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from their @ signs; the time is in proportion to the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1, start):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    spans = [("email", i, j) for i, j in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x) < 256 for x in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() > 12 and 13 <= len(digits := _NO_DIGIT.sub("", m[0])) <= 19 and _luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def entity(kind: str, value: str) -> str:
    """The entity that a span names, whatever its spelling."""
    return f"{kind}:{value.translate(_LOWER) if kind == 'email' else value if kind == 'ip' else _NO_DIGIT.sub('', value)}"


def _free(spans: list[tuple[str, int, int]], terms: np.ndarray) -> np.ndarray:
    """Whether each term (start, end) lies in no span."""
    taken = sorted((i, j) for _, i, j in spans)
    reach = np.r_[0, np.maximum.accumulate(np.array([j for _, j in taken]))]
    return reach[np.searchsorted(np.array([i for i, _ in taken]), terms[:, 1])] <= terms[:, 0]


def _found(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The carried columns and base spans of each row; for rows with spans also their entities, and the keys (64-bit hashes)
    and places of all terms that are in no span."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    place = pa.struct([("key", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), alnum_table()
        for batch in batches:
            for part in batch_words(batch.column(0), table, hasher):
                spans, names, terms, sizes = [], [], [np.zeros((0, 3), np.int64)], [0]
                for d, text in enumerate(batch.column(0).slice(part.first, part.docs)):
                    text = text.as_py() or ""
                    own = base_spans(text)
                    spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in own])
                    names.append(sorted({entity(kind, text[i:j]) for kind, i, j in own}))
                    if own:
                        at = np.array([m.span() for m in _TERM.finditer(text)], np.int64).reshape(-1, 2)
                        keys = part.hashes[part.offsets[d] : part.offsets[d + 1]].view(np.int64)
                        terms.append(np.column_stack([keys, at])[_free(own, at)])
                    sizes.append(len(terms[-1]) if own else 0)
                key, start, end = np.concatenate(terms).T
                places = [pa.array(key), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))]
                places = pa.StructArray.from_arrays(places, fields=list(place))
                places = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), places)
                kept = batch.slice(part.first, part.docs).columns[1:]
                found = [pa.array(spans, pa.list_(span)), pa.array(names, pa.list_(pa.string())), places]
                yield pa.RecordBatch.from_arrays([*kept, *found], names=[*carry, "_base", "_entities", "_terms"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    schema = ", ".join([*fields, "_base array<struct<kind: string, start: int, end: int>>, _entities array<string>"])
    schema += ", _terms array<struct<key: long, start: int, end: int>>"
    return docs.select(F.col("text").alias("_text"), *carry).mapInArrow(tidied(run), schema)


def _term_counts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key, n: the number of documents with each term whose key passes a filter of `keys`."""
    packed = docs.sparkSession.sparkContext.broadcast(membership(keys, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), alnum_table()
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # of the whole partition: as many as terms
        waiting, size = [], 0

        def added(keys, counts):
            keys, at = np.unique(np.concatenate([keys, *waiting]), return_inverse=True)
            return keys, np.bincount(at, np.r_[counts, np.ones(size, np.int64)], minlength=len(keys)).astype(np.int64)

        for batch in batches:
            for part in batch_words(batch.column(0), table, hasher):
                hit = may_hold(packed.value, part.hashes)
                doc, found = part.doc[hit], part.hashes[hit]
                order = np.lexsort((found, doc))
                doc, found = doc[order], found[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (found[1:] != found[:-1])
                waiting.append(found[new])
                size += len(waiting[-1])
                if size > max(1 << 18, len(keys)):  # so that each key is merged a few times only
                    keys, counts = added(keys, counts)
                    waiting, size = [], 0
        keys, counts = added(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])

    return docs.select("text").mapInArrow(tidied(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _prints(column: str) -> list[Column]:
    """p, q: what names a set of values, by aggregation."""
    return [F.bit_xor(F.xxhash64(column, F.lit(seed))).alias(name) for name, seed in (("p", 1), ("q", 2))]


def find(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and `spans` (kind, start, end, disclosure) of each row, by kind and start.

    Start and end are code points, the end exclusive. disclosure is 1 for base spans.
    """
    rows = stored(numbered(_found(docs, list(carry))))
    n_docs = rows.count()
    n = F.lit(float(n_docs))
    own = rows.select("_row", F.explode("_entities").alias("entity"))
    n_entity = own.groupBy("entity").agg(F.count("*").alias("ne")).where(f"ne >= {SUPPORT}")
    own = stored(own.join(n_entity, "entity"))
    # One entity stands for all of the same documents.
    sets = own.groupBy("entity").agg(F.first("ne").alias("ne"), *_prints("_row"))
    own = stored(own.join(sets.groupBy("ne", "p", "q").agg(F.min("entity").alias("entity")).select("entity"), "entity", "left_semi"))
    # The terms of each document with a recurring entity, and the most documents that a term may have there.
    most = F.pow(n, 1 - THRESHOLD) * F.pow("ne", THRESHOLD)
    held = own.groupBy("_row").agg(F.max(most).alias("most"))
    near = rows.select("_row", F.expr("array_distinct(transform(_terms, x -> x.key))").alias("keys"))
    near = near.join(held, "_row").select("_row", "most", F.explode("keys").alias("key"))
    rare = near.groupBy("key").agg(F.count("*").alias("nt"), F.max("most").alias("most"), *_prints("_row"))
    rare = stored(rare.where((F.col("nt") >= SUPPORT) & (F.col("nt") <= F.col("most") * (1 + 1e-9))).drop("most"))
    like = rare.groupBy("nt", "p", "q").agg(F.min("key").alias("like"))
    rare = stored(rare.join(like, ["nt", "p", "q"]).select("key", "like", "nt"))
    pairs = near.select("_row", "key").join(rare.where("key = like").drop("like"), "key").join(own.withColumn("most", most), "_row").where(F.col("nt") <= F.col("most") * (1 + 1e-9))
    pairs = pairs.groupBy("entity", "key").agg(F.count("*").alias("nte"), F.first("ne").alias("ne"), F.first("nt").alias("nt"))
    pmi, ic = F.log(n * F.col("nte") / (F.col("nt") * F.col("ne"))), F.log(n / F.col("ne"))
    disclosure = F.when(F.col("ne") < n, pmi / ic).otherwise(0.0)
    # These documents are some of those with the term, so this bounds the disclosure from above.
    pairs = pairs.where(f"nte >= {SUPPORT}").where(disclosure >= THRESHOLD).select("entity", F.col("key").alias("like"), "nte", "ne")
    pairs = stored(pairs.join(rare.drop("nt"), "like").drop("like"))
    counts = _term_counts(docs, pairs.select("key").distinct()).withColumnRenamed("n", "nt")
    scored = pairs.join(counts, "key").withColumn("disclosure", disclosure)
    telling = stored(scored.where(F.col("disclosure") >= THRESHOLD).select("entity", "key", "disclosure"))
    marked = own.select("_row", "entity").join(telling, "entity").groupBy("_row", "key").agg(F.max("disclosure").alias("disclosure"))
    places = rows.join(marked.select("_row").distinct(), "_row", "left_semi").select("_row", F.explode("_terms").alias("x")).select("_row", "x.*")
    terms = places.join(marked, ["_row", "key"]).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms"))
    base = F.transform("_base", lambda s: F.struct(s.kind, s.start, s.end, F.lit(1.0).alias("disclosure")))
    more = F.transform("terms", lambda s: F.struct(F.lit("term").alias("kind"), s.start, s.end, s.disclosure))
    return rows.join(terms, "_row", "left").select(*carry, F.concat(base, F.when(F.isnotnull("terms"), more).otherwise(F.slice(base, 1, 0))).alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id, sanitised: each text with its base spans and telling terms generalised to their kind, and those terms that
    reveal nearly all removed. Where spans overlap, what they cover together is replaced once, by the first kind."""
    found = find(docs, carry=("doc_id", "text"))
    spans = F.array_sort(F.transform("spans", lambda s: F.struct(s.start, s.end, s.kind, s.disclosure)))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done, s):
        mark = F.when((s.kind == "term") & (s.disclosure >= REMOVE), "").otherwise(F.concat(F.lit("["), F.upper(s.kind), F.lit("]")))
        before = F.substr(F.col("text"), done.at + 1, s.start - done.at)
        out = F.when(s.start >= done.at, F.concat(done.out, before, mark)).otherwise(done.out)
        return F.struct(out.alias("out"), F.greatest(done.at, s.end).alias("at"))

    whole = F.aggregate(spans, start, step, lambda done: F.concat(done.out, F.substr(F.col("text"), done.at + 1)))
    return found.select("doc_id", whole.alias("sanitised"))


def digests(docs: DataFrame) -> DataFrame:
    """The columns of the query: counts and digests of the spans."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s.kind != "term")
    return find(docs).select(
        "doc_id", *(count(k) for k in KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
