"""Operator 9, substring dedup by sliding spans of sentences.

A text is cut into sentences after . ! ? and line breaks, after words that their hash chooses, so that cuts do not depend
on what stands before, and after `LONGEST` words at last. Each sentence opens a span: itself and the next ones until there are at
least `SENTENCES` sentences and `WORDS` words. Spans are hashed and counted over the whole corpus, with partial counts in
every batch. The first place of a span is its smallest (doc_id, hash of the text, sentence); the sentences of every other place
are removed.

Cases: null and empty texts have no sentences and stay as they are; texts shorter than a span are never touched; repeated
rows with equal doc_id and text are one document, so their spans are first in each; rows of one doc_id with different texts are
documents of their own, and so are those without id, which come first; repeats inside a text are removed too; long texts are read whole; only doc_id and text are read, so other
columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carledger.llm.bytewords import Hasher, Words, batch_words, mix, space_table, text_buffer, tidied
from carledger.llm.tables import fitting, may_hold, membership, stored

SENTENCES = 3  # of a span, at least
WORDS = 20  # of a span, at least
LONGEST = 12  # words of a sentence that nothing else ends
FILTER_BITS = 26  # of the filter of repeated spans at most, 8 MiB; smaller for few spans. More than fit only let more through
CUT = 8  # one word in so many ends a sentence by its hash


def _shortened(word: np.ndarray) -> np.ndarray:
    """Sentences of more than LONGEST words are cut after every LONGEST, so that words said over and over end as well."""
    more = (np.diff(word) - 1) // LONGEST
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    return np.sort(np.r_[word, np.repeat(word[:-1], more) + LONGEST * nth])


class Sentences:
    """The sentences of some documents: `word` has the first word of each and, at the end, the number of words."""

    def __init__(self, data: np.ndarray, words: Words):
        n = len(words.start)
        last = data[words.end - 1]
        ends = np.isin(last, np.frombuffer(b".!?", np.uint8)) | (words.hashes % np.uint64(CUT) == 0)
        if n:
            breaks = np.zeros(len(data) + 1, np.int64)
            np.cumsum(data == 10, out=breaks[1:])
            ends[:-1] |= breaks[words.start[1:]] > breaks[words.end[:-1]]
            ends[:-1] |= words.doc[1:] != words.doc[:-1]
            ends[-1] = True
        self.word = _shortened(np.r_[0, np.flatnonzero(ends) + 1]) if n else np.zeros(1, np.int64)
        self.doc = words.doc[self.word[:-1]]
        self.first = np.searchsorted(self.doc, np.arange(words.docs + 1))  # sentences of document d: first[d]:first[d + 1]
        self.start = words.start[self.word[:-1]]  # byte where each begins
        sums = np.zeros(n + 1, np.uint64)
        # Word hashes weighted by their place: the difference of two sums, made independent of the place, names a run.
        weight = np.cumprod(np.r_[np.uint64(1), np.full(n, 0x9E3779B97F4A7C15, np.uint64)]) if n else np.ones(1, np.uint64)
        np.cumsum(words.hashes * weight[:n], out=sums[1:])
        back = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)])
        count = len(self.doc)
        here = np.arange(count)
        stop = np.maximum(here + SENTENCES, np.searchsorted(self.word, self.word[:-1] + WORDS))
        fits = stop <= self.first[self.doc + 1]
        self.at, self.stop = here[fits], stop[fits]  # of spans: first sentence, and the one after the last
        i, j = self.word[self.at], self.word[self.stop]
        self.hashes = mix((sums[j] - sums[i]) * back[i] + (j - i).astype(np.uint64))


def _scan(docs: DataFrame, columns: list[str], emit, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), space_table()
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for part in batch_words(batch.column(0), table, hasher):
                own = data[offsets[part.first] : offsets[part.first + part.docs]]
                yield emit(batch.slice(part.first, part.docs), own, Sentences(own, part))

    return docs.select("text", *columns).mapInArrow(tidied(run), schema)


def repeated(docs: DataFrame) -> DataFrame:
    """span, first_id, first_print, first_at of every span that occurs more than once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def emit(batch, data, s):
        # In a batch, a span keeps its first place for each document, and how often it occurs in all.
        spans, first, n = np.unique(s.hashes, return_index=True, return_counts=True)
        doc = s.doc[s.at[first]]
        if len(np.unique(s.doc)) > 1 and (n > 1).any():  # the smallest place must win, not the first in the batch
            ids = batch.column(1).to_pandas().rank(method="min").fillna(0).to_numpy()
            order = np.lexsort((s.at, batch.column(2).to_numpy()[s.doc[s.at]], ids[s.doc[s.at]], s.hashes))
            first = order[np.r_[0, np.cumsum(n)[:-1]]]
            doc = s.doc[s.at[first]]
        at, rows = (s.at[first] - s.first[doc]).astype(np.int32), pa.array(doc)
        columns = [pa.array(spans.view(np.int64)), batch.column(1).take(rows), batch.column(2).take(rows), pa.array(at), pa.array(n.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["span", "doc_id", "print", "at", "n"])

    docs = docs.select("text", "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"))
    found = _scan(docs, ["doc_id", "print"], emit, f"span long, doc_id {kind}, print long, at int, n int")
    first = found.groupBy("span").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "print", "at")).alias("first"))
    return first.where("n > 1").select("span", *(F.col(f"first.{c}").alias(f"first_{d}") for c, d in (("doc_id", "id"), ("print", "print"), ("at", "at"))))


def _places(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, print, span, at, stop of the spans that pass a filter of `spans`."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    packed = docs.sparkSession.sparkContext.broadcast(membership(spans, "span", fitting(spans, FILTER_BITS)))

    def emit(batch, data, s):
        held = np.flatnonzero(may_hold(packed.value, s.hashes))
        doc = s.doc[s.at[held]]
        places = [pa.array((x[held] - s.first[doc]).astype(np.int32)) for x in (s.at, s.stop)]
        rows = pa.array(doc)
        columns = [batch.column(1).take(rows), batch.column(2).take(rows), pa.array(s.hashes[held].view(np.int64)), *places]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "print", "span", "at", "stop"])

    docs = docs.select("text", "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"))
    return _scan(docs, ["doc_id", "print"], emit, f"doc_id {kind}, print long, span long, at int, stop int")


def _cut(docs: DataFrame, kind: str) -> DataFrame:
    """Removes the sentences of the ranges in `gone` from each text."""

    def emit(batch, data, s):
        texts, n_sentences, n_removed = [], [], []
        flat = batch.column(2).to_pylist()
        base = 0
        raw = batch.column(0).to_pylist()
        for d, text in enumerate(raw):
            lo, hi = s.first[d], s.first[d + 1]
            size = len(text.encode()) if text else 0
            covered = np.zeros(hi - lo + 1, np.int64)
            for r in flat[d] or ():
                covered[r["at"]] += 1
                covered[r["stop"]] -= 1
            covered = np.cumsum(covered)[:-1] > 0
            if covered.any():
                own = data[base : base + size]
                begin = np.r_[s.start[lo:hi] - base, size]
                begin[0] = 0
                keep = np.repeat(~covered, np.diff(begin))
                text = own[keep].tobytes().decode().rstrip()
            texts.append(text)
            n_sentences.append(hi - lo)
            n_removed.append(int(covered.sum()))
            base += size
        columns = [batch.column(1), pa.array(n_sentences, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string()), batch.column(3)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_sentences", "n_removed", "text", "copied_from"])

    schema = f"doc_id {kind}, n_sentences long, n_removed long, text string, copied_from array<{kind}>"
    return _scan(docs, ["doc_id", "gone", "copied_from"], emit, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed, text without sentences of repeated spans, copied_from (the documents that hold the
    first places of the removed spans, ascending) for each row of `docs`."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = stored(repeated(docs))
    places = _places(docs, spans).join(spans, "span")
    other = places.where("not (doc_id <=> first_id and print = first_print and at = first_at)")
    # Overlapping ranges may be many; neighbours are cut to one entry for each first sentence.
    gone = (
        other.groupBy("doc_id", "print", "at")
        .agg(F.max("stop").alias("stop"), F.min("first_id").alias("first_id"))
        .groupBy("doc_id", "print")
        .agg(F.collect_list(F.struct("at", "stop")).alias("gone"), F.array_sort(F.collect_set("first_id")).alias("copied_from"))
        .withColumnsRenamed({"doc_id": "_id", "print": "_print"})
    )
    own = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"))
    joined = own.join(gone, own["doc_id"].eqNullSafe(gone["_id"]) & (own["print"] == gone["_print"]), "left")
    none = F.array().cast(f"array<{kind}>")
    return _cut(joined.select("text", "doc_id", "gone", F.coalesce("copied_from", none).alias("copied_from")), kind)
