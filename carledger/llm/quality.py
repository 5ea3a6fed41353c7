"""Operator 4, a quality classifier of sparse rules.

Each text gives statistics of its characters, words and lines. On a bounded sample of labelled rows, small trees are grown;
every path from a root to a node is a rule, a conjunction of bounds on statistics. A logistic model with a lasso penalty
chooses few rules and their weights, and the chosen rules are compiled into one Spark column expression that scores.

Cases: a null text counts as empty; empty and wordless texts have all statistics 0 and get a score like any other; null
labels and labels of unknown documents teach nothing, several labels of a document each count; without both classes in the
sample the score is the share of label 1, or 0.5; repeated rows each give a row; ties in the sample go by doc_id; long
texts are read whole; only doc_id and text are read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.llm.bytewords import Hasher, batch_words, run_hash, space_table, text_buffer, tidied
from carledger.llm.tables import numbered, stored

TRAIN_ROWS = 20_000  # labelled rows that the model is fitted on at most: those of the smallest hashes of doc_id
TREES = 80
DEPTH = 3
PENALTY = 0.01  # of the lasso
STEPS = 400  # of the fit

STATISTICS = [
    "words", "word_length", "distinct_words", "distinct_pairs", "top_word", "same_as_before", "upper", "digits",
    "marks", "bangs", "bars", "beyond_ascii", "line_words", "sentence_words", "distinct_lines", "longest_word",
]


def _by_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _distinct(doc: np.ndarray, key: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document, how many distinct keys it has and how often the most frequent occurs."""
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    count = np.diff(np.r_[np.flatnonzero(new), len(key)])
    most = np.zeros(docs)
    np.maximum.at(most, doc[new], count)
    return np.bincount(doc[new], minlength=docs).astype(float), most


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), space_table()
        for batch in batches:
            data, ends = text_buffer(batch.column(1))
            for w in batch_words(batch.column(1), table, hasher):
                lo, hi = ends[w.first], ends[w.first + w.docs]
                own, offsets = data[lo:hi], ends[w.first : w.first + w.docs + 1] - lo
                n = np.diff(w.offsets).astype(float)
                some = np.maximum(n, 1)
                length = w.end - w.start
                letters = np.maximum(_by_doc(length, w.offsets), 1)
                distinct, top = _distinct(w.doc, w.hashes, w.docs)
                inner = np.flatnonzero(w.doc[1:] == w.doc[:-1])
                pairs, _ = _distinct(w.doc[inner], run_hash(w.hashes, inner, 2), w.docs)
                again = np.bincount(w.doc[inner], w.hashes[inner] == w.hashes[inner + 1], minlength=w.docs)
                breaks = np.r_[0, np.cumsum(own == 10)]
                new_line = np.ones(len(w.start), bool)
                new_line[1:] = (breaks[w.start[1:]] > breaks[w.end[:-1]]) | (w.doc[1:] != w.doc[:-1])
                line_start = np.flatnonzero(new_line)
                line_end = np.r_[line_start[1:], len(w.start)]
                shifted = np.r_[np.uint64(0), np.cumsum(w.hashes)]
                line_key = shifted[line_end] - shifted[line_start] if len(line_start) else np.zeros(0, np.uint64)
                lines = np.bincount(w.doc[line_start], minlength=w.docs).astype(float)
                distinct_lines, _ = _distinct(w.doc[line_start], line_key, w.docs)
                last = own[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
                stops = np.bincount(w.doc, np.isin(last, np.frombuffer(b".!?", np.uint8)), minlength=w.docs)
                longest = np.zeros(w.docs)
                np.maximum.at(longest, w.doc, length)
                part = lambda mask: _by_doc(mask, offsets) / letters  # noqa: E731, B023
                upper, digits = (own >= 65) & (own <= 90), (own >= 48) & (own <= 57)
                lower, other = (own >= 97) & (own <= 122), own >= 128
                marks = (own > 32) & (own < 127) & ~upper & ~lower & ~digits
                values = [
                    n, letters * (n > 0) / some, distinct / some, pairs / np.maximum(n - 1, 1), top / some, again / some,
                    part(upper), part(digits), part(marks), part(own == 33), part(own == 124), part(other),
                    n / np.maximum(lines, 1), n / np.maximum(stops, 1), distinct_lines / np.maximum(lines, 1), longest,
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.first, w.docs), *(pa.array(v.astype(float)) for v in values)], names=["doc_id", *STATISTICS]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tidied(run), ", ".join([f"doc_id {kind}", *(f"{s} double" for s in STATISTICS)]))


class Rule(NamedTuple):
    """Bounds (statistic, above, value) that all hold: x > value, or x <= value."""

    bounds: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for s, above, value in self.bounds:
            out &= (x[:, s] > value) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for s, above, value in self.bounds:
            own = F.col(STATISTICS[s])
            out = out & (own > value if above else own <= value)
        return out


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> list[Rule]:
    """The rules of the nodes of trees, each grown on a random half of the rows with some of the statistics."""
    rules = set()
    for _ in range(TREES):
        rows = rng.choice(len(x), max(1, min(len(x), 4000) // 2), replace=False)
        todo = [(rows, ())]
        while todo:
            rows, path = todo.pop()
            if path:
                rules.add(Rule(path))
            if len(path) == DEPTH or len(rows) < 20 or y[rows].min() == y[rows].max():
                continue
            best = None
            for s in rng.choice(x.shape[1], max(2, x.shape[1] // 3), replace=False):
                for value in np.unique(np.quantile(x[rows, s], np.linspace(0.02, 0.98, 25))):
                    left = x[rows, s] <= value
                    n = left.sum()
                    if 5 <= n <= len(rows) - 5:
                        p, q = y[rows][left].mean(), y[rows][~left].mean()
                        impure = n * p * (1 - p) + (len(rows) - n) * q * (1 - q)
                        if best is None or impure < best[0]:
                            best = impure, int(s), float(value), left
            if best:
                _, s, value, left = best
                todo += [(rows[left], (*path, (s, False, value))), (rows[~left], (*path, (s, True, value)))]
    return sorted(rules)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic model of standardised columns, by accelerated proximal steps."""
    centre, scale = z.mean(0), np.maximum(z.std(0), 1e-3)
    z = (z - centre) / scale
    step = 4 / max(1e-9, np.linalg.norm(z, 2) ** 2 / len(z) + 1)
    w, b, v, t = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1] + 1), 1.0
    for _ in range(STEPS):
        off = 1 / (1 + np.exp(-np.clip(z @ v[1:] + v[0], -30, 30))) - y
        new_b = v[0] - step * off.mean()
        new_w = v[1:] - step * (z.T @ off) / len(z)
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        push = (old - 1) / t
        v = np.r_[new_b + push * (new_b - b), new_w + push * (new_w - w)]
        w, b = new_w, new_b
    w = w / scale
    return float(b - centre @ w), w


def fit(x: np.ndarray, y: np.ndarray) -> Column:
    """The score as a column expression over the statistics."""
    if not len(y) or y.min() == y.max():
        return F.lit(float(y.mean()) if len(y) else 0.5)
    rules = grow(x, y, np.random.default_rng(5))
    z = np.stack([r.holds(x) for r in rules], 1).astype(float) if rules else np.zeros((len(y), 1))
    rate = y.mean()
    intercept, weights = lasso(z, y, PENALTY * 2 * min(rate, 1 - rate))
    terms = [F.when(r.column(), float(w)).otherwise(0.0) for r, w in zip(rules, weights, strict=False) if w]
    # An array of terms is compiled in parts; one long sum would not be compiled at all.
    total = F.aggregate(F.array(F.lit(intercept), *terms), F.lit(0.0), lambda a, b: a + b)
    return 1 / (1 + F.exp(-total))


def held_out() -> Column:
    """Rows whose labels aren't learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score (of label 1) and predicted for each row of `docs`."""
    rows = stored(numbered(statistics(docs)).withColumn("held_out", held_out()))
    taught = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("double").alias("_y")).where("_y in (0, 1)")
    sample = (
        rows.where("not held_out")
        .join(taught, F.col("doc_id") == F.col("_id"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_row", "_y")
        .limit(TRAIN_ROWS)
        .select("_y", *STATISTICS)
        .toArrow()
    )
    x = np.stack([sample[s].to_numpy() for s in STATISTICS], 1) if sample.num_rows else np.zeros((0, len(STATISTICS)))
    scored = rows.withColumn("score", fit(x, sample["_y"].to_numpy()))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
