"""Operator 8, language identification by the nearest centroid.

A text is a vector of hashed byte n-grams of its lower-cased words (2 to 4 bytes, word edges included), weighted by TF-IDF
with the square root of the frequency and scaled to length 1. The texts of each language in a bounded training sample are
clustered by cosine into several centroids, each language in a group of its own, however many there are. The language of the nearest centroid wins. A text is rejected if it is farther
from it than texts of that language are, at its number of distinct n-grams. The bound is measured: the sample is cut to many
lengths, and each half scored by a model of the other half, against its own language and against all others, as if its own
had not been learnt. Where nearly all own cosines lie above nearly all foreign ones, the bound is halfway between; where they
meet, as in very short texts, it is below the own ones, so that known languages stay.

Cases: null, empty and letterless texts are `und` with score 0 and rejected; null languages teach nothing; ties go to the
first language in order; without training rows every text is `und`; repeated rows each give a row; long texts are read
whole; only doc_id, text and lang are read, so other columns can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carledger.llm.bytewords import chunks, text_buffer, tidied
from carledger.llm.tables import free_name, stored

DIMENSIONS = 4096  # hashed n-grams
SAMPLE = 400  # rows a language that the model is fitted on at most: those of the smallest hashes of doc_id, then of text
SALT = 32  # parts of a language that rows are chosen in first
CENTROIDS = 4  # of a language
ROUNDS = 12  # of clustering
CUTS = [6, 12, 25, 50, 100, 200, 400, 800, 1600, 3200]  # characters of the pieces that bounds are measured on
USUAL = 0.005  # share of own pieces below the least usual cosine, and of foreign ones above the largest
SLACK = 0.9  # of the least usual own cosine, where foreign ones reach it
STEPS = 2  # sizes at which bounds are measured, for each doubling of distinct n-grams
UNKNOWN = "und"


def vectors(column: pa.Array) -> Iterator[np.ndarray]:
    """Counts of hashed n-grams of the lower-cased texts, float32 [texts, DIMENSIONS], chunk by chunk. Bytes that aren't in
    words count as edges."""
    edge = np.ones(256, bool)
    edge[0x61:0x7B] = edge[128:] = False
    for i, j in chunks(text_buffer(column)[1], 1 << 20):
        data, offsets = text_buffer(pc.utf8_lower(column.slice(i, j - i)))
        own = data[offsets[0] : offsets[-1]]
        signs = np.where(edge[own], 0, own).astype(np.uint32)
        out = np.zeros((j - i, DIMENSIONS), np.float32)
        keys = []
        rolled, padded = np.zeros(len(signs), np.uint32), np.r_[signs, np.zeros(4, np.uint32)]
        for k in range(4):
            rolled = (rolled ^ padded[k : k + len(signs)]) * np.uint32(0x01000193) + np.uint32(k)
            if k:
                keys.append(((rolled * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int16))
        plain = signs == 0
        # Runs of edges say nothing: only n-grams that begin in or right before a word count.
        useful = ~(plain & np.r_[plain[1:], True])
        for d in range(j - i):
            lo, hi = offsets[d] - offsets[0], offsets[d + 1] - offsets[0]
            for k, key in enumerate(keys, 2):
                if hi - lo >= k:
                    out[d] += np.bincount(key[lo : hi - k + 1][useful[lo : hi - k + 1]], minlength=DIMENSIONS)
        yield out


class Model(NamedTuple):
    """Languages of the centroids, their vectors, the weights of n-grams, and the least cosines that are accepted, by
    centroid and number of distinct n-grams."""

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        x = np.sqrt(counts) * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _cluster(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Up to CENTROIDS centroids of length 1 by cosine."""
    centre = x[rng.choice(len(x), min(CENTROIDS, len(x)), replace=False)]
    for _ in range(ROUNDS):
        own = (x @ centre.T).argmax(1)
        sums = [x[own == c].sum(0) for c in range(len(centre)) if (own == c).any()]
        centre = np.stack([s / max(np.linalg.norm(s), 1e-9) for s in sums])
    return centre


def bounds(languages: list[str], measured: pa.Table) -> np.ndarray:
    """The least cosine by centroid and number of distinct n-grams. measured: lang, n, own, foreign of each piece; NaN where
    a half has no such centroid."""
    name, n = measured["lang"].to_numpy(zero_copy_only=False), measured["n"].to_numpy()
    own, foreign = measured["own"].to_numpy(), measured["foreign"].to_numpy()
    size = np.rint(STEPS * np.log2(np.maximum(n, 1))).astype(int)
    sizes, every = np.arange(STEPS * int(np.log2(DIMENSIONS)) + 1), np.arange(DIMENSIONS + 1)
    strange = [foreign[(size == s) & ~np.isnan(foreign)] for s in sizes]
    strange = np.array([np.quantile(x, 1 - USUAL) if len(x) else 0.0 for x in strange])
    found = {}
    for language in set(languages):
        mine = (name == language) & ~np.isnan(own)
        # Sizes without pieces lie between their neighbours.
        known = [s for s in sizes if (mine & (size == s)).any()]
        if known:
            usual = np.array([np.quantile(own[mine & (size == s)], USUAL) for s in known])
            least = np.minimum(SLACK * usual, (usual + strange[known]) / 2)
            found[language] = np.interp(STEPS * np.log2(np.maximum(every, 1)), known, least)
    # A language of a single text can't be measured: the loosest bound of the others.
    other = np.min(list(found.values()), axis=0) if found else np.zeros(len(every))
    return np.array([found.get(x, other) for x in languages], np.float32).reshape(len(languages), len(every))


def held_out() -> Column:
    """Rows that aren't learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _lettered() -> Column:
    return F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False))


def _sample(docs: DataFrame) -> DataFrame:
    """lang, text and half of the training rows, at most SAMPLE of each language: rows, not ids, so that an id of many rows
    brings no more. Rows are chosen by hashes, so that no text is moved but those of the sample."""
    rows = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(~held_out() & F.col("lang").isNotNull() & _lettered())
    rows = rows.withColumn("print", F.xxhash64("text"))
    order = [F.xxhash64("doc_id"), "doc_id", "print"]
    nth = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy(*order))
    chosen = rows.select("lang", "doc_id", "print", F.pmod(F.xxhash64("print", "doc_id"), F.lit(SALT)).alias("salt"))
    for by in (["salt"], []):
        chosen = chosen.withColumn("nth", nth(*by)).where(F.col("nth") <= SAMPLE)
    chosen = stored(chosen.select("lang", "doc_id", "print").distinct())
    # Rows that are equal throughout were chosen as one.
    same = [rows[c].eqNullSafe(chosen[c]) for c in ("lang", "doc_id", "print")]
    found = rows.join(chosen, same[0] & same[1] & same[2], "left_semi")
    found = found.withColumn("nth", nth()).where(F.col("nth") <= SAMPLE)
    return stored(found.select("lang", "text", (F.col("print") % 2 == 0).alias("half")))


def train(docs: DataFrame) -> Model:
    """Fits the model on at most SAMPLE rows of each language. The driver gets 4 centroids a language and model (16 KB each)
    and the cosines of the pieces of the sample (about 0.1 MB a language)."""
    sample = _sample(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for counts in vectors(batch.column(1)):
                raw = [np.minimum(c, 65535).astype(np.uint16).tobytes() for c in counts]
                own = batch.slice(at, len(raw))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(2), pa.array(raw, pa.binary())], names=["lang", "half", "counts"])
                at += len(raw)

    found = stored(sample.mapInArrow(tidied(run), "lang string, half boolean, counts binary"))
    # Pieces of one half are scored by a model of the other.
    first, second, model = _fitted(found)
    return model._replace(least=bounds(model.languages, _measured(sample, [second, first])))


def _read(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, DIMENSIONS)


def _fitted(counts: DataFrame) -> list[Model]:
    """Models without bounds, of the rows of each half and of all rows."""
    spark = counts.sparkSession

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {False: [np.zeros(DIMENSIONS, np.uint32), 0], True: [np.zeros(DIMENSIONS, np.uint32), 0]}
        for batch in batches:
            mine = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            some = _read(batch.column(1), np.uint16) > 0
            for half, total in held.items():
                total[0] += some[mine == half].sum(0, dtype=np.uint32)
                total[1] += int((mine == half).sum())
        for half, (total, n) in held.items():
            yield pa.RecordBatch.from_pydict({"half": [half], "n": [n], "total": [total.tobytes()]})

    def added(table: pa.Table) -> pa.Table:
        total = _read(table["total"], np.uint32).sum(0, dtype=np.uint32).tobytes()
        return pa.table({"half": table["half"][:1], "n": [sum(table["n"].to_pylist())], "total": [total]})

    schema = "half boolean, n long, total binary"
    sums = counts.select("half", "counts").mapInArrow(present, schema).groupBy("half").applyInArrow(added, schema).collect()  # two rows
    total = {r.half: (r.n, np.frombuffer(r.total, np.uint32).astype(np.float32)) for r in sums}
    none = 0, np.zeros(DIMENSIONS, np.float32)
    halves = [total.get(half, none) for half in (False, True)]
    halves.append(tuple(a + b for a, b in zip(*halves, strict=True)))
    weights = [(np.log((1 + n) / (1 + some)) + 1).astype(np.float32) for n, some in halves]
    shared = spark.sparkContext.broadcast(weights)  # three rows of DIMENSIONS

    def fit(table: pa.Table) -> pa.Table:
        raw = table["counts"].to_pylist()
        order = sorted(range(len(raw)), key=raw.__getitem__)  # the same in every run
        x = np.frombuffer(b"".join(raw[i] for i in order), np.uint16).reshape(-1, DIMENSIONS).astype(np.float32)
        half, out = table["half"].to_numpy(zero_copy_only=False).astype(bool)[order], []
        for part, mine in enumerate((~half, half, np.ones(len(half), bool))):
            if mine.any():
                none = np.zeros((0, DIMENSIONS), np.float32)
                centre = _cluster(Model([], none, shared.value[part], none).weigh(x[mine]), np.random.default_rng(3))
                out += [{"lang": table["lang"][0].as_py(), "part": part, "nth": i, "centre": c.astype(np.float32).tobytes()} for i, c in enumerate(centre)]
        return pa.Table.from_pylist(out, schema=pa.schema([("lang", pa.string()), ("part", pa.int32()), ("nth", pa.int32()), ("centre", pa.binary())]))

    found = counts.groupBy("lang").applyInArrow(fit, "lang string, part int, nth int, centre binary").toArrow()  # CENTROIDS a language
    found = found.sort_by([("lang", "ascending"), ("nth", "ascending")])
    models = []
    for part, weight in enumerate(weights):
        own = found.filter(pc.equal(found["part"], part))
        centre, names = _read(own["centre"], np.float32), own["lang"].to_pylist()
        models.append(Model(names, centre, weight, np.zeros((len(names), DIMENSIONS + 1), np.float32)))
    return models


def _measured(sample: DataFrame, parts: list[Model]) -> pa.Table:
    """lang, n, own, foreign of the pieces of each text: distinct n-grams, and the largest cosine to a centroid of its own
    language and of the others, of the half it isn't in."""
    shared = sample.sparkSession.sparkContext.broadcast([(np.array(m.languages, object), m.centroids, m.idf) for m in parts])  # bounded

    def scores(lang: np.ndarray, part: int, counts: np.ndarray) -> list[np.ndarray]:
        languages, centroids, idf = shared.value[part]
        near = Model([], centroids, idf, centroids).weigh(counts) @ centroids.T
        same = lang[:, None] == languages[None, :]
        best = [np.where(mask, near, -1).max(1, initial=-1).astype(float) for mask in (same, ~same)]
        return [np.where(x < 0, np.nan, x) for x in best]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = pc.utf8_length(batch.column(1)).to_numpy()
            for cut in [*CUTS, None]:
                some = batch if cut is None else batch.filter(pa.array(length > cut))
                texts = some.column(1) if cut is None else pc.utf8_slice_codeunits(some.column(1), 0, cut)
                at = 0
                for counts in vectors(texts):
                    here = some.slice(at, len(counts))
                    lang, half = (here.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
                    n = (counts > 0).sum(1)
                    own, foreign = np.full((2, len(n)), np.nan)
                    for part in (0, 1):
                        mine = (half == bool(part)) & (n > 0)
                        own[mine], foreign[mine] = scores(lang[mine], part, counts[mine])
                    yield pa.RecordBatch.from_arrays([here.column(0), pa.array(n), pa.array(own), pa.array(foreign)], names=["lang", "n", "own", "foreign"])
                    at += len(n)

    return sample.mapInArrow(tidied(run), "lang string, n long, own double, foreign double").toArrow()


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred, score (cosine to the nearest centroid) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))  # bounded
    own, text = docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, centroids, idf, least = shared.value
        names, scale = np.array([*languages, UNKNOWN], dtype=object), idf
        for batch in batches:
            lettered = batch.column(len(own)).to_numpy(zero_copy_only=False)
            at = 0
            for counts in vectors(batch.column(text)):
                x = np.sqrt(counts) * scale
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
                here = lettered[at : at + len(x)]
                if len(languages):
                    near = x @ centroids.T
                    best = near.argmax(1)
                    score = np.clip(near[np.arange(len(x)), best], 0, 1).astype(float)
                    rejected = ~here | (score < least[best, (counts > 0).sum(1)])
                else:
                    best, score, rejected = np.zeros(len(x), int), np.zeros(len(x)), np.ones(len(x), bool)
                best = np.where(here, best, len(languages))
                out = [pa.array(names[best], pa.string()), pa.array(np.where(here, score, 0.0)), pa.array(rejected)]
                kept = [batch.column(c).slice(at, len(x)) for c in range(len(own))]
                yield pa.RecordBatch.from_arrays([*kept, *out], names=[*own, "lang_pred", "score", "rejected"])
                at += len(x)

    more = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    read = docs.select("*", _lettered().alias(free_name("_lettered", docs)))
    return read.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, *more]))


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for each row of `docs`."""
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that aren't rejected."""
    own = {c: free_name(f"_own_{c}", docs) for c in ("lang_pred", "score", "rejected") if c in docs.columns}
    found = identify(docs.withColumnsRenamed(own), train(docs)).where("not rejected").drop("lang_pred", "score", "rejected")
    return found.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)
