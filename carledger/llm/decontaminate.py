"""Operator 5, benchmark decontamination by a prefix-filtered set join.

Each run of `WINDOW` words of a benchmark item (the whole item, if shorter) is a window, a set of shingles with places. A
text that holds the window holds all its shingles, so the join needs one: the prefix, its rarest shingle in the documents.
Documents meet prefixes through a filter of fixed size and a join on the shingle; the place of the shingle and the lengths
of window and document bound where the window can lie; there its words are compared one by one, by their 64-bit hashes.

Cases: null, empty or wordless texts have no words and are never contaminated; items without words or without id take no
part, repeated items count once; repeated documents are judged row by row; without benchmark nothing is contaminated; only
the named columns are read, so others can have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carledger.llm.bytewords import Hasher, alnum_table, batch_words, list_array, run_hash, shingles, tidied
from carledger.llm.tables import free_name, may_hold, membership, numbered, stored

WINDOW = 13  # words of a window
SHINGLE = 5  # words of a shingle, or the window's words if fewer


def windows(benchmark: DataFrame) -> DataFrame:
    """wkey, words (hashes), shingles (hashes by place), item_id as string: a row for each window of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), alnum_table()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out: dict[str, list] = {"wkey": [], "words": [], "shingles": [], "item_id": []}
            for part in batch_words(batch.column(1), table, hasher):
                signed = part.hashes.view(np.int64)
                for d in range(part.docs):
                    lo, hi = part.offsets[d], part.offsets[d + 1]
                    size = min(WINDOW, hi - lo)
                    width = min(SHINGLE, size)
                    for i in range(lo, hi - size + 1) if size else ():
                        found = run_hash(part.hashes, np.arange(i, i + size - width + 1), width)
                        key = run_hash(part.hashes, np.array([i]), size).view(np.int64)[0]
                        out["wkey"].append(int(key))
                        out["words"].append(signed[i : i + size].tolist())
                        out["shingles"].append(found.view(np.int64).tolist())
                        out["item_id"].append(ids[part.first + d])
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [("wkey", pa.int64()), ("words", pa.list_(pa.int64())), ("shingles", pa.list_(pa.int64())), ("item_id", pa.string())]
                ),
            )

    return items.mapInArrow(tidied(run), "wkey long, words array<long>, shingles array<long>, item_id string")


def _rarity(docs: DataFrame, packed, widths: list[int]) -> DataFrame:
    """shingle, df: in how many documents each shingle that passes the filter occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), alnum_table()
        for batch in batches:
            for part in batch_words(batch.column(0), table, hasher):
                found = [np.zeros(0, np.uint64)]
                for width in widths:
                    at, keys = shingles(part, width)
                    hit = may_hold(packed.value, keys)
                    pairs = np.unique(np.stack([part.doc[at[hit]].astype(np.uint64), keys[hit]], 1), axis=0)
                    found.append(pairs[:, 1])
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    counts = docs.select("text").mapInArrow(tidied(run), "shingle long, n long")
    return counts.groupBy("shingle").agg(F.sum("n").alias("df"))


def _meetings(docs: DataFrame, packed, widths: list[int], row: Column) -> DataFrame:
    """doc_id, n_words, hits, _row: per document row, the places of shingles that pass the filter, with the words around."""
    before = WINDOW - min(widths, default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), alnum_table()
        kind = pa.struct([("at", pa.int32()), ("shingle", pa.int64()), ("lo", pa.int32()), ("around", pa.list_(pa.int64()))])
        for batch in batches:
            for part in batch_words(batch.column(1), table, hasher):
                where, what = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for width in widths:
                    at, keys = shingles(part, width)
                    hit = may_hold(packed.value, keys)
                    where.append(at[hit])
                    what.append(keys[hit])
                at, keys = np.concatenate(where), np.concatenate(what)
                order = np.argsort(at, kind="stable")
                at, keys = at[order], keys[order]
                doc = part.doc[at]
                begin, stop = part.offsets[doc], part.offsets[doc + 1]
                lo, hi = np.maximum(begin, at - before), np.minimum(stop, at + WINDOW)
                span = np.repeat(lo - np.r_[0, np.cumsum(hi - lo)[:-1]], hi - lo) + np.arange((hi - lo).sum())
                around = list_array(part.hashes.view(np.int64)[span], hi - lo, pa.int64())
                hits = pa.StructArray.from_arrays(
                    [pa.array((at - begin).astype(np.int32)), pa.array(keys.view(np.int64)), pa.array((lo - begin).astype(np.int32)), around],
                    fields=list(kind),
                )
                sizes = np.bincount(doc, minlength=part.docs)
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                own = batch.slice(part.first, part.docs)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array(np.diff(part.offsets)), pa.ListArray.from_arrays(offsets, hits), own.column(2)],
                    names=["doc_id", "n_words", "hits", "_row"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    hits = "array<struct<at: int, shingle: long, lo: int, around: array<long>>>"
    schema = f"doc_id {kind}, n_words long, hits {hits}, _row long"
    return docs.select("doc_id", "text", row.alias("_row")).mapInArrow(tidied(run), schema)


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids, contaminated for each row of `docs` (columns doc_id, text).

    n_hit counts the words inside any occurrence of a window, item_ids are the items with occurring windows, sorted as
    strings. A document is contaminated if at least a twentieth of its words is hit.
    """
    return _judged(docs, benchmark, F.monotonically_increasing_id()).drop("_row")


def _judged(docs: DataFrame, benchmark: DataFrame, row: Column) -> DataFrame:
    """The columns of `contamination` and _row, the row's number."""
    spark = docs.sparkSession
    found = stored(windows(benchmark))
    single = found.dropDuplicates(["wkey"])
    parts = single.select("wkey", F.posexplode("shingles").alias("place", "shingle"))
    widths = [r[0] for r in found.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()]  # 5 at most
    df = _rarity(docs, spark.sparkContext.broadcast(membership(parts, "shingle")), widths)
    rarest = (
        parts.join(df, "shingle")  # a window with a shingle that no document has can't occur; the other shingles tell
        .groupBy("wkey")
        .agg(F.min(F.struct("df", "shingle", "place")).alias("p"), F.countDistinct("place").alias("n"))
    )
    prefixes = stored(
        rarest.join(single, "wkey").where("n = size(shingles)").select("wkey", "words", "p.shingle", "p.place")
    )
    met = stored(_meetings(docs, spark.sparkContext.broadcast(membership(prefixes, "shingle")), widths, row))
    hits = met.select("_row", F.explode("hits").alias("h")).select("_row", "h.*")
    first = F.col("at") - F.col("place")
    inside = hits.join(prefixes, "shingle").where((first >= F.col("lo")) & (first - F.col("lo") + F.size("words") <= F.size("around")))
    same = inside.where(F.slice("around", first - F.col("lo") + 1, F.size("words")) == F.col("words"))
    occurring = same.select("_row", "wkey", first.alias("first"), (first + F.size("words")).alias("stop"))
    earlier = Window.partitionBy("_row").orderBy("first", "stop").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        occurring.select("_row", "first", "stop")
        .withColumn("reach", F.coalesce(F.max("stop").over(earlier), F.lit(0)))
        .groupBy("_row")
        .agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("first", "reach"))).alias("n_hit"))
    )
    items = (
        occurring.select("_row", "wkey")
        .distinct()
        .join(found.select("wkey", "item_id").distinct(), "wkey")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        met.select("_row", "doc_id", "n_words")
        .join(covered.join(items, "_row"), "_row", "left")
        .select(
            "doc_id",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
            "_row",
        )
    )


def digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of the query: the items as a count and a digest."""
    return contamination(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that aren't contaminated. Each row is judged alone, whatever rows share its doc_id."""
    at = free_name("_at", docs)
    rows = stored(numbered(docs, at))
    bad = stored(_judged(rows, benchmark, F.col(at)).where("contaminated").select(F.col("_row").alias("_bad")))
    return rows.join(bad, rows[at] == bad["_bad"], "left_anti").drop(at)


ORACLE = r"""
WITH item AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS words
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM (SELECT *, least(13, len(ws)) AS n FROM item WHERE len(ws) > 0))
), size AS (
  SELECT DISTINCT n FROM win
), gram AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM doc, size WHERE len(ws) >= n
), met AS (
  SELECT g.doc_id, g.i, g.n, w.item_id FROM (SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS words FROM gram) g
  JOIN win w ON w.n = g.n AND w.words = g.words
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM met) GROUP BY doc_id
), held AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM met) GROUP BY doc_id
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM doc d LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""
