"""Operator 1, nearest neighbours by randomly rotated one-bit codes.

Vectors are taken relative to the nearest of some centroids, scaled to length 1 and rotated at random in a wider space. The code
of a vector is the sign bit of each rotated component, packed into 64-bit words; beside it stand its length r before scaling and
the inner product f of code and vector. For a query q relative to the same centroid, <code, q> / f estimates the inner product of
vector and query without bias, and sqrt((1 - f * f) / f / f / (width - 1)) * |q| is the deviation of its error, so wider codes
err less. The components of a rotated query are rounded to QUERY_BITS bits, so that <code, q> is a count of common bits of the
code with each of as many bit planes of the query.

A query first looks at its nearest cells: the FIRST best candidates by estimate are measured exactly, and the k-th best distance
is its bound. Then the codes of all its cells are compared with that one bound: only vectors whose lower bound, `SURE` deviations
below the estimate, doesn't lie above it are reranked with their original components in double precision. Codes alone are dealt
out for this; the vectors of what is reranked are joined afterwards.

Vectors that are equal count once in codes and searches. Centroids, as many as the square root of the rows up to `CENTROIDS`, are
fitted in two levels on a bounded sample; every vector is indexed. A query probes the cells of its nearest centroids: so many
that, in the sample, `RECALL` of the neighbours lie in them, and further ones until these hold `LEAST_ROWS` vectors. Cells are cut
into blocks of about `BLOCK` vectors, and queries into blocks of `ASKS`, so a hot cell is many tasks.

Cases: vectors that are null, zero or hold null or non-finite components take no part, nor do rows without id. A vector shorter
than another counts as if it went on with zeros; codes are of the first components, as many as most vectors have, which bound
distances from below just the same. Repeated rows count once, several vectors of an id are searched each; ties go to the
smaller id; with fewer candidates than k all are returned; only vec_id and embedding are read, so other columns can have any name.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carledger.llm.tables import numbered, stored

SAMPLE = 65_536  # vectors that the centroids are fitted on at most: those of the smallest hashes
SAMPLE_BYTES = 64 << 20  # of them together
CENTROIDS = 4_096  # at most; one for each 20 vectors of the sample
ROUNDS = 10  # of clustering
RECALL = 0.97  # share of the neighbours that the probed cells of a query hold, as measured in the sample
TRIALS = 256  # vectors of the sample that this is measured with
LEAST_ROWS = 2_000  # distinct vectors that a query looks at, if there are so many
NEAR_ROWS = 256  # distinct vectors in the cells that its bound is taken from, at least
FIRST = 4  # times k candidates of each block that the bound is measured with
WIDEN, WIDE = 4, 1_024  # codes have WIDEN bits a component, up to WIDE bits, and never fewer than components
QUERY_BITS = 4
SURE = 3.0  # standard deviations that the bounds allow for
BLOCK, ASKS = 4_096, 1_024  # vectors and queries of a block


def _usable(embedding: Column) -> Column:
    doubles = embedding.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(doubles, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array, size: int | None = None) -> np.ndarray:
    """The vectors as rows of `size` components, or of as many as the longest has; shorter ones end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False).astype(float), column.value_lengths().to_numpy(zero_copy_only=False)
    size = int(lengths.max(initial=0)) if size is None else size
    if (lengths == size).all():
        return flat.reshape(-1, size)
    out, at = np.zeros((len(lengths), size)), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row[at < size], at[at < size]] = flat[at < size]
    return out


def code_width(size: int) -> int:
    """Bits of a code for vectors of `size` components: whole words."""
    return -(-max(size, min(WIDEN * size, WIDE)) // 64) * 64


def rotation(size: int) -> np.ndarray:
    """Rows of a random orthogonal matrix that take vectors into the space of the codes, the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng(11).normal(size=(code_width(size), size)))
    return (q * np.sign(np.diag(r))).T.astype(np.float32)


def _lloyd(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centre = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        own = nearest(x, centre)[:, 0]
        centre = np.stack([x[own == c].mean(0) if (own == c).any() else centre[c] for c in range(k)])
    return centre


def centroids(x: np.ndarray, k: int) -> np.ndarray:
    """k centroids of a sample: groups first, then the centroids of each group, in proportion to its rows."""
    k, rng = int(np.clip(k, 1, max(1, len(x) // 20))), np.random.default_rng(2)
    if k <= 16:
        return _lloyd(x, k, rng)
    top = _lloyd(x, int(np.sqrt(k)), rng)
    own = nearest(x, top)[:, 0]
    groups = [x[own == c] for c in range(len(top)) if (own == c).any()]
    return np.concatenate([_lloyd(g, int(np.clip(round(k * len(g) / len(x)), 1, len(g))), rng) for g in groups])


def nearest(x: np.ndarray, centre: np.ndarray, n: int = 1) -> np.ndarray:
    """The n nearest centroids of each row, nearest first."""
    out, square = [np.zeros((0, n), np.int64)], (centre * centre).sum(1)
    for lo in range(0, len(x), 4096):
        d = square - 2 * x[lo : lo + 4096] @ centre.T
        out.append(d.argmin(1)[:, None] if n == 1 else np.argsort(d, 1, kind="stable")[:, :n])
    return np.concatenate(out)


def probes_needed(x: np.ndarray, centre: np.ndarray, k: int) -> int:
    """How many cells hold the share RECALL of the k nearest rows of x for its first rows."""
    cell, order = nearest(x, centre)[:, 0], nearest(x[:TRIALS], centre, len(centre))
    place = np.argsort(order, 1)  # of each cell, by query
    found, square, take = [], (x * x).sum(1), min(k, len(x) - 1)
    for i, q in enumerate(x[:TRIALS]):
        d = square - 2 * x @ q
        d[i] = np.inf
        found += place[i, cell[np.argpartition(d, take - 1)[:take]]].tolist() if take else []
    return int(np.quantile(found, RECALL, method="higher")) + 1 if found else 1


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, lengths r and inner products f of vectors relative to their centroids."""
    away = (x - centre) @ turn
    r = np.linalg.norm(x - centre, axis=1)
    unit = away / np.maximum(r, 1e-300)[:, None]
    f = np.abs(unit).sum(1) / np.sqrt(turn.shape[1])
    return np.packbits(unit > 0, axis=1), r, np.where(r > 0, f, 1.0)


class Planes(NamedTuple):
    """Rotated relative queries, each component rounded to low + step * a whole number of QUERY_BITS bits."""

    length: np.ndarray
    low: np.ndarray
    step: np.ndarray
    sums: np.ndarray  # of the components
    bits: np.ndarray  # [queries, QUERY_BITS, words]


def planes(q: np.ndarray, turn: np.ndarray) -> Planes:
    away = q @ turn
    low, most = away.min(1), (1 << QUERY_BITS) - 1
    step = np.maximum((away.max(1) - low) / most, 1e-300)
    level = np.rint((away - low[:, None]) / step[:, None]).astype(np.uint8)
    bits = np.stack([np.packbits(level >> j & 1, axis=1).view(np.uint64) for j in range(QUERY_BITS)], axis=1)
    return Planes(np.linalg.norm(q, axis=1), low, step, low * away.shape[1] + step * level.sum(1), bits)


def bounds(codes: np.ndarray, r: np.ndarray, f: np.ndarray, of: Planes, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the squared distances of coded vectors (words) to query i, and lower bounds."""
    width = codes.shape[1] * 64
    common = np.bitwise_count(codes[:, None, :] & of.bits[i]).sum(2, dtype=np.int64) @ (1 << np.arange(QUERY_BITS))
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
    inner = 2 * (of.low[i] * ones + of.step[i] * common) - of.sums[i]  # of the signs of the code with the rounded query
    product = inner / np.sqrt(width) / f * r
    spread = np.sqrt(np.maximum(0, 1 - f * f) / (f * f) / (width - 1)) * of.length[i]
    error = SURE * r * np.sqrt(spread**2 + of.step[i] ** 2 / 12 / (f * f)) + 1e-5 * r * of.length[i]
    square = r * r + of.length[i] ** 2
    return square - 2 * product, square - 2 * (product + error)


UNIT = ["cell", "part", "ask"]
_PAIRS = "cell int, part int, ask int, query long, nodes array<long>"


def compare(table: pa.Table, size: int, take: int | None, centre: np.ndarray, turn: np.ndarray) -> pa.Table:
    """The nodes of a block worth measuring for each query of a block: the `take` best by estimate, or all that may lie within
    the bound of the query. And one row without query: all those nodes, each once."""
    is_query = table["is_query"].to_numpy(zero_copy_only=False)
    own, asked = table.filter(pa.array(~is_query)), table.filter(pa.array(is_query))
    cell = centre[table["cell"][0].as_py()]
    ids, names, bound = own["node"].to_numpy(), asked["node"].to_numpy(), asked["bound"].to_numpy()
    out = []
    if len(ids) and len(names):
        codes = np.frombuffer(b"".join(own["code"].to_pylist()), np.uint64).reshape(len(ids), -1)
        r, f = own["r"].to_numpy(), own["f"].to_numpy()
        of = planes(_matrix(asked["vector"], size) - cell, turn)
        for i in range(len(names)):
            guess, low = bounds(codes, r, f, of, i)
            if take is None:
                may = np.flatnonzero(low <= bound[i] * bound[i] * (1 + 1e-9))
            else:
                may = np.argpartition(guess, min(take, len(ids)) - 1)[:take]
            out.append(ids[may])
        out.append(np.unique(np.concatenate(out)))
        names = [*names.tolist(), None]
    else:
        names = []
    unit = [pa.array([table[c][0].as_py()] * len(names), pa.int32()) for c in UNIT]
    return pa.table([*unit, pa.array(names, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=[*UNIT, "query", "nodes"])


def measure(table: pa.Table, k: int) -> pa.Table:
    """The k nearest of the nodes asked for by each query, and all as near as the last."""
    is_query = table["is_query"].to_numpy(zero_copy_only=False)
    vectors = _matrix(table["vector"])
    x, ids = vectors[~is_query], table["node"].to_numpy()[~is_query]
    order = np.argsort(ids)
    asked = table.filter(pa.array(is_query))
    out = {"query": [], "node": [], "score": []}
    for q, name, nodes in zip(vectors[is_query], asked["node"].to_pylist(), asked["nodes"], strict=True):
        nodes = nodes.values.to_numpy()
        at, score = order[np.searchsorted(ids, nodes, sorter=order)], np.empty(len(nodes))
        for lo in range(0, len(at), 4096):
            away = x[at[lo : lo + 4096]] - q
            score[lo : lo + 4096] = np.sqrt(np.einsum("ij,ij->i", away, away))
        if len(at):
            best = np.flatnonzero(score <= np.partition(score, min(k, len(at)) - 1)[min(k, len(at)) - 1])
            out["query"] += [name] * len(best)
            out["node"] += nodes[best].tolist()
            out["score"] += score[best].tolist()
    return pa.table(out, schema=pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())]))


class Index(NamedTuple):
    classes: DataFrame  # node, vector, ids: equal vectors
    coded: DataFrame  # node, cell, code, r, f
    size: int  # components that are coded
    shared: Broadcast  # centroids and rotation, bounded
    counts: np.ndarray  # vectors of each cell
    probes: int  # cells that a query looks at, at least


def index(rows: DataFrame, k: int) -> Index | None:
    """Codes of all rows (vec_id, vector); None without rows."""
    spark = rows.sparkSession
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return None
    size = sizes[0]
    # A class of equal vectors: its k + 1 smallest ids can be results, all its ids can be queries.
    nth = Window.partitionBy("vector").orderBy("vec_id")
    # Equal rows are told apart by their id alone; the limit on the rank is applied before rows are dealt out.
    ids = rows.withColumn("nth", F.dense_rank().over(nth)).where(F.col("nth") <= k + 1)
    classes = ids.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    classes = stored(numbered(classes, "node"))
    most = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * size)))
    sample = classes.orderBy(F.xxhash64("vector"), F.element_at("ids", 1)).limit(most).select(F.slice("vector", 1, size).alias("vector")).toArrow()
    drawn, turn = _matrix(sample["vector"], size), rotation(size)
    middle = centroids(drawn, min(CENTROIDS, int(np.sqrt(classes.count()))))
    shared = spark.sparkContext.broadcast((middle, turn))

    def coded(batches):
        middle, turn = shared.value
        for batch in batches:
            x = _matrix(batch.column("vector"), size)
            cell = nearest(x, middle)[:, 0]
            codes, r, f = encode(x, middle[cell], turn)
            raw = pa.array([c.tobytes() for c in codes], pa.binary())
            columns = [batch.column("node"), pa.array(cell.astype(np.int32)), raw, pa.array(r), pa.array(f)]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "cell", "code", "r", "f"])

    codes = stored(classes.select("node", "vector").mapInArrow(coded, "node long, cell int, code binary, r double, f double"))
    held = dict(codes.groupBy("cell").count().collect())  # a count for each centroid
    counts = np.array([held.get(c, 0) for c in range(len(middle))])
    return Index(classes, codes, size, shared, counts, probes_needed(drawn, middle, k))


def probes(found: Index, asked: DataFrame, near: bool) -> DataFrame:
    """node, cell, vector, bound: the cells that each of `asked` (node, vector, bound) looks at, or only its nearest ones."""
    counts, size, shared = found.counts, found.size, found.shared
    rows, cells_at_least = (NEAR_ROWS, 1) if near else (LEAST_ROWS, found.probes)

    def run(batches):
        for batch in batches:
            middle, _ = shared.value
            order = nearest(_matrix(batch.column("vector"), size), middle, len(middle))
            reached = np.cumsum(counts[order], 1)
            # As many cells as asked for, and more until enough vectors are reached.
            need = np.maximum((reached < rows).sum(1) + 1, cells_at_least)
            cells = pa.array([o[:n].tolist() for o, n in zip(order, need, strict=True)], pa.list_(pa.int32()))
            columns = [batch.column("node"), cells, batch.column("vector"), batch.column("bound")]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "cells", "vector", "bound"])

    spread = asked.select("node", "vector", "bound").mapInArrow(run, "node long, cells array<int>, vector array<double>, bound double")
    return stored(spread.select("node", F.explode("cells").alias("cell"), "vector", "bound"))


def pairs(found: Index, probed: DataFrame, take: int | None) -> DataFrame:
    """cell, part, ask, query, nodes: what `compare` leaves to be measured, by blocks of codes and of queries."""
    parts = found.coded.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    asks = probed.groupBy("cell").agg(F.ceil(F.count("*") / ASKS).cast("int").alias("asks"))
    blocks = parts.join(asks, "cell")
    part, ask = F.pmod(F.xxhash64("node"), "parts").cast("int"), F.pmod(F.xxhash64("node"), "asks").cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = found.coded.join(blocks, "cell").withColumn("part", part).withColumn("ask", every("asks")).withColumn("is_query", F.lit(False))
    right = probed.join(blocks, "cell").withColumn("ask", ask).withColumn("part", every("parts")).withColumn("is_query", F.lit(True))
    for c, kind in (("code", "binary"), ("r", "double"), ("f", "double")):
        right = right.withColumn(c, F.lit(None).cast(kind))
    for c, kind in (("vector", "array<double>"), ("bound", "double")):
        left = left.withColumn(c, F.lit(None).cast(kind))
    names = [*UNIT, "is_query", "node", "code", "r", "f", "vector", "bound"]
    size, shared = found.size, found.shared

    def run(table: pa.Table) -> pa.Table:
        return compare(table, size, take, *shared.value)

    return stored(left.select(names).union(right.select(names)).groupBy(UNIT).applyInArrow(run, _PAIRS))


def measured(found: Index, chosen: DataFrame, k: int) -> DataFrame:
    """query, node, score: the exact distances of the nearest of the chosen pairs. Only vectors that a block of queries asks for
    are sent to it."""
    vectors = found.classes.select("node", "vector")
    needed = chosen.where("query is null").select(*UNIT, F.explode("nodes").alias("node")).join(vectors, "node")
    left = needed.select(*UNIT, F.lit(False).alias("is_query"), "node", "vector", F.lit(None).cast("array<long>").alias("nodes"))
    right = chosen.join(vectors.withColumnRenamed("node", "query"), "query")
    right = right.select(*UNIT, F.lit(True).alias("is_query"), F.col("query").alias("node"), "vector", "nodes")

    def run(table: pa.Table) -> pa.Table:
        return measure(table, k)

    scores = left.union(right).groupBy(UNIT).applyInArrow(run, "query long, node long, score double")
    return scores.withColumn("place", F.rank().over(Window.partitionBy("query").orderBy("score"))).where(F.col("place") <= k)


def search(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows by Euclidean distance for each row where `queries` holds."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    found = index(rows, k)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = stored(rows.where(queries).select(F.col("vec_id").alias("query_id"), "vector").distinct())
    own = found.classes.join(asked.select("vector").distinct(), "vector", "left_semi").select("node", "vector")
    # Of classes of one vector each, the k + 1 nearest hold the k nearest rows; ties at the end are kept.
    near = pairs(found, probes(found, own.withColumn("bound", F.lit(0.0)), True), FIRST * (k + 1))
    bound = measured(found, near, k + 1).groupBy("query").agg(F.max("score").alias("bound"), F.count("*").alias("n"))
    bound = bound.select(F.col("query").alias("node"), F.when(F.col("n") > k, F.col("bound")).otherwise(float("inf")).alias("bound"))
    chosen = pairs(found, probes(found, own.join(bound, "node"), False), None)
    best = measured(found, chosen, k + 1)
    named = best.join(found.classes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("vec_id"))
    askers = asked.join(found.classes.select(F.col("node").alias("query"), "vector"), "vector").select("query", "query_id")
    links = named.join(askers, "query").where("vec_id != query_id")
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    # An id with several vectors is found by its nearest.
    links = links.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = links.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
