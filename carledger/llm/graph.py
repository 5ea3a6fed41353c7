"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carledger.llm.tables import narrow, stored


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of `links` (a, b: long); the label is the smallest node that can be reached.

    Alternates the large-star and the small-star step until every node is linked to its label alone; each keeps the
    components, and the paths get shorter by half or more. Both are a minimum by node, with a map-side half, and a join
    that can be split.
    """
    edges = narrow(links.select("a", "b")).mapInArrow(_local, "u long, v long")
    edges = stored(narrow(edges.distinct()))
    while _tangled(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(narrow(large.where("u != v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v")))
        edges = stored(narrow(narrow(small).distinct()))
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.union(narrow(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct())


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars: (node, smallest node it reaches here). A map-side half of the components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    columns = [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])


def _tangled(edges: DataFrame) -> bool:
    """Whether a node has two smaller neighbours, or both a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = narrow(ends.union(edges.select("v", F.lit(0), F.lit(1))))
    each = narrow(ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")))
    return not each.where("up > 1 or up > 0 and down > 0").isEmpty()
