"""Check-and-put requests, each applied only if its cell then holds the expected value.

Requests of one cell depend on each other in order, but no cell is ever gathered: a request that is applied leaves its
value, and the next one applied is the first later request that expects this value. So every request points to at most
one later request, and the applied ones are those on the path from the cell's first state. Jump pointers, doubled each
round, mark the path in log2(path length) rounds of joins on unique keys, for all cells at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.operators.cells import latest
from carledger.operators.scan import next_value
from carledger.schema import CELL
from carledger.session import cut_lineage

_RESULT = [*CELL, "seq", "applied"]


def _state(c: Column) -> Column:
    """A value as a join key, with its own key for an absent one."""
    return F.coalesce(F.concat(F.lit("="), c), F.lit("absent"))


def check_and_put(requests: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """`CELL, seq, expected, value` -> `CELL, seq, applied`.

    `seq` is unique in a cell; a null `expected` asks for an absent cell. `base` holds the cells before. Requests that
    check one cell and put another are operations of a log, see `mutations.replay`.
    """
    cells = requests.select(*CELL).distinct()
    if base is None:
        started = cells.withColumn("_start", F.lit(None).cast("string"))
    else:
        started = cells.join(latest(base).select(*CELL, F.col("value").alias("_start")), CELL, "left")
    # Three kinds of marks, by what a later request may expect: the first state, then for each request what it asks for
    # and, behind that, what it leaves.
    start = started.select(*CELL, F.lit(None).cast("bigint").alias("seq"), _state(F.col("_start")).alias("_state"), F.lit(0).alias("_kind"))
    asks = requests.select(*CELL, "seq", _state(F.col("expected")).alias("_state"), F.lit(1).alias("_kind"))
    leaves = requests.select(*CELL, "seq", _state(F.col("value")).alias("_state"), F.lit(2).alias("_kind"))
    marks = start.unionByName(asks).unionByName(leaves).withColumn("_begun", F.col("_kind") > 0)
    pointed = next_value(
        marks, [*CELL, "_state"], ["_begun", "seq", "_kind"], F.when(F.col("_kind") == 1, F.col("seq")), "next"
    ).filter((F.col("_kind") != 1) & F.col("next").isNotNull())
    pointed = cut_lineage(pointed.select(*CELL, "seq", "next", "_kind"))
    reached = cut_lineage(pointed.filter("_kind = 0").select(*CELL, F.col("next").alias("seq")))
    jumps = pointed.filter("_kind = 2").select(*CELL, "seq", "next")
    while not jumps.isEmpty():
        ahead = reached.join(jumps, [*CELL, "seq"]).select(*CELL, F.col("next").alias("seq"))
        reached = cut_lineage(reached.unionByName(ahead).distinct())
        second = jumps.select(*CELL, F.col("seq").alias("next"), F.col("next").alias("_far"))
        jumps = cut_lineage(jumps.join(second, [*CELL, "next"]).select(*CELL, "seq", F.col("_far").alias("next")))
    marked = reached.withColumn("applied", F.lit(True))
    return (
        requests.select(*CELL, "seq")
        .join(marked, [*CELL, "seq"], "left")
        .select(*CELL, "seq", F.coalesce("applied", F.lit(False)).alias("applied"))
        .select(*_RESULT)
    )


def final_values(requests: DataFrame, results: DataFrame) -> DataFrame:
    """The value each cell holds after the requests that were applied."""
    applied = results.filter("applied").select(*CELL, "seq")
    return (
        requests.join(applied, [*CELL, "seq"], "left_semi")
        .groupBy(*CELL)
        .agg(F.max_by("value", "seq").alias("value"))
    )
