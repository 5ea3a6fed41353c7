"""Dense 1..n ids in a global order, without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carledger.session import cut_lineage

# monotonically_increasing_id() holds the partition number above this bit, the position in the partition below.
_PART_BIT = 33


def row_id(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """Number rows 1..n by `order`, which must identify a row.

    Range partitions are sorted on their own; a row's id is its place in its partition plus the sizes of the
    partitions before it. The placed rows are checkpointed first, because range bounds are sampled and must not
    be drawn a second time for the counts. Only the sizes, one row per shuffle partition, meet in one task and are
    broadcast.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", _PART_BIT)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _PART_BIT) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select((F.col("_before") + place + 1).alias(name), *df.columns)


def small_row_id(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """The plain form, for results whose number of rows is fixed by the query (A1 has two)."""
    return df.select(F.row_number().over(Window.orderBy(*order)).cast("bigint").alias(name), *df.columns)
