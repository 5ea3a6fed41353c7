"""Running aggregates inside groups of any size.

Rows are range-partitioned by group and order, with a row number against ties, so a hot group is cut into partitions of
about equal size, whatever its order values are. Each partition is worked through on its own; what lies before it in its
group, one pre-aggregated row for each partition, is then combined in. The placed rows are checkpointed, because range
bounds are sampled and must not be drawn twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carledger.session import cut_lineage


def placed(df: DataFrame, group: list[str], order: list[str], descending: bool = False) -> DataFrame:
    """`df` plus `_part`, which grows along the order of a group, and `_tie`, which breaks ties inside a part."""
    along = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*group, *along, "_tie")
    return cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))


def _running(
    df: DataFrame,
    group: list[str],
    order: list[str],
    amount: Column,
    name: str,
    descending: bool,
    aggregate: Callable[[Column], Column],
    combine: Callable[[Column, Column], Column],
    last: int,
) -> DataFrame:
    along = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    parts = placed(df.withColumn("_amount", amount), group, order, descending)
    here = Window.partitionBy(*group, "_part").orderBy(*along, "_tie").rowsBetween(Window.unboundedPreceding, last)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = parts.groupBy(*group, "_part").agg(aggregate(F.col("_amount")).alias("_whole"))
    # Only parts with something before them: none for a group that lies in one partition.
    before = whole.select(*group, "_part", aggregate(F.col("_whole")).over(earlier).alias("_before")).filter(
        F.col("_before").isNotNull()
    )
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*group, "_part"]]
    joined = parts.withColumn("_here", aggregate(F.col("_amount")).over(here)).alias("a").join(before.alias("b"), on, "left")
    return joined.select(*[f"a.{c}" for c in df.columns], combine(F.col("_here"), F.col("_before")).alias(name))


def running_total(
    df: DataFrame, group: list[str], order: list[str], amount: Column, name: str, descending: bool = False
) -> DataFrame:
    """`df` plus the running sum of `amount` within `group`, by `order`."""
    plus = lambda here, before: here + F.coalesce(before, F.lit(0))
    return _running(df, group, order, amount, name, descending, F.sum, plus, Window.currentRow)


def running_count(df: DataFrame, group: list[str], order: list[str], name: str, descending: bool = False) -> DataFrame:
    """`df` plus each row's place in its group, from 1."""
    return running_total(df, group, order, F.lit(1).cast("bigint"), name, descending)


def next_value(df: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """`df` plus the smallest `value` among the later rows of the group (null if there is none)."""
    return _running(df, group, order, value, name, True, F.min, F.least, -1)


def carried_last(df: DataFrame, group: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """`df` plus the last non-null `value` up to each row of its group. `value` must grow along `order`, as a struct that begins
    with the order does; a partition hands its largest one on."""
    return _running(df, group, order, value, name, False, F.max, F.coalesce, Window.currentRow)


def running_totals(df: DataFrame, group: list[str], order: list[str], amounts: dict[str, Column]) -> DataFrame:
    """`df` plus the running sum of each amount within `group`, by `order`: all from one placing of the rows and one join."""
    parts = placed(df.withColumns({f"_of_{n}": c for n, c in amounts.items()}), group, order)
    here = Window.partitionBy(*group, "_part").orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = parts.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_of_{n}").alias(f"_of_{n}") for n in amounts])
    before = whole.select(*group, "_part", F.sum("_rows").over(earlier).alias("_rows"), *[F.sum(f"_of_{n}").over(earlier).alias(f"_from_{n}") for n in amounts])
    before = before.filter(F.col("_rows").isNotNull())
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*group, "_part"]]
    summed = parts.withColumns({f"_to_{n}_": F.sum(f"_of_{n}").over(here) for n in amounts})
    joined = summed.alias("a").join(before.alias("b"), on, "left")
    totals = [(F.col(f"a._to_{n}_") + F.coalesce(F.col(f"b._from_{n}"), F.lit(0))).alias(n) for n in amounts]
    return joined.select(*[f"a.{c}" for c in df.columns], *totals)
