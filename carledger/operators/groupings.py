"""Totals at several levels, exact distinct counts, and the difference of two tables, each from one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.operators.rowid import row_id


def cube_totals(df: DataFrame, dimensions: list[str], sums: dict[str, Column], sets: list[list[str]] | None = None) -> DataFrame:
    """The sums at every combination of `dimensions` (or at the given grouping sets), with `level`: the grouping id, in which
    the bit of a dimension that was added up is set. So a null value of a dimension and a total over it are told apart.

    The finest groups are added up first; the levels are made from those, so rows aren't multiplied by the number of levels
    before the first shuffle, only finest groups are.
    """
    finest = df.groupBy(*dimensions).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    again = [F.sum(n).alias(n) for n in sums]
    if sets is None:
        grouped = finest.cube(*dimensions)
    else:
        grouped = finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dimensions])
    return grouped.agg(F.grouping_id().cast("int").alias("level"), *again)


def distinct_bitmaps(df: DataFrame, group: list[str], item: str) -> DataFrame:
    """group, bucket, bits: the distinct non-null items of each group as bitmaps over dense item ids, 4 KB each at most. They
    merge by `bitmap_or_agg`, so that counts of any coarser grouping come from them and not from the rows."""
    pairs = df.filter(F.col(item).isNotNull()).select(*group, item).distinct()
    ids = row_id(pairs.select(item).distinct(), [F.col(item).asc()], "_id")
    known = pairs.join(ids, item).select(*group, "_id")
    bucket, place = F.expr("bitmap_bucket_number(_id)"), F.expr("bitmap_bit_position(_id)")
    return known.groupBy(*group, bucket.alias("bucket")).agg(F.bitmap_construct_agg(place).alias("bits"))


def distinct_counts(bitmaps: DataFrame, group: list[str], name: str = "n_distinct") -> DataFrame:
    """The exact distinct count of each `group`, merged from bitmaps of the same or a finer grouping."""
    merged = bitmaps.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.groupBy(*group) if group else merged
    return counted.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def multiset_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each distinct row of both tables with how many copies are `added`, `gone` and `kept`. Nulls equal each other. Copies are
    counted on both sides before the shuffle, in one aggregate; no join."""
    columns = old.columns
    if set(new.columns) != set(columns) or {"added", "gone", "kept"} & set(columns):
        raise ValueError("both tables need the same columns, none called added, gone or kept")
    marked = old.withColumn("_old", F.lit(1)).unionByName(new.withColumn("_old", F.lit(0)))
    counted = marked.groupBy(*columns).agg(F.sum("_old").alias("_was"), F.sum(1 - F.col("_old")).alias("_is"))
    was, now = F.col("_was"), F.col("_is")
    return counted.select(
        *columns,
        F.greatest(now - was, F.lit(0)).cast("bigint").alias("added"),
        F.greatest(was - now, F.lit(0)).cast("bigint").alias("gone"),
        F.least(was, now).cast("bigint").alias("kept"),
    )


def _copies(difference: DataFrame, count: str) -> DataFrame:
    some = difference.filter(F.col(count) > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(count).cast("int"))))
    return some.drop("added", "gone", "kept", "_copy")


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of `left` less as many copies as `right` has."""
    return _copies(multiset_difference(left, right), "gone")


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """As many copies of each row as both have."""
    return _copies(multiset_difference(left, right), "kept")
