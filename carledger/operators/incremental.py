"""Statistics that grow with the listings: stored aggregate states, merged with what a day brings; and frequent items.

A state holds sums and counts in whole numbers (so that any order of merging gives the same) and a quantile sketch, for each
brand, transfer count and fuel. Merging is a union and one aggregate of states, never of the listings behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.operators.stats import positive

KEYS = ["brand", "transfer_count", "fuel_type"]
SUMS = ["listings", "priced", "cents", "both", "both_cents", "both_new_cents"]
SKETCH_K = 800  # of the quantile sketch: its rank error is below 1 % of the rows
RANK_ERROR = 0.01


def _cents(price: Column) -> Column:
    return F.round(price.cast("double") * 100).cast("bigint")


def state(typed: DataFrame) -> DataFrame:
    """The state of some typed listings."""
    both = positive("price") & positive("new_price")
    none = F.lit(0).cast("bigint")
    return typed.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("listings"),
        F.count("price").alias("priced"),
        F.coalesce(F.sum(_cents(F.col("price"))), none).alias("cents"),
        F.count(F.when(both, 1)).alias("both"),
        F.coalesce(F.sum(F.when(both, _cents(F.col("price")))), none).alias("both_cents"),
        F.coalesce(F.sum(F.when(both, _cents(F.col("new_price")))), none).alias("both_new_cents"),
        F.kll_sketch_agg_float(F.when(positive("price"), F.col("price")), F.lit(SKETCH_K)).alias("prices"),
    )


def merged(*states: DataFrame) -> DataFrame:
    """The state of all listings behind some states."""
    every = states[0]
    for other in states[1:]:
        every = every.unionByName(other)
    return every.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS], F.kll_merge_agg_float("prices").alias("prices"))


def advance(path: str, typed: DataFrame, new_path: str) -> DataFrame:
    """Merges a day's typed listings into the state stored at `path`, stores the result at `new_path` and returns it. The old
    state stays as it was, so a job that is run again starts from the same one."""
    spark = typed.sparkSession
    merged(spark.read.parquet(path), state(typed)).write.mode("overwrite").parquet(new_path)
    return spark.read.parquet(new_path)


def brand_summary(found: DataFrame) -> DataFrame:
    """A2, A3 and A7 from a state: listings, average price, average new and current price of listings with both, and the drop
    in percent, by brand."""
    sums = found.groupBy("brand").agg(*[F.sum(c).alias(c) for c in SUMS])
    some = lambda c, n: F.when(F.col(n) > 0, F.col(c) / F.col(n) / 100)
    new, current = some("both_new_cents", "both"), some("both_cents", "both")
    return sums.select(
        "brand", "listings", some("cents", "priced").alias("avg_price"), new.alias("avg_new_price"), current.alias("avg_current_price"),
        ((new - current) / new * 100).alias("price_drop_percent"),
    )


def transfer_quartiles(found: DataFrame) -> DataFrame:
    """A5 from a state: quartiles by brand and transfer count, each within RANK_ERROR of its rank."""
    sketches = found.filter(F.col("transfer_count").isNotNull()).groupBy("brand", "transfer_count").agg(F.kll_merge_agg_float("prices").alias("prices"))
    filled = sketches.filter(F.kll_sketch_get_n_float("prices") > 0)
    ranks = {"min_price": 0.0, "q1_price": 0.25, "median_price": 0.5, "q3_price": 0.75, "max_price": 1.0}
    return filled.select("brand", "transfer_count", *[F.kll_sketch_get_quantile_float("prices", F.lit(p)).alias(n) for n, p in ranks.items()])


def frequent(df: DataFrame, columns: list[str], share: float) -> DataFrame:
    """`columns` and n of every combination that makes up more than `share` of the rows, exactly; nulls are values.

    A first pass keeps counters for a bounded number of combinations (a mergeable summary after Misra and Gries, which loses none
    above the share), a second one counts these candidates alone. So what is shuffled and broadcast is bounded by 1 / share, not
    by the number of combinations.
    """
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    # The summary's error is 3.5 / size of the rows at most: below a third of the share.
    size = 1 << (int(11 / share) - 1).bit_length()
    if size > 1 << 20:
        raise ValueError("share is too small for a bounded summary: count all combinations")
    item = F.to_json(F.struct(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"})
    items = df.select(*columns, item.alias("_item"))
    totals = items.agg(F.expr(f"approx_top_k(_item, {size // 2}, {size})").alias("top"), F.count(F.lit(1)).alias("_total"))
    candidates = totals.select(F.explode("top.item").alias("_item"), "_total")
    counted = items.join(F.broadcast(candidates), "_item").groupBy(*columns).agg(F.count(F.lit(1)).alias("n"), F.max("_total").alias("_total"))
    return counted.filter(F.col("n") > F.col("_total") * F.lit(share)).select(*columns, "n")
