"""The eight statistics over clean listings, or over their stored typed layer (A1-A10).

Each function gives the full-precision result; `warehouse.store_cast` narrows it to the stored table's types.
All aggregates have a map-side half, so a brand with a third of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.functions.typed import AsOf, age_years, days_since, to_date, to_float, to_int
from carledger.operators.clean import _check
from carledger.operators.rowid import row_id, small_row_id
from carledger.operators.scan import running_total
from carledger.schema import ELECTRIC, GASOLINE


def typed_layer(listings: DataFrame, missing: str = "strict") -> DataFrame:
    """C17: text columns as numbers and dates; malformed text is null. The layer that `pipeline.load` stores, so that casts
    run once and filters on numbers reach the files.

    In literal mode NaN text stays NaN, which Spark treats as greater than any number.
    """
    _check(missing)
    drop_nan = missing == "strict"
    return listings.select(
        "brand",
        "fuel_type",
        "reg_time",
        "post_time",
        to_float(F.col("current_price"), drop_nan).alias("price"),
        to_float(F.col("new_price"), drop_nan).alias("new_price"),
        to_float(F.col("mileage"), drop_nan).alias("mileage"),
        to_int(F.col("transfer_count")).alias("transfer_count"),
        to_date(F.col("reg_time")).alias("reg_date"),
        to_date(F.col("post_time")).alias("post_date"),
    )


def typed_listings(listings: DataFrame, as_of: AsOf = None, missing: str = "strict") -> DataFrame:
    """The typed layer with ages on a day. Takes text listings or a stored typed layer."""
    typed = listings if "reg_date" in listings.columns else typed_layer(listings, missing)
    return typed.withColumns(
        {"car_age": age_years(F.col("reg_date"), as_of), "publish_days": days_since(F.col("post_date"), as_of)}
    )


def positive(name: str) -> Column:
    """Present and above zero."""
    return F.col(name).isNotNull() & (F.col(name) > 0)


def ordered(df: DataFrame, measure: str, tie: str) -> DataFrame:
    """A10: by the measure, largest first; ties by `tie`."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(tie).asc_nulls_first())


def _by(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def fuel_type_stats(listings: DataFrame) -> DataFrame:
    """A1."""
    counted = (
        listings.filter(F.col("fuel_type").isin(GASOLINE, ELECTRIC))
        .groupBy("fuel_type")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return small_row_id(counted, _by("fuel_type"))


def brand_avg_price(listings: DataFrame, missing: str = "strict") -> DataFrame:
    """A2: zero prices count, missing ones do not; a brand without any price is last."""
    averages = typed_listings(listings, missing=missing).groupBy("brand").agg(F.avg("price").alias("avg_price"))
    return row_id(averages, [F.col("avg_price").desc_nulls_last(), *_by("brand")])


def brand_stats(listings: DataFrame) -> DataFrame:
    """A3."""
    counted = listings.groupBy("brand").agg(F.count(F.lit(1)).alias("count"))
    return row_id(counted, [F.col("count").desc(), *_by("brand")])


def brand_age_price(listings: DataFrame, as_of: AsOf = None, missing: str = "strict") -> DataFrame:
    """A4: average price by brand and exact age."""
    rows = typed_listings(listings, as_of, missing).filter(F.col("reg_date").isNotNull() & positive("price"))
    averages = rows.groupBy("brand", "car_age").agg(F.avg("price").alias("avg_price"))
    return row_id(averages, _by("brand", "car_age"))


QUARTILES = {"q1_price": 0.25, "median_price": 0.5, "q3_price": 0.75}


def brand_transfer_quartiles(
    listings: DataFrame, accuracy: int | None = None, missing: str = "strict"
) -> DataFrame:
    """A5: five-number summary by brand and transfer count; quartiles are prices that occur.

    Exact by default: rows shrink to (brand, transfers, price) counts with a map-side half, and a running count over the
    distinct prices, spread over range partitions, finds the first price at or past each quantile. With `accuracy`, the
    mergeable sketch of percentile_approx is used, whose rank error is at most n / accuracy.
    """
    keys = ["brand", "transfer_count"]
    rows = typed_listings(listings, missing=missing).filter(positive("price") & F.col("transfer_count").isNotNull())
    if accuracy is not None:
        summary = rows.groupBy(*keys).agg(
            F.min("price").alias("min_price"),
            *[F.percentile_approx("price", p, accuracy).alias(n) for n, p in QUARTILES.items()],
            F.max("price").alias("max_price"),
        )
        return row_id(summary, _by(*keys))
    counts = rows.groupBy(*keys, "price").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    running = running_total(counts, keys, ["price"], F.col("n"), "upto").join(totals, keys)
    summary = running.groupBy(*keys).agg(
        F.min("price").alias("min_price"),
        *[
            F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * F.lit(p)), F.col("price"))).alias(n)
            for n, p in QUARTILES.items()
        ],
        F.max("price").alias("max_price"),
    )
    return row_id(summary, _by(*keys))


def brand_mileage_price(listings: DataFrame, missing: str = "strict") -> DataFrame:
    """Average price by brand and mileage."""
    rows = typed_listings(listings, missing=missing).filter(positive("price") & F.col("mileage").isNotNull())
    averages = rows.groupBy("brand", "mileage").agg(F.avg("price").alias("avg_price"))
    return row_id(averages, _by("brand", "mileage"))


def brand_price_drop(listings: DataFrame, missing: str = "strict") -> DataFrame:
    """Average new and current price and the drop between the averages in percent."""
    rows = typed_listings(listings, missing=missing).filter(positive("new_price") & positive("price"))
    averages = rows.groupBy("brand").agg(
        F.avg("new_price").alias("avg_new_price"), F.avg("price").alias("avg_current_price")
    )
    new, current = F.col("avg_new_price"), F.col("avg_current_price")
    drops = averages.withColumn("price_drop_percent", (new - current) / new * 100).filter(
        new.isNotNull() & current.isNotNull() & F.col("price_drop_percent").isNotNull()
    )
    return row_id(drops, _by("brand"))


def brand_mileage_age_days(listings: DataFrame, as_of: AsOf = None, missing: str = "strict") -> DataFrame:
    """Rounded average days on the market by brand, mileage and age.

    An unreadable registration month forms a group without age (first), an unreadable posting date gives no average.
    """
    rows = typed_listings(listings, as_of, missing).filter(
        F.col("reg_time").isNotNull() & F.col("post_time").isNotNull() & F.col("mileage").isNotNull()
    )
    averages = rows.groupBy("brand", F.col("mileage").alias("mileage_float"), "car_age").agg(
        F.round(F.avg("publish_days")).cast("int").alias("avg_publish_days")
    )
    return row_id(averages, _by("brand", "mileage_float", "car_age"))
