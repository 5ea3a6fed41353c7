"""The whole pipeline: pages or raw listings -> clean table -> eight statistics -> cells. One write ends each layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carledger.functions.typed import AsOf
from carledger.operators import cells, clean, extract, stats
from carledger.session import cut_lineage
from carledger.sources import warehouse

# The statistics that are published as cells unless others are asked for.
PUBLISHED = [
    "car_brand_mileage_price_avg",
    "car_brand_price_stats",
    "car_brand_transfer_price_stats",
    "fuel_type_stats",
]


def statistics(
    listings: DataFrame, as_of: AsOf = None, missing: str = "strict"
) -> dict[str, Callable[[], DataFrame]]:
    """The eight statistics by table name, each made on call (their row ids run a job)."""
    return {
        "fuel_type_stats": lambda: stats.fuel_type_stats(listings),
        "brand_avg_price": lambda: stats.brand_avg_price(listings, missing),
        "brand_stats": lambda: stats.brand_stats(listings),
        "car_brand_age_price_avg": lambda: stats.brand_age_price(listings, as_of, missing),
        "car_brand_transfer_price_stats": lambda: stats.brand_transfer_quartiles(listings, missing=missing),
        "car_brand_mileage_price_avg": lambda: stats.brand_mileage_price(listings, missing),
        "car_brand_price_stats": lambda: stats.brand_price_drop(listings, missing),
        "brand_mileage_age_publish_stats": lambda: stats.brand_mileage_age_days(listings, as_of, missing),
    }


def extract_and_split(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages -> (raw listings, rejects). Pages are walked once: their parts are checkpointed, and both read them."""
    parts = cut_lineage(extract.page_parts(pages))
    return extract.listings(parts), extract.rejects(parts)


def load(raw: DataFrame, missing: str = "strict") -> DataFrame:
    """Raw listings with a province -> the stored clean table, and beside it the typed layer the statistics read."""
    spark = raw.sparkSession
    warehouse.create_listing_table(spark)
    warehouse.load_listings(clean.clean(raw, missing))
    listings = warehouse.read_table(spark, warehouse.LISTING_TABLE)
    warehouse.replace_typed(stats.typed_layer(listings, missing))
    return listings


def refresh_statistics(spark: SparkSession, as_of: AsOf = None, missing: str = "strict") -> list[str]:
    """Recompute and replace the eight stored tables."""
    listings = warehouse.read_table(spark, warehouse.TYPED_TABLE)
    made = statistics(listings, as_of, missing)
    for name, make in made.items():
        warehouse.replace_stat(make(), name)
    return list(made)


def publish_statistics(spark: SparkSession, path: str, chosen: list[str] | None = None, **options) -> None:
    """Stored statistics -> a cell folder."""
    names = PUBLISHED if chosen is None else chosen
    cells.write_cells(cells.publish({n: warehouse.read_table(spark, n) for n in names}, **options), path)
