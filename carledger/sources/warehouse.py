"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carledger.schema import CLEAN_COLUMNS, CLEAN_COMMENTS, STAT_TABLES

LISTING_TABLE = "car_data"
TYPED_TABLE = "car_data_typed"


def register_view(df: DataFrame, name: str) -> None:
    """S2."""
    df.createOrReplaceTempView(name)


def _create(
    spark: SparkSession, name: str, columns: list[tuple[str, str, str]], partition_by: str | None = None, location: str | None = None
) -> None:
    body = ", ".join(f"`{c}` {t}" + (f" COMMENT '{note}'" if note else "") for c, t, note in columns)
    layout = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING PARQUET{layout}{place}")


def create_listing_table(spark: SparkSession, name: str = LISTING_TABLE, location: str | None = None) -> None:
    """S3: the 21 text columns, commented, one partition for each province (the last column)."""
    _create(spark, name, [(c, "STRING", note) for c, note in CLEAN_COMMENTS.items()], "province", location)


def replace_typed(typed: DataFrame, name: str = TYPED_TABLE) -> None:
    """The typed layer of the listings, replaced as a whole."""
    typed.write.mode("overwrite").format("parquet").saveAsTable(name)


def create_stat_table(spark: SparkSession, name: str) -> None:
    """S3: one of the eight statistics tables."""
    _create(spark, name, STAT_TABLES[name])


def load_listings(df: DataFrame, name: str = LISTING_TABLE, overwrite: bool = True) -> None:
    """By position, with the columns spelled out. Overwrites unless asked to append, so a rerun adds no copies."""
    df.select(*CLEAN_COLUMNS).hint("rebalance", "province").write.insertInto(name, overwrite=overwrite)


def store_cast(df: DataFrame, name: str) -> DataFrame:
    """The result as the stored table has it: bigint ids and counts to INT (overflow is an error), double to FLOAT."""
    return df.select(*[F.col(c).cast(t.lower()).alias(c) for c, t, _ in STAT_TABLES[name]])


def replace_stat(df: DataFrame, name: str) -> None:
    """Replace the table's contents."""
    spark = df.sparkSession
    create_stat_table(spark, name)
    store_cast(df, name).write.insertInto(name, overwrite=True)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S6."""
    return spark.table(name)
