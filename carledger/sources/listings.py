"""Listing files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carledger.schema import RAW_FIELDS, RAW_SCHEMA

_READERS = ("csv", "json", "parquet", "orc")


def read_listings(
    spark: SparkSession, path: str, fmt: str = "csv", chinese_names: bool = False, **options: str
) -> DataFrame:
    """All files of a folder in one scan; the province is the third `_` token of the file name.

    A file without a third token gives a null province. The schema is fixed, never inferred.
    """
    if fmt not in _READERS:
        raise ValueError(f"fmt must be one of {_READERS}")
    names = list(RAW_FIELDS) if chinese_names else list(RAW_FIELDS.values())
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if fmt == "csv":
        options = {"header": "true", "enforceSchema": "false", **options}
    files = spark.read.schema(schema).options(**options).format(fmt).load(path)
    tokens = F.split(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""), "_")
    return files.select(
        *[F.col(n).alias(RAW_FIELDS.get(n, n)) for n in names], F.get(tokens, F.lit(2)).alias("province")
    )


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """A folder with a `province=` directory for each province; a filter on it reads only its directories."""
    named = schema if "province" in schema.names else T.StructType([*schema.fields, T.StructField("province", T.StringType())])
    return spark.read.schema(named).parquet(path)


def write_listings(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """From the executors, by province. The rebalance gathers a province's rows into few files and splits a
    province that holds much of the data over many tasks."""
    df.hint("rebalance", "province").write.mode(mode).partitionBy("province").format(fmt).save(path)


def rename_chinese(df: DataFrame) -> DataFrame:
    """Page field names to the names used here."""
    return df.withColumnsRenamed(RAW_FIELDS)
