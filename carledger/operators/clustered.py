"""K7 and K12 over cells that are stored in key order by bucket: reads by key don't move the cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carledger.schema import CELL, ROW


def write_clustered(cells: DataFrame, name: str, path: str, buckets: int) -> None:
    """Stores cells as the catalog table `name`, every row key in one of `buckets` buckets, sorted by cell and time. The cells
    are dealt out by bucket before, so a bucket is one file."""
    order = [*CELL, "ts"]
    (
        cells.repartition(buckets, *ROW)
        .write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *ROW)
        .sortBy(*order)
        .saveAsTable(name)
    )


def multi_get(spark: SparkSession, name: str, keys: DataFrame) -> DataFrame:
    """K7: the cells of the given rows (tbl, row_key; repeated ones count once). Only the keys are dealt out, to the buckets of
    the table; the cells are read where they lie."""
    return spark.table(name).join(keys.select(*ROW).distinct().hint("merge"), ROW, "left_semi")

