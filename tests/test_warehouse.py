"""Files and catalog tables, and the whole pipeline through them."""

import csv

import pytest

from carledger.plans import pipeline
from carledger.schema import CELL_SCHEMA, CLEAN_COLUMNS, RAW_FIELDS, STAT_TABLES
from carledger.session import shared_dir
from carledger.sources import listings, warehouse
from tests.test_clean_and_stats import DEFAULTS, GOLDEN, NAMES, frame


@pytest.fixture()
def raw(spark):
    return frame(spark, [{**DEFAULTS, **dict(zip(NAMES, row))} for row in GOLDEN])


def test_province_from_file_name(spark, tmp_path):
    for province, brand in (("北京", "A"), ("上海", "B")):
        with open(tmp_path / f"lots_site_{province}_v1.csv", "w", encoding="utf-8", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(RAW_FIELDS)
            writer.writerow([brand, *["x"] * (len(RAW_FIELDS) - 1)])
    with open(tmp_path / "merged.csv", "w", encoding="utf-8", newline="") as out:
        csv.writer(out).writerow(RAW_FIELDS)
        csv.writer(out).writerow(["C", *["x"] * (len(RAW_FIELDS) - 1)])
    got = listings.read_listings(spark, str(tmp_path), chinese_names=True)
    assert got.columns == [*RAW_FIELDS.values(), "province"]
    assert sorted((r.brand, r.province or "") for r in got.collect()) == [("A", "北京"), ("B", "上海"), ("C", "")]
    with pytest.raises(ValueError):
        listings.read_listings(spark, str(tmp_path), fmt="xlsx")


def test_partitioned_files(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    listings.write_listings(raw, path)
    back = listings.read_partitioned(spark, path).select(*raw.columns)
    assert back.exceptAll(raw).count() == 0 and back.count() == 10
    assert "PartitionFilters: [isnotnull(province" in back.filter("province = '北京'")._jdf.queryExecution().toString()


def test_pipeline_through_tables(spark, raw, tmp_path):
    loaded = pipeline.load(raw)
    assert loaded.columns == CLEAN_COLUMNS and loaded.count() == 6
    comments = {f.name: f.metadata.get("comment") for f in spark.table(warehouse.LISTING_TABLE).schema}
    assert comments["mileage"] == "表显里程（万公里）"
    pipeline.load(raw)
    assert spark.table(warehouse.LISTING_TABLE).count() == 6
    warehouse.load_listings(frame_clean(spark, loaded), overwrite=False)
    assert spark.table(warehouse.LISTING_TABLE).count() == 12
    pipeline.load(raw)
    assert sorted(pipeline.refresh_statistics(spark, "2025-04-17")) == sorted(STAT_TABLES)
    stored = spark.table("brand_avg_price")
    assert dict(stored.dtypes) == {"id": "int", "brand": "string", "avg_price": "float"}
    assert sorted(map(tuple, stored.collect())) == [(1, "B", 15.0), (2, "A", 10.113333702087402), (3, "C", 0.0)]
    pipeline.refresh_statistics(spark, "2025-04-17")
    assert stored.count() == 3
    path = str(tmp_path / "cells")
    pipeline.publish_statistics(spark, path, ts=1)
    cells = spark.read.schema(CELL_SCHEMA).parquet(path)
    assert {r.tbl for r in cells.collect()} == set(pipeline.PUBLISHED)
    for name in pipeline.PUBLISHED:
        table = spark.table(name)
        assert cells.filter(cells.tbl == name).count() == table.count() * (len(table.columns) - 1)


def frame_clean(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def test_view(spark, raw):
    warehouse.register_view(raw, "raw_view")
    assert spark.sql("SELECT count(*) FROM raw_view").collect()[0][0] == 10


def test_checkpoints_go_to_the_configured_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir", None) in (None, shared_dir(spark))
