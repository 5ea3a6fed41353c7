"""Row ids, running totals and checks against plain single-partition answers, hot keys included, and plan shapes."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carledger.operators import cells as K
from carledger.operators import checkput, mutations, rowid, scan, stats
from carledger.operators.rowid import row_id
from carledger.plans.queries import QUERIES
from carledger.operators.scan import next_value, placed, running_count, running_total
from carledger.schema import CELL, CELL_SCHEMA, CLEAN_COLUMNS
from carledger.sources import derived

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_row_id_equals_one_partition_window(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    df = df.unionByName(df.limit(1).select(F.lit(None).cast("string").alias("k"), F.lit(-1).cast("bigint").alias("id")))
    order = [F.col("k").asc_nulls_first(), F.col("id").desc()]
    want = df.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("bigint")).select("n", "k", "id")
    got = row_id(df, order, "n")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_row_id_of_nothing(spark):
    assert row_id(spark.range(0), [F.col("id").asc()], "n").collect() == []


def test_running_totals_of_a_hot_group(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("g"), "id", (F.col("id") * 7 % 13).alias("v")
    )
    ahead = Window.partitionBy("g").orderBy("id")
    later = Window.partitionBy("g").orderBy("id").rowsBetween(1, Window.unboundedFollowing)
    want = df.select(
        "*",
        F.sum("v").over(ahead).alias("total"),
        F.row_number().over(Window.partitionBy("g").orderBy(F.col("id").desc())).cast("bigint").alias("place"),
        F.min(F.when(F.col("v") == 5, F.col("id"))).over(later).alias("next"),
    )
    got = running_total(df, ["g"], ["id"], F.col("v"), "total")
    got = running_count(got, ["g"], ["id"], "place", descending=True)
    got = next_value(got, ["g"], ["id"], F.when(F.col("v") == 5, F.col("id")), "next")
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == 4000


REQUESTS = "tbl string, row_key string, family string, qualifier string, seq bigint, expected string, value string"


def requests(spark, n, cells, values, seed):
    pick = random.Random(seed)
    out = []
    for seq in range(n):
        hot = pick.random() < 0.4
        key = "hot" if hot else f"r{pick.randrange(cells)}"
        expected = pick.choice([None, *values])
        out.append(("t", key, "cf", "q", seq, expected, pick.choice([None, *values] if seq % 11 == 0 else values)))
    return out, spark.createDataFrame(out, REQUESTS)


def replay(rows, base=()):
    state, out = dict(base), []
    for tbl, key, family, qualifier, seq, expected, value in rows:
        ok = state.get(key) == expected
        if ok:
            state[key] = value
        out.append((key, seq, ok))
    return sorted(out), state


@pytest.mark.parametrize("first", [0, -300])
def test_check_and_put_equals_a_replay(spark, first):
    rows, _ = requests(spark, 600, 25, ["a", "b", "c"], seed=first)
    rows = [(*r[:4], r[4] + first, *r[5:]) for r in rows]
    df = spark.createDataFrame(rows, REQUESTS)
    want, state = replay(rows)
    got = checkput.check_and_put(df)
    assert sorted((r.row_key, r.seq, r.applied) for r in got.collect()) == want
    finals = {r.row_key: r.value for r in checkput.final_values(df, got).collect()}
    assert finals == state


def test_check_and_put_on_base_values(spark):
    rows, df = requests(spark, 200, 8, ["a", "b"], seed=3)
    base = spark.createDataFrame([("t", "hot", "cf", "q", 1, "a"), ("t", "r1", "cf", "q", 1, "b")], CELL_SCHEMA)
    want, _ = replay(rows, {"hot": "a", "r1": "b"})
    got = checkput.check_and_put(df, base)
    assert sorted((r.row_key, r.seq, r.applied) for r in got.collect()) == want


def test_many_versions_equal_few(spark):
    cells = spark.range(3000).select(
        F.lit("t").alias("tbl"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("row_key"),
        F.lit("cf").alias("family"),
        F.lit("q").alias("qualifier"),
        F.col("id").alias("ts"),
        F.col("id").cast("string").alias("value"),
    )
    few, many = K.versions(cells, 30), K.versions(cells, 30, spread=True)
    assert "WindowGroupLimit" in plan(few) and "WindowGroupLimit" in plan(K.latest(cells))
    assert many.select(*few.columns).exceptAll(few).count() == 0 and many.count() == few.count()
    assert K.versions(cells.withColumn("ts", F.lit(7)), 30, spread=True).filter("row_key = 'hot'").count() == 30


def test_hot_group_of_equal_values_is_spread(spark):
    df = spark.range(4000).select(F.lit("hot").alias("g"), F.lit(1).alias("o"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = placed(df, ["g"], ["o"]).groupBy("_part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(parts) > 1 and max(r["count"] for r in parts) < 2000


def test_hot_cell_appends_keep_their_order(spark):
    appends = spark.range(500).select(
        *[F.lit("x").alias(c) for c in CELL],
        (F.col("id") * 7919 % 500 * 9000).alias("seq"),
        (F.col("id") * 7919 % 500).cast("string").alias("value"),
    )
    got = mutations.append_values(appends.repartition(4)).collect()
    assert [r.value for r in got] == ["".join(map(str, range(500)))]


# These walk markup or a log in Arrow batches.
# Pages are walked, references of links decoded, logs replayed and stream states kept in Python workers.
NOT_NATIVE = {n for n in QUERIES if n[0] == "e"} | {"k8_replay", "t5_stream_newest", "t5_stream_late"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NOT_NATIVE))
def test_no_python_and_no_cross_join(spark, monkeypatch, name):
    if name != "k20_check_and_put":  # its rounds need their checkpoints
        for module in (rowid, scan):  # look below checkpoints
            monkeypatch.setattr(module, "cut_lineage", lambda df: df)
    text = plan(QUERIES[name](spark, SF_DIR))
    for node in ("PythonUDF", "MapInPandas", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in text
    # The only data in one partition: sizes of partitions, or rows whose number the query fixes.
    if name not in ("a1_fuel_type_stats", "c14_stage_counts", "k2_publish_tables", "i2_frequent_pairs", "g2_distinct_models") and "SinglePartition" in text:
        assert "_part" in text


def test_casts_are_stored_and_filters_reach_the_files(spark):
    text = plan(stats.typed_listings(derived.typed_listings(spark, SF_DIR)).filter("price > 0"))
    assert "GreaterThan(price,0" in text
    text = plan(QUERIES["c13_clean_full"](spark, SF_DIR))
    assert "EqualTo(fuel_type,电动)" in text


def test_statistics_read_only_their_columns(spark):
    text = plan(QUERIES["c16_valid_rows"](spark, SF_DIR))
    read = text[text.rindex("ReadSchema") :].split("\n")[0]
    assert "new_price" in read and "reg_date" not in read and "post_time" not in read


def test_fuel_filter_reaches_the_files(spark, tmp_path):
    text = plan(stats.fuel_type_stats(derived.clean_listings(spark, SF_DIR)))
    assert "In(fuel_type, [汽油,电动])" in text or "PushedFilters: [In(fuel_type" in text


def test_key_range_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "cells")
    cells = spark.range(1000).select(
        F.lit("t").alias("tbl"),
        F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("row_key"),
        F.lit("cf").alias("family"),
        F.lit("q").alias("qualifier"),
        F.lit(1).cast("bigint").alias("ts"),
        F.col("id").cast("string").alias("value"),
    )
    K.write_cells(cells, path)
    stored = spark.read.parquet(path).filter("tbl = 't'")
    found = K.scan(stored, "k0010", "k0020")
    text = plan(found)
    assert "GreaterThanOrEqual(row_key,k0010)" in text and "LessThan(row_key,k0020)" in text
    assert "PartitionFilters: [isnotnull(tbl" in text
    assert [r.row_key for r in found.collect()] == [f"k{i:04d}" for i in range(10, 20)]


def test_tasks_are_bounded_by_bytes(spark):
    from carledger.session import BOUNDS, TASK_BYTES, configure

    before = {name: spark.conf.get(name) for name in BOUNDS}
    try:
        for given, want in (("128m", str(TASK_BYTES)), ("1m", "1m")):
            for name in BOUNDS:
                spark.conf.set(name, given)
            configure(spark)
            assert [spark.conf.get(name) for name in BOUNDS] == [want] * len(BOUNDS)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_the_clean_layer_is_stored_without_a_sort(spark):
    rows = derived.clean_listings(spark, SF_DIR)
    assert not any("province=" in f for f in rows.inputFiles())
    assert rows.columns == CLEAN_COLUMNS


def test_a_layer_by_folders_is_stored_without_a_sort(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    rows = spark.range(3000).select("id", F.when(F.col("id") % 40 > 0, F.col("id") % 40).cast("string").alias("folder"))
    rows.createOrReplaceTempView("by_folder")
    spark.sql("CREATE TABLE stored_by_folder (id bigint, folder string) USING parquet PARTITIONED BY (folder)")
    try:
        insert = "EXPLAIN INSERT INTO stored_by_folder SELECT * FROM by_folder"
        assert "Sort [folder" in spark.sql(insert).collect()[0][0]
        with derived._open_files(spark, derived.OPEN_FILES):
            assert "Sort [folder" not in spark.sql(insert).collect()[0][0]
    finally:
        spark.sql("DROP TABLE stored_by_folder")
    got = derived.stored(spark, "here", "by_folder", lambda: rows, by="folder")  # more folders than open files, and null
    assert got.exceptAll(rows).count() == 0 and got.count() == 3000 and spark.conf.get(name, None) == before


def test_parts_are_joined_last(spark):
    text = derived.keyed_listings(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.split("\n") if "Join Inner" in line]
    assert "p_partkey" in joins[0] and len(joins) == 3
