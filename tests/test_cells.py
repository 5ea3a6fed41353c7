"""Cell tables: the examples of the fixture list and the edges of each read."""

import random

import pytest
from pyspark.sql import functions as F

from carledger.operators import cells as K
from carledger.operators import mutations as M
from carledger.schema import CELL, CELL_SCHEMA, MUTATION_SCHEMA


def cells_of(spark, rows):
    return spark.createDataFrame([("t", k, "cf", q, ts, v) for k, q, ts, v in rows], CELL_SCHEMA)


def log_of(spark, rows):
    """(row, qualifier, ts, op, value), numbered in order."""
    return spark.createDataFrame(
        [("t", k, "cf", q, ts, seq, op, v) for seq, (k, q, ts, op, v) in enumerate(rows)], MUTATION_SCHEMA
    )


def short(df):
    return sorted((r.row_key, r.qualifier, r.ts, r.value) for r in df.collect())


def test_to_cells(spark):
    df = spark.createDataFrame([(1, "A", 12.34), (None, "A", None)], "id int, brand string, avg_price float")
    assert short(K.to_cells(df, "brand_avg_price", ts=7)) == [
        ("1", "avg_price", 7, "12.34000015258789"),
        ("1", "brand", 7, "A"),
        ("unknown_key", "avg_price", 7, "None"),
        ("unknown_key", "brand", 7, "A"),
    ]


def test_number_texts_equal_python(spark):
    values = [0.0, -0.0, 1.0, 1e-3, 1e-4, 9.99e-4, 1e-5, -2.5e-7, 1e7, 12345678.0, 1.5e15, 1e16, 1e22, -3.25e100]
    values += [float("inf"), float("-inf"), float("nan"), 123456.789, 99999999.5, 0.1]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    got = {int(r.row_key): r.value for r in K.to_cells(df, "t", ts=0).collect()}
    assert [got[i] for i in range(len(values))] == [str(v) for v in values]


def test_publish_chosen(spark):
    a = spark.createDataFrame([(1, "x")], "id int, brand string")
    both = K.publish({"one": a, "two": a}, ts=0)
    assert sorted(r.tbl for r in both.collect()) == ["one", "two"]
    assert [r.tbl for r in K.publish({"one": a, "two": a}, ["two"], ts=0).collect()] == ["two"]


def test_put_and_get(spark):
    wide = spark.createDataFrame([("row1", "value1", "value2", 5)], "k string, a string, b string, n bigint")
    puts = M.put_rows(wide, "t", "k", {"cf1:column1": "a", "cf1:column2": "b"}, ts="n", seq="n")
    got = K.get_rows(M.latest_visible(puts), ["row1"])
    assert short(got) == [("row1", "column1", 5, "value1"), ("row1", "column2", 5, "value2")]
    assert K.get_rows(got, ["row2"]).collect() == []


def test_delete_with_equal_timestamp_wins(spark):
    log = log_of(spark, [("a", "q", 5, "put", "x"), ("a", "q", 5, "delete_cell", None), ("a", "q", 6, "put", "y")])
    assert short(M.visible(log)) == [("a", "q", 6, "y")]
    assert short(M.latest_visible(log)) == [("a", "q", 6, "y")]


def test_row_delete_hides_older_cells_only(spark):
    log = log_of(
        spark,
        [
            ("a", "p", 1, "put", "x"),
            ("a", "q", 9, "put", "y"),
            ("a", None, 5, "delete_row", None),
            ("b", "p", 1, "put", "z"),
            ("c", "p", 1, "delete_cell", None),
        ],
    )
    assert short(M.visible(log)) == [("a", "q", 9, "y"), ("b", "p", 1, "z")]
    assert short(M.latest_visible(log)) == [("a", "q", 9, "y"), ("b", "p", 1, "z")]


def test_batches(spark):
    batches = spark.createDataFrame(
        [
            ("t", "a", 1, 0, [(False, "cf:p", "x"), (False, "cf:q", "y")]),
            ("t", "a", 2, 1, [(True, "cf:p", None)]),
            ("t", "b", 1, 2, [(False, "cf:p", "z")]),
            ("t", "b", 3, 3, [(True, None, None)]),
        ],
        "tbl string, row_key string, ts bigint, seq bigint, "
        "mutations array<struct<is_delete: boolean, column: string, value: string>>",
    )
    log = M.expand_batches(batches)
    assert log.columns == MUTATION_SCHEMA.names
    assert short(M.latest_visible(log)) == [("a", "q", 1, "y")]


def test_versions(spark):
    five = cells_of(spark, [("a", "q", ts, str(ts)) for ts in range(1, 6)])
    assert [r.ts for r in K.versions(five, 3, 4).orderBy(F.col("ts").desc()).collect()] == [4, 3, 2]
    assert short(K.versions(five, 1)) == short(K.latest(five)) == [("a", "q", 5, "5")]


def test_retention(spark):
    five = cells_of(spark, [("a", "q", ts * 1000, str(ts)) for ts in range(1, 6)])
    assert sorted(r.ts for r in K.retain(five).collect()) == [3000, 4000, 5000]
    assert sorted(r.ts for r in K.retain(five, 9, time_to_live=2, now=5000).collect()) == [3000, 4000, 5000]
    assert sorted(r.ts for r in K.retain(five, 2, time_to_live=2, now=5000).collect()) == [4000, 5000]


def test_range_scan_leaves_the_stop_row_out(spark):
    abc = cells_of(spark, [(k, "q", 1, k) for k in "cab"])
    keys = lambda df: [r.row_key for r in df.collect()]
    assert keys(K.scan(abc, "a", "c")) == ["a", "b"]
    assert keys(K.scan(abc)) == ["a", "b", "c"]
    assert keys(K.scan(abc, "b")) == ["b", "c"]
    assert keys(K.scan(abc, "", "b")) == ["a"]
    assert keys(K.scan(abc, "b", reverse=True)) == ["b", "a"]
    assert keys(K.scan(abc, "c", "a", reverse=True)) == ["c", "b"]


def test_prefix_and_columns(spark):
    some = cells_of(spark, [("ab", "x1", 1, "1"), ("ab", "y", 1, "2"), ("b", "x2", 1, "3"), ("a%", "x3", 2, "4")])
    assert {r.row_key for r in K.scan(some, prefix="a").collect()} == {"ab", "a%"}
    assert {r.row_key for r in K.scan(some, prefix="a%").collect()} == {"a%"}
    assert {r.qualifier for r in K.scan(some, columns=["cf:x.*"]).collect()} == {"x1", "x2", "x3"}
    assert {r.qualifier for r in K.scan(some, columns=["cf:y", "cf:x1"]).collect()} == {"y", "x1"}
    assert K.scan(some, columns=["other"]).count() == 0 and K.scan(some, columns=["cf"]).count() == 4
    assert K.scan(some, columns=[]).count() == 0
    assert {r.value for r in K.scan(some, ts=2).collect()} == {"4"}
    assert {r.value for r in K.scan(some, predicate="value > '2'").collect()} == {"3", "4"}


def test_reads_at_a_timestamp(spark):
    three = cells_of(spark, [("a", "q", ts, str(ts)) for ts in (1, 3, 5)])
    keys = spark.createDataFrame([("a",), ("z",)], "row_key string")
    assert short(K.get_rows(three, keys, ts=3)) == [("a", "q", 3, "3")]
    assert short(K.get_rows(three, keys, ts=4)) == []
    assert short(K.get_rows(three, ["a"], ts=4, mode="as_of")) == [("a", "q", 3, "3")]
    assert short(K.get_rows(three, keys, ["cf:other"])) == []
    with pytest.raises(ValueError):
        K.get_rows(three, keys, ts=1, mode="near")


def test_first_rows_counts_keys_not_cells(spark):
    some = cells_of(spark, [(k, q, 1, "v") for k in "dbca" for q in "xyz"])
    assert sorted({r.row_key for r in K.first_rows(some, 2).collect()}) == ["a", "b"]
    assert K.first_rows(some, 2).count() == 6
    assert {r.row_key for r in K.first_rows(some, 1, start="b").collect()} == {"b"}
    assert {r.row_key for r in K.first_rows(some, 2, reverse=True).collect()} == {"c", "d"}
    assert K.first_rows(some, 0).count() == 0


def test_row_results(spark):
    some = K.latest(cells_of(spark, [("a", "y", 2, "2"), ("a", "x", 1, "1"), ("a", "x", 0, "0")]))
    assert K.row_maps(some).collect()[0].columns == {"cf:x": ("1", 1), "cf:y": ("2", 2)}
    assert [tuple(c.column for c in r.columns) for r in K.row_lists(some).collect()] == [("cf:x", "cf:y")]


def test_wide_rows_come_in_parts(spark):
    cells = [("wide", f"q{i:03d}", 1, str(i)) for i in range(100)] + [("narrow", "q", 1, "x")]
    parts = K.row_lists(cells_of(spark, cells), max_columns=10).collect()
    assert [len(r.columns) for r in parts if r.row_key == "narrow"] == [1]
    wide = [r.columns for r in parts if r.row_key == "wide"]
    assert len(wide) > 5 and sorted(c.column for p in wide for c in p) == [f"cf:q{i:03d}" for i in range(100)]
    assert sum(len(r.columns) for r in K.row_maps(cells_of(spark, cells), 10).collect()) == 101


def test_increments(spark):
    steps = spark.createDataFrame(
        [("t", "a", "cf", "n", 1, 5), ("t", "a", "cf", "n", 2, -2), ("t", "b", "cf", "n", 3, 1)],
        "tbl string, row_key string, family string, qualifier string, seq bigint, amount bigint",
    )
    base = cells_of(spark, [("a", "n", 1, "10")])
    assert [(r.row_key, r.value) for r in M.increment_steps(steps, base).orderBy("seq").collect()] == [
        ("a", 15),
        ("a", 13),
        ("b", 1),
    ]
    assert sorted((r.row_key, r.value) for r in M.increment_totals(steps, base).collect()) == [("a", 13), ("b", 1)]


def test_appends(spark):
    asked = spark.createDataFrame(
        [("t", "a", 2, ["cf:p", "cf:q"], ["c", "d"]), ("t", "a", 1, ["cf:p"], ["b"])],
        "tbl string, row_key string, seq bigint, columns array<string>, values array<string>",
    )
    got = M.append_values(M.expand_appends(asked), cells_of(spark, [("a", "p", 0, "a")]))
    assert sorted((r.qualifier, r.value) for r in got.collect()) == [("p", "abc"), ("q", "d")]


def test_catalogue_and_truncate(spark, tmp_path):
    path = str(tmp_path / "cells")
    some = cells_of(spark, [("a", "q", 1, "1"), ("b", "q", 1, "2")])
    K.write_cells(some.unionByName(some.withColumn("tbl", F.lit("u"))), path)
    read = lambda: spark.read.schema(CELL_SCHEMA).parquet(path)
    assert sorted(r.tbl for r in K.tables(read()).collect()) == ["t", "u"]
    assert sorted(map(tuple, K.families(read()).collect())) == [("t", "cf"), ("u", "cf")]
    keys = spark.createDataFrame([("t", "a"), ("t", "x")], "tbl string, row_key string")
    assert sorted((r.row_key, r.row_exists) for r in K.rows_exist(read(), keys).collect()) == [("a", True), ("x", False)]
    K.truncate(spark, path, "u")
    spark.catalog.refreshByPath(path)
    assert [r.tbl for r in read().collect()] == ["t", "t"]


def test_upload_reports_failed_puts(spark, tmp_path):
    folder = str(tmp_path)

    def put(tbl, row_key, columns):
        if row_key == "b":
            raise OSError("refused")
        with open(f"{folder}/{tbl}-{row_key}", "w") as out:
            out.write(repr(sorted(columns.items())))

    some = cells_of(spark, [("a", "x", 1, "1"), ("a", "y", 1, "2"), ("b", "x", 1, "3")])
    assert [tuple(r) for r in K.upload(some, put).collect()] == [("t", "b", "OSError: refused")]
    with open(f"{folder}/t-a") as sent:
        assert sent.read() == "[('cf:x', '1'), ('cf:y', '2')]"


def test_cell_columns():
    assert CELL == CELL_SCHEMA.names[:4]


def test_a_row_of_any_width_is_one_result(spark):
    wide = spark.range(10_001).select(
        *[F.lit(c).alias(c) for c in ("tbl", "row_key", "family")],
        F.col("id").cast("string").alias("qualifier"),
        F.lit(1).cast("bigint").alias("ts"),
        F.lit("v").alias("value"),
    )
    assert [len(r.columns) for r in K.row_maps(wide).collect()] == [10_001]
    assert [len(r.columns) for r in K.row_lists(wide).collect()] == [10_001]
    assert len({r.part for r in K.row_maps(wide, 5_000).collect()}) > 1


def test_the_first_colon_separates(spark):
    wide = spark.createDataFrame([("r", "1", "2", 5)], "k string, a string, b string, n bigint")
    puts = M.put_rows(wide, "t", "k", {"cf:a:b": "a", "cf:x:b": "b"}, ts="n", seq="n")
    assert short(M.latest_visible(puts)) == [("r", "a:b", 5, "1"), ("r", "x:b", 5, "2")]
    assert short(K.get_rows(M.latest_visible(puts), ["r"], ["cf:a:b"])) == [("r", "a:b", 5, "1")]
    with pytest.raises(ValueError, match="without a qualifier"):
        M.put_rows(wide, "t", "k", {"cf": "a"}, ts="n", seq="n")


def test_family_deletes(spark):
    batches = spark.createDataFrame(
        [
            ("t", "a", 1, 1, [(False, "cf:x", "1"), (False, "cf:y:z", "2"), (False, "other:x", "3"), (False, "cf", "4")]),
            ("t", "a", 2, 2, [(True, "cf", None)]),
            ("t", "a", 3, 3, [(False, "cf:x", "5")]),
        ],
        "tbl string, row_key string, ts bigint, seq bigint, mutations array<struct<is_delete: boolean, column: string, value: string>>",
    )
    log = M.expand_batches(batches)
    want = [("a", "x", 1, "3"), ("a", "x", 3, "5")]
    assert short(M.latest_visible(log)) == want and short(M.visible(log)) == want
    assert [(r.column, r.reason) for r in M.rejected_entries(batches).collect()] == [("cf", M.NO_QUALIFIER)]


def test_truncate_of_a_table_in_a_namespace(spark, tmp_path):
    path = str(tmp_path / "cells")
    some = cells_of(spark, [("a", "q", 1, "1")])
    K.write_cells(some.unionByName(some.withColumn("tbl", F.lit("ns:t"))), path)
    K.truncate(spark, path, "ns:t")
    spark.catalog.refreshByPath(path)
    assert [r.tbl for r in spark.read.schema(CELL_SCHEMA).parquet(path).collect()] == ["t"]
    with pytest.raises(ValueError, match="no table"):
        K.truncate(spark, path, "ns:t")


def test_upload_sends_once(spark, tmp_path):
    log = str(tmp_path / "sent")

    def put(tbl, row_key, columns):
        with open(log, "a") as out:
            out.write(f"{row_key} {columns['cf:x']}\n")

    rejects = K.upload(cells_of(spark, [("a", "x", 1, "old"), ("a", "x", 2, "new")]), put)
    assert rejects.count() == 0 and rejects.collect() == []
    with open(log) as sent:
        assert sent.read() == "a new\n"


def test_first_rows_of_each_table(spark):
    some = cells_of(spark, [(k, "x", 1, k) for k in "abc"])
    both = some.unionByName(some.withColumn("tbl", F.lit("u")))
    assert sorted((r.tbl, r.row_key) for r in K.first_rows(both, 2).collect()) == [("t", "a"), ("t", "b"), ("u", "a"), ("u", "b")]
    assert sorted((r.tbl, r.row_key) for r in K.first_rows(both, 1, start="b", tbl="u").collect()) == [("u", "b")]
    assert [(r.tbl, r.row_key) for r in K.scan(both, "b", "c", tbl="u").collect()] == [("u", "b")]
    assert [r.tbl for r in K.get_rows(both, ["a"], tbl="u").collect()] == ["u"]


def test_increment_of_a_text_gives_nothing(spark):
    steps = spark.createDataFrame(
        [("t", "a", "cf", "n", 1, 5)], "tbl string, row_key string, family string, qualifier string, seq bigint, amount bigint"
    )
    base = cells_of(spark, [("a", "n", 1, "abc")])
    assert [r.value for r in M.increment_steps(steps, base).collect()] == [None]
    assert [r.value for r in M.increment_totals(steps, base).collect()] == [None]


def test_replay_of_a_mixed_log(spark):
    ops = [
        ("n", "put", "5", None, None),
        ("n", "increment", "3", None, None),
        ("n", "append", "x", None, None),
        ("n", "increment", "1", None, None),  # 8x is no number
        ("m", "cas", "done", "8x", "n"),  # checks n, puts m
        ("m", "cas", "again", "8", "n"),
        ("m", "cas", "final", "done", None),
        ("n", "delete_cell", None, None, None),
        ("n", "increment", "2", None, None),
        (None, "delete_family", None, None, None),
        ("n", "append", "y", None, None),
        ("n", "what", None, None, None),
    ]
    rows = [("t", "r", "cf", q, seq, op, v, e, None if c is None else "cf", c) for seq, (q, op, v, e, c) in enumerate(ops)]
    kinds = "tbl string, row_key string, family string, qualifier string, seq bigint, op string, value string, expected string"
    log = spark.createDataFrame(rows, f"{kinds}, check_family string, check_qualifier string")
    got = [(r.applied, r.value) for r in M.replay(log.repartition(3)).orderBy("seq").collect()]
    assert got == [
        (True, "5"), (True, "8"), (True, "8x"), (False, "8x"), (True, "done"), (False, "done"), (True, "final"),
        (True, None), (True, "2"), (True, None), (True, "y"), (False, "y"),
    ]


def test_replay_splits_rows_but_those_with_checks_elsewhere(spark):
    draw = random.Random(3)
    kinds = ["put", "put", "increment", "append", "cas", "delete_cell", "delete_family", "delete_row", "nonsense"]
    rows = []
    for seq in range(3000):
        key, op = draw.choice(["hot", "hot", "hot", "a", "tied"]), draw.choice(kinds if draw.random() < 0.3 else kinds[:5])
        fam, qual = draw.choice("fg"), draw.choice("pqrstuvw")
        fam, qual = (None if op == "delete_row" else fam), (None if op.startswith("delete_") and op != "delete_cell" else qual)
        check = (draw.choice("fg"), draw.choice("pqrs")) if op == "cas" and key == "tied" and draw.random() < 0.5 else (None, None)
        value = None if op.startswith("delete") else draw.choice(["1", "2", "x"])
        rows.append(("t", key, fam, qual, seq, seq, op, value, draw.choice([None, "1", "x"]) if op == "cas" else None, *check))
    schema = "tbl string, row_key string, family string, qualifier string, ts long, seq long, op string, value string, expected string, check_family string, check_qualifier string"
    log = spark.createDataFrame(rows, schema).repartition(5)
    found = M.replay(log)
    whole = M._streamed(log, ["tbl", "row_key"])  # every row in order as a whole
    assert found.exceptAll(whole).count() == 0 and found.count() == 3000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = {k: M.replay(log).filter(F.col("row_key") == k).select(F.spark_partition_id().alias("p")).distinct().count() for k in ("hot", "tied")}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks["hot"] > 1 and tasks["tied"] == 1
