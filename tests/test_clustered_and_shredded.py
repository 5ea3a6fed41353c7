"""Cells stored in buckets are not moved by reads by key; nested values and what doesn't fit."""

from pyspark.sql import functions as F

from carledger.operators import clustered, shredded
from carledger.schema import CELL_SCHEMA


def test_reads_by_key_move_keys_only(spark, tmp_path):
    cells = spark.createDataFrame([("t", f"r{i % 50}", "f", f"q{i}", i, str(i)) for i in range(500)], CELL_SCHEMA)
    clustered.write_clustered(cells, "clustered_a", str(tmp_path / "clustered_a"), 4)
    keys = spark.createDataFrame([("t", "r1"), ("t", "r1"), ("t", "r7"), ("t", "none"), (None, None)], "tbl string, row_key string")
    found = clustered.multi_get(spark, "clustered_a", keys)
    assert sorted({r.row_key for r in found.collect()}) == ["r1", "r7"] and found.count() == 20
    steps = found._jdf.queryExecution().executedPlan().toString()
    assert "clustered_a" in steps and "SortMergeJoin" in steps
    scan = steps[: steps.index("clustered_a")].splitlines()
    indent = len(scan[-1]) - len(scan[-1].lstrip(" +-:"))
    assert not [line for line in scan if "Exchange" in line and len(line) - len(line.lstrip(" +-:")) < indent]


def test_shredding(spark):
    texts = ['{"a": 1, "b": {"c": ["x", 2]}}', '{"a": "1"}', '{"a": "one", "b": 3}', "{", "", None, '{"a": null}', "[1]", '{"b": {"c": [7]}}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string")
    found = shredded.shredded(df, "body", {"a": ("$.a", "int"), "c": ("$.b.c[0]", "string")})
    got = {r.id: (r.a, r.c, r.reason) for r in found.collect()}
    assert got == {
        0: (1, "x", None), 1: (1, None, None), 2: (None, None, "a"), 3: (None, None, "no json"), 4: (None, None, "no json"),
        5: (None, None, None), 6: (None, None, None), 7: (None, None, None), 8: (None, "7", None),
    }
    assert shredded.accepted(found).count() + shredded.rejected(found).count() == len(texts)
    assert shredded.accepted(found).columns == ["id", "a", "c"]
    assert shredded.shredded(df.limit(0), "body", {"a": ("$.a", "int")}).filter(F.col("a") > 0).count() == 0
