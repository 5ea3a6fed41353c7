"""Time joins, windows, sessions, groupings and the stream against plain answers; hot groups, borders, nulls, plan shapes."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carledger.operators import cells as K
from carledger.operators import groupings, timeline
from carledger.streaming import newest


def plan(df):
    return df._jdf.queryExecution().toString()


def keyed(n, seed, keys=(None, "a", "b", "hot", "hot", "hot", "hot")):
    draw = random.Random(seed)
    return [(draw.choice(keys), draw.choice([draw.randint(0, 3 * n), draw.randint(0, 40), None]), i) for i in range(n)]


@pytest.fixture
def many_parts(spark):
    """Small groups, too, lie in several partitions."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join(spark, many_parts, strict):
    left, right = keyed(600, 1), keyed(400, 2) + [("hot", 7, 1000 + i) for i in range(50)]
    a = spark.createDataFrame(left, "k string, at long, id int")
    b = spark.createDataFrame([(k, t, i, f"v{i}", None if i % 3 else "x") for k, t, i in right], "k string, at long, n int, v string, w string")
    found = sorted(timeline.asof_join(a, b, ["k"], "at", ["n"], strict).collect(), key=lambda r: r.id)
    for row, (k, t, i) in zip(found, left, strict=True):
        earlier = [(u, n) for j, u, n in right if j == k and None not in (t, u) and (u < t or (u == t and not strict))]
        n = max(earlier)[1] if earlier else None
        assert tuple(row) == (k, t, i, n, None if n is None else f"v{n}", None if n is None or n % 3 else "x")


def test_asof_join_of_nothing_and_of_clashing_names(spark):
    a, b = spark.createDataFrame([("a", 1)], "k string, at long"), spark.createDataFrame([], "k string, at long, v int")
    assert [tuple(r) for r in timeline.asof_join(a, b, ["k"], "at", ["v"]).collect()] == [("a", 1, None)]
    assert timeline.asof_join(a.limit(0), b, ["k"], "at", ["v"]).collect() == []
    with pytest.raises(ValueError):
        timeline.asof_join(a.withColumn("v", F.lit(1)), b, ["k"], "at", ["v"])


def test_rows_as_of(spark, many_parts):
    cells = [("t", r, "f", q, ts, ts * 10, f"{r}{q}{ts}") for r in ("x", "y") for q in ("p", "q") for ts in range(r == "y", 40, 1 + (q == "q"))]
    cells.append(("t", "x", "f", "p", 5, 999, "later"))
    df = spark.createDataFrame(cells, "tbl string, row_key string, family string, qualifier string, ts long, seq long, value string")
    asked = spark.createDataFrame([("t", "x", 5, 1), ("t", "y", 0, 2), ("t", "y", 100, 3), ("t", "none", 5, 4)], "tbl string, row_key string, at long, id int")
    found = {(r.id, r.qualifier): (r.ts, r.value) for r in K.rows_as_of(df, asked, "at").collect()}
    assert found == {(1, "p"): (5, "later"), (1, "q"): (4, "xq4"), (3, "p"): (39, "yp39"), (3, "q"): (39, "yq39")}


def test_interval_join(spark):
    draw = random.Random(3)
    span = lambda: (a := draw.randint(-500, 500), a + draw.choice([0, 1, 5, 30, 300, 5000, -1]))
    left = [(draw.choice(["a", "hot", "hot", None]), i, *span()) for i in range(150)]
    right = [(draw.choice(["a", "hot", "hot", None]), i, *span()) for i in range(150)]
    right += [("hot", 200, None, 5), ("hot", 201, 3, None)]
    a = spark.createDataFrame(left, "k string, i int, s long, e long")
    b = spark.createDataFrame(right, "k string, j int, s2 long, e2 long")
    found = timeline.interval_join(a, b, ["k"], ("s", "e"), ("s2", "e2"), base=4, levels=4)
    got = sorted((r.i, r.j) for r in found.collect())
    want = sorted(
        (i, j) for k, i, s, e in left for m, j, s2, e2 in right if k == m and k and None not in (s2, e2) and s <= e and s2 <= e2 and s <= e2 and s2 <= e
    )
    assert got == want
    assert "NestedLoop" not in plan(found) and "CartesianProduct" not in plan(found)


def test_long_intervals_are_not_multiplied_by_their_length(spark):
    a = spark.createDataFrame([("k", 1, 0, 10**6)], "k string, i int, s long, e long")
    b = spark.createDataFrame([("k", n, n, n) for n in range(0, 2 * 10**6, 10**5)], "k string, j int, s2 long, e2 long")
    found = timeline.interval_join(a, b, ["k"], ("s", "e"), ("s2", "e2"), base=1)
    assert sorted(r.j for r in found.collect()) == list(range(0, 10**6 + 1, 10**5))


def test_moving_totals(spark, many_parts):
    rows = keyed(800, 4)
    df = spark.createDataFrame([(k, t, i % 50 - 10) for k, t, i in rows], "k string, at long, v long")
    window = Window.partitionBy("k").orderBy("at").rangeBetween(-25, 0)
    want = df.filter("at is not null").select("k", "at", F.count("*").over(window).alias("n"), F.sum("v").over(window).alias("v")).distinct()
    got = timeline.moving_totals(df, ["k"], "at", {"v": F.col("v")}, 25)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_neighbours(spark, many_parts):
    df = spark.createDataFrame([(k, t, i) for k, t, i in keyed(500, 5)], "k string, at long, id int")
    window = Window.partitionBy("k").orderBy("at", "id")
    want = df.select("*", F.lag("id").over(window).alias("p_id"), F.lead("id", 3).over(window).alias("n_id"))
    got = timeline.neighbours(df, ["k"], ["at", "id"], ["id"], {"p_": -1, "n_": 3})
    assert got.exceptAll(want).count() == 0 and got.count() == 500


@pytest.mark.parametrize("gap", [0, 3, 40, 10**6])
def test_sessions(spark, many_parts, gap):
    rows = keyed(700, 6)
    df = spark.createDataFrame([(k, t, i) for k, t, i in rows], "k string, at long, v long")
    got = sorted(map(tuple, timeline.sessions(df, ["k"], "at", gap, {"v": F.col("v")}).collect()), key=str)
    want = []
    for key in {k for k, _, _ in rows}:
        last = None
        for t, i in sorted((t, i) for k, t, i in rows if k == key and t is not None):
            if last is None or t - last[2] > gap:
                last = [key, t, t, 0, 0]
                want.append(last)
            last[2:] = [t, last[3] + 1, last[4] + i]
    assert got == sorted(map(tuple, want), key=str)


def test_no_window_over_a_whole_group(spark):
    """Windows over rows are cut by partition; what is by group alone has a row for each partition."""
    df = spark.createDataFrame(keyed(50, 7), "k string, at long, v int")
    for found in (timeline.sessions(df, ["k"], "at", 3, {}), timeline.asof_join(df, df.withColumnRenamed("v", "w"), ["k"], "at", ["w"])):
        assert "SinglePartition" not in plan(found)


def test_cube_tells_null_values_from_totals(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, "x", 2), ("a", None, 4), ("a", "x", 8)], "p string, q string, v int")
    got = {(r.p, r.q, r.level): r.v for r in groupings.cube_totals(df, ["p", "q"], {"v": F.col("v")}).collect()}
    assert got == {
        (None, "x", 0): 3, ("a", None, 0): 4, ("a", "x", 0): 8, (None, None, 1): 3, ("a", None, 1): 12, (None, "x", 2): 11, (None, None, 2): 4, (None, None, 3): 15,
    }
    steps = plan(groupings.cube_totals(df, ["p", "q"], {"v": F.col("v")})).split("== Physical Plan ==")[1]
    assert steps.index("Expand") < steps.rindex("HashAggregate") and steps.count("Exchange") >= 2  # finest groups before levels


def test_bitmaps_merge(spark):
    draw = random.Random(8)
    rows = [(draw.choice("abc"), draw.choice(["p", "q", None]), draw.choice([None, f"m{draw.randint(0, 40000)}"])) for _ in range(90000)]
    df = spark.createDataFrame(rows, "g string, h string, m string")
    bits = groupings.distinct_bitmaps(df, ["g", "h"], "m")
    fine = {(r.g, r.h): r.n for r in groupings.distinct_counts(bits, ["g", "h"], "n").collect()}
    assert fine == {(g, h): len({m for a, b, m in rows if (a, b) == (g, h)} - {None}) for g, h in {r[:2] for r in rows}}
    assert groupings.distinct_counts(bits, [], "n").first().n == len({m for _, _, m in rows} - {None})
    assert groupings.distinct_counts(groupings.distinct_bitmaps(df.limit(0), ["g"], "m"), [], "n").first().n == 0


def test_difference_counts_copies_and_nulls(spark):
    old = spark.createDataFrame([(1, None)] * 3 + [(2, "a")] + [(3, "b")] * 2, "x int, y string")
    new = spark.createDataFrame([(None, 1)] + [("b", 3)] * 5 + [("c", 4)], "y string, x int")
    got = {(r.x, r.y): (r.added, r.gone, r.kept) for r in groupings.multiset_difference(old, new).collect()}
    assert got == {(1, None): (0, 2, 1), (2, "a"): (0, 1, 0), (3, "b"): (3, 0, 2), (4, "c"): (1, 0, 0)}
    assert groupings.except_all(old, new).exceptAll(old.exceptAll(new.select("x", "y"))).count() == 0
    assert sorted(map(str, groupings.intersect_all(old, new).collect())) == sorted(map(str, old.intersectAll(new.select("x", "y")).collect()))


@pytest.mark.parametrize("cuts", [1, 3])
def test_stream_equals_batch_however_it_is_cut(spark, tmp_path, cuts):
    draw, second = random.Random(9), 1_000_000
    start = int(datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC).timestamp()) * second
    puts = [("t", f"r{draw.randint(0, 5)}", "f", "q", start + draw.randint(0, 400) * second, n, f"v{n}") for n in range(200)]
    schema = "tbl string, row_key string, family string, qualifier string, ts bigint, seq bigint, value string"
    for k in range(cuts):
        spark.createDataFrame(puts[k::cuts] if cuts == 1 else puts[200 * k // cuts : 200 * (k + 1) // cuts], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    changes = newest.run_to_end(stream, str(tmp_path / "out"), str(tmp_path / "state"), 10, 300)
    horizon = max(p[4] for p in puts) - 310 * second
    best = {}
    late = []
    for p in puts:
        if p[1] not in best or p[4:6] >= best[p[1]][4:6]:
            best[p[1]] = p
        else:
            late.append(p)
    key = lambda r: r[5]
    assert sorted(map(tuple, newest.visible(changes, horizon).collect()), key=key) == sorted((p for p in best.values() if p[4] >= horizon), key=key)
    assert sorted(map(tuple, newest.late(changes, horizon).collect()), key=key) == sorted((p for p in late if p[4] >= horizon), key=key)
    # Run again without new input, nothing is added.
    n = changes.count()
    assert newest.run_to_end(stream, str(tmp_path / "out"), str(tmp_path / "state"), 10, 300).count() == n


def test_interval_join_sends_spans_and_bins_only(spark):
    left = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("a"), F.col("id").alias("s"), (F.col("id") * 3).alias("e"))
    right = spark.range(50).select(F.lit(1).alias("k"), F.col("id").alias("b"), F.col("id").alias("x"), F.col("id").alias("y"))
    got = timeline.interval_join(left, right, ["k"], ("s", "e"), ("x", "y"), base=4)
    keys = [line for line in got.hint("merge")._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Project" in line]
    assert not any(name in line for line in keys for name in ("_own", "_first"))
    assert sorted((r.a, r.b) for r in got.collect()) == [(a, b) for a in range(50) for b in range(50) if a <= b <= 3 * a]


def test_arrivals_have_as_many_files_at_any_size(spark):
    from carledger.sources import derived

    path, schema = derived.arrivals(spark, "/root/testdata/sf0.001")
    assert len(spark.read.schema(schema).parquet(path).inputFiles()) == 4 * derived.FILES_A_STEP


def test_stream_state_is_handled_by_rows():
    from unittest.mock import Mock

    from pyspark.sql import Row

    put = Row("ts", "seq", "value")
    cell, handle = newest.NewestCell(), Mock()
    handle.getValueState.return_value.get.return_value = (5000, 1, "a")
    cell.init(handle)
    got = list(cell.handleInputRows(("t", "r", "f", "q"), iter([put(4000, 3, "c"), put(7000, 2, "b")]), None))
    assert [tuple(r) for r in got] == [("t", "r", "f", "q", 4000, 3, "c", "late"), ("t", "r", "f", "q", 7000, 2, "b", "newest")]
    assert got[0].kind == "late"
    handle.deleteTimer.assert_called_once_with(5)
    handle.registerTimer.assert_called_once_with(7)
    handle.getValueState.return_value.update.assert_called_once_with((7000, 2, "b"))
