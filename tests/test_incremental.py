"""States merged in any way, and frequent items, against plain answers."""

import random

import pytest
from pyspark.sql import functions as F

from carledger.operators import incremental, stats

SCHEMA = "brand string, transfer_count int, fuel_type string, price float, new_price float"


def listings(n, seed):
    draw = random.Random(seed)
    price = lambda: draw.choice([None, 0.0, *[round(draw.uniform(1, 90), 2) for _ in range(6)]])
    return [(draw.choice(["hot", "hot", "b", None]), draw.choice([0, 1, None]), draw.choice(["x", None]), price(), price()) for _ in range(n)]


def test_merged_states_equal_the_state_of_all(spark, tmp_path):
    rows = listings(3000, 1)
    whole = incremental.state(spark.createDataFrame(rows, SCHEMA)).drop("prices")
    parts = [spark.createDataFrame(rows[a:b], SCHEMA) for a, b in ((0, 10), (10, 1900), (1900, 3000))]
    one = incremental.merged(*[incremental.state(p) for p in parts]).drop("prices")
    incremental.state(parts[2]).write.parquet(str(tmp_path / "0"))
    incremental.advance(str(tmp_path / "0"), parts[0], str(tmp_path / "1"))
    other = incremental.advance(str(tmp_path / "1"), parts[1], str(tmp_path / "2")).drop("prices")
    for found in (one, other):
        assert found.exceptAll(whole).count() == 0 and found.count() == whole.count()


def test_quartiles_keep_their_rank(spark):
    rows = [(b, t, f, p, w) for b, t, f, p, w in listings(40000, 2) if b == "hot"]
    parts = [incremental.state(spark.createDataFrame(rows[k::5], SCHEMA)) for k in range(5)]
    found = {(r.brand, r.transfer_count): r for r in incremental.transfer_quartiles(incremental.merged(*parts)).collect()}
    assert set(found) == {("hot", 0), ("hot", 1)}
    for (_, transfers), r in found.items():
        prices = sorted(F32 for b, t, f, F32, w in rows if t == transfers and F32 and F32 > 0)
        for value, p in ((r.q1_price, 0.25), (r.median_price, 0.5), (r.q3_price, 0.75)):
            below = sum(x < value - 1e-4 for x in prices) / len(prices)
            upto = sum(x <= value + 1e-4 for x in prices) / len(prices)
            assert below - incremental.RANK_ERROR <= p <= upto + incremental.RANK_ERROR
        assert abs(r.min_price - prices[0]) < 1e-4 and abs(r.max_price - prices[-1]) < 1e-4


def test_summary_of_no_prices(spark):
    rows = spark.createDataFrame([("a", None, "x", None, None)], SCHEMA)
    assert [tuple(r) for r in incremental.brand_summary(incremental.state(rows)).collect()] == [("a", 1, None, None, None, None)]
    assert incremental.transfer_quartiles(incremental.state(rows)).collect() == []
    assert incremental.brand_summary(incremental.state(rows.limit(0))).collect() == []


def test_summary_equals_the_statistics(spark):
    df = spark.createDataFrame(listings(2000, 3), SCHEMA)
    typed = df.withColumns({"reg_date": F.lit(None).cast("date"), "post_date": F.lit(None).cast("date")})
    found = {r.brand: r for r in incremental.brand_summary(incremental.state(df)).collect()}
    for r in stats.brand_price_drop(typed).collect():
        assert found[r.brand].price_drop_percent == pytest.approx(r.price_drop_percent)
    assert {r.brand: r["count"] for r in stats.brand_stats(typed).collect()} == {b: r.listings for b, r in found.items()}


def test_frequent_misses_none(spark):
    draw = random.Random(4)
    rows = [("rare", str(draw.randint(0, 60000))) for _ in range(60000)] + [(None, "x")] * 700 + [("a", None)] * 650 + [('q"', "\\")] * 640 + [("edge", "e")] * 62
    df = spark.createDataFrame(rows, "a string, b string").repartition(7)
    found = {(r.a, r.b): r.n for r in incremental.frequent(df, ["a", "b"], 0.01).collect()}
    assert found == {(None, "x"): 700, ("a", None): 650, ('q"', "\\"): 640}
    assert incremental.frequent(df.limit(0), ["a", "b"], 0.01).collect() == []
    with pytest.raises(ValueError):
        incremental.frequent(df, ["a"], 1e-9)
