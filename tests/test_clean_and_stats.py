"""The hand-made listings: each row stands for one rule."""

import pytest
from pyspark.sql import functions as F

from carledger.operators import clean, stats
from carledger.plans.pipeline import statistics
from carledger.schema import CLEAN_COLUMNS, RAW_TAGGED_SCHEMA
from carledger.sources.warehouse import store_cast

AS_OF = "2025-04-17"
DEFAULTS = {
    "model": "x1",
    "gearbox": "自动",
    "inspect_due": "2026-03",
    "insurance_due": "2026-03",
    "location": "北京",
    "color": "黑",
    "drive_mode": "前驱",
    "province": "北京",
}
NAMES = (
    "brand style current_price new_price fuel_type reg_time mileage displacement post_time transfer_count engine level"
).split()
GOLDEN = [
    ("A", "2021款", "12.34万", "20.00万", "汽油", "2021年03月", "3.5万公里", "2.0L", "2025-04-01", "1次", "2.0L 190马力 L4", "SUV"),
    ("A", "2021款", "12.34万", "20.00万", "汽油", "2021年03月", "3.5万公里", "2.0L", "2025-04-01", "1次", "2.0L 190马力 L4", "SUV"),
    ("A", "2019款", "8.00万", "16.00万", "汽油", "2019年06月", "6.2万公里", "1.6L", "2025-04-10", "0次", "1.6L 120马力 L4", "紧凑型车"),
    ("B", "2022款", "15.00万", "25.00万", "电动", "2022年01月", "2.0万公里", None, "2025-03-20", "0次", "纯电 204马力 电机", "中型车"),
    ("B", "2022款", "15.00万", "25.00万", "电动", "2022年01月", "2.0万公里", None, "2025-03-20", "0次", "纯电 204马力 电机", "中型车"),
    ("C", "Classic", "5.00万", "9.00万", "汽油", "2018年05月", "9.0万公里", "1.5L", "2025-04-02", "2次", "1.5L 110马力 L4", "紧凑型车"),
    ("C", "2020款", "6.00万", "9.00万", "汽油", "2020年05月", "4.0万公里", "1.5L", "2025-04-02", "2次", "1.5L 110马力 L4", "  "),
    ("C", "2020款", "6.50万", "9.50万", "汽油", "2020年07月", "4.1万公里", "1.5L", "2025-04-03", "1次", "发动机", "紧凑型车"),
    ("C", "2018款", "0.00万", "9.00万", "汽油", "2018年09月", "8.0万公里", "1.5L", "2025-04-05", "3次", "1.5L 110马力 L4", "紧凑型车"),
    ("A", "2020款", "10.00万", "15.00万", "汽油", "未上牌", "未知", "1.5T", "2025-04-07", "1次", "1.5T 150马力 L4", "SUV"),
]


def listing(**values):
    return {**DEFAULTS, **dict(zip(NAMES, GOLDEN[0])), **values}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in RAW_TAGGED_SCHEMA.names) for r in rows], RAW_TAGGED_SCHEMA)


@pytest.fixture(scope="module")
def raw(spark):
    return frame(spark, [{**DEFAULTS, **dict(zip(NAMES, row))} for row in GOLDEN])


@pytest.fixture(scope="module")
def cleaned(raw):
    return clean.clean(raw).cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def by_id(df):
    return [tuple(r) for r in df.orderBy("id").collect()]


def test_stage_sizes(raw, cleaned):
    assert clean.first_pass(raw).count() == 9
    assert cleaned.count() == 6
    assert dict(rows(clean.stage_counts(raw))) == {"raw": 10, "with_level": 9, "with_style": 8, "clean": 6}


def test_clean_values(cleaned):
    assert cleaned.columns == CLEAN_COLUMNS
    base = cleaned.filter("brand = 'A' and style = '2021款'").collect()
    assert len(base) == 1
    assert base[0].asDict() == {
        **{k: v for k, v in DEFAULTS.items()},
        "brand": "A",
        "style": "2021款",
        "current_price": "12.34",
        "new_price": "20.00",
        "fuel_type": "汽油",
        "reg_time": "2021-03",
        "mileage": "3.5",
        "displacement": "2.0",
        "post_time": "2025-04-01",
        "transfer_count": "1",
        "engine": "L4",
        "horsepower": "190",
        "level": "SUV",
    }
    assert [r.displacement for r in cleaned.filter("style = '2020款'").collect()] == ["1.5T"]


def test_copies_stay_only_on_the_electric_path(raw, cleaned):
    assert cleaned.filter("fuel_type = '电动'").count() == 2
    assert clean.clean(raw, dedupe_all=True).filter("fuel_type = '电动'").count() == 1


def test_cleaning_changes_nothing_twice(cleaned):
    again = clean.second_pass(cleaned)
    assert again.count() == cleaned.count() and again.exceptAll(cleaned).count() == 0


@pytest.mark.parametrize(
    "changes, strict, literal",
    [
        ({"displacement": None}, 0, 0),
        ({"displacement": ""}, 0, 1),
        ({"displacement": "nan"}, 0, 1),
        ({"fuel_type": "电动", "displacement": "nan"}, 1, 1),
        ({"fuel_type": "电动", "displacement": ""}, 1, 1),
        ({"fuel_type": "电动", "displacement": None, "color": None}, 1, 1),
        ({"fuel_type": None, "displacement": None}, 0, 0),
        ({"level": None}, 0, 0),
        ({"level": " "}, 0, 1),
        ({"level": "　"}, 0, 1),
        ({"level": "nan"}, 0, 1),
        ({"level": "nano"}, 1, 1),
        ({"color": " NaN "}, 0, 1),
        ({"transfer_count": "无"}, 0, 1),
        ({"style": None}, 0, 0),
        ({"engine": "2.0L 190马力"}, 0, 0),
        ({"engine": "2.0L  190马力"}, 0, 1),
    ],
)
def test_missing_values(spark, changes, strict, literal):
    one = frame(spark, [listing(**changes)])
    assert clean.clean(one).count() == strict
    assert clean.clean(one, "literal").count() == literal


def test_short_engine_text_is_null_not_an_error(spark):
    got = clean.split_engine(frame(spark, [listing(engine="发动机"), listing(engine=None)])).select("horsepower", "engine")
    assert rows(got) == [(None, None), (None, None)]


def test_union_by_name_and_progress(raw):
    turned = raw.select(*reversed(raw.columns))
    both = clean.union_provinces([raw, turned])
    assert both.count() == 20 and both.distinct().count() == 8
    assert set(rows(clean.progress(both))) == {(b, "x1", "北京") for b in "ABC"}


def test_unknown_missing_mode(raw):
    with pytest.raises(ValueError):
        clean.clean(raw, "lenient")


def test_counts(cleaned):
    assert by_id(stats.fuel_type_stats(cleaned)) == [(1, "汽油", 4), (2, "电动", 2)]
    assert by_id(stats.brand_stats(cleaned)) == [(1, "A", 3), (2, "B", 2), (3, "C", 1)]


def test_brand_avg_price(cleaned):
    stored = store_cast(stats.brand_avg_price(cleaned), "brand_avg_price")
    assert by_id(stored) == [(1, "B", 15.0), (2, "A", 10.113333702087402), (3, "C", 0.0)]


def test_age_price(cleaned):
    assert by_id(stats.brand_age_price(cleaned, AS_OF)) == [
        (1, "A", 4.13150691986084, 12.34000015258789),
        (2, "A", 5.8821916580200195, 8.0),
        (3, "B", 3.2931506633758545, 15.0),
    ]


@pytest.mark.parametrize("accuracy", [None, 10000])
def test_quartiles(cleaned, accuracy):
    assert by_id(stats.brand_transfer_quartiles(cleaned, accuracy)) == [
        (1, "A", 0, 8.0, 8.0, 8.0, 8.0, 8.0),
        (2, "A", 1, 10.0, 10.0, 10.0, 12.34000015258789, 12.34000015258789),
        (3, "B", 0, 15.0, 15.0, 15.0, 15.0, 15.0),
    ]


def test_mileage_price(cleaned):
    assert by_id(stats.brand_mileage_price(cleaned)) == [
        (1, "A", 3.5, 12.34000015258789),
        (2, "A", 6.199999809265137, 8.0),
        (3, "B", 2.0, 15.0),
    ]


def test_price_drop(cleaned):
    assert by_id(stats.brand_price_drop(cleaned)) == [
        (1, "A", 17.0, 10.113333384195963, 40.50980362237669),
        (2, "B", 25.0, 15.0, 40.0),
    ]


def test_mileage_age_days(cleaned):
    assert by_id(stats.brand_mileage_age_days(cleaned, AS_OF)) == [
        (1, "A", 3.5, 4.13150691986084, 16),
        (2, "A", 6.199999809265137, 5.8821916580200195, 7),
        (3, "B", 2.0, 3.2931506633758545, 28),
        (4, "C", 8.0, 6.630136966705322, 12),
    ]


def test_unreadable_dates_and_nan_prices(spark):
    some = frame(
        spark,
        [
            listing(reg_time="x", post_time="2025-04-01"),
            listing(post_time="soon"),
            listing(current_price="nan", style="2001款"),
            listing(current_price="无", style="2002款", brand="Z"),
        ],
    )
    first = clean.mileage_in_wan(clean.first_pass(some, "literal"))
    days = by_id(stats.brand_mileage_age_days(first, AS_OF))
    assert days[0] == (1, "A", 3.5, None, 16) and len(days) == 3
    strict = by_id(stats.brand_avg_price(first))
    assert strict[0][1] == "A" and abs(strict[0][2] - 12.34) < 1e-6 and strict[1] == (2, "Z", None)
    literal = by_id(stats.brand_avg_price(first, "literal"))
    assert literal[0][1] == "A" and literal[0][2] != literal[0][2]


def test_quartile_sketch_stays_within_its_rank_error(spark):
    n, accuracy = 20000, 100
    many = spark.range(n).select(
        F.lit("A").alias("brand"),
        F.lit("0").alias("transfer_count"),
        (F.col("id") + 1).cast("string").alias("current_price"),
        *[F.lit(None).cast("string").alias(c) for c in ("fuel_type", "reg_time", "post_time", "new_price", "mileage")],
    )
    exact = stats.brand_transfer_quartiles(many).collect()[0]
    assert (exact.min_price, exact.q1_price, exact.median_price, exact.q3_price, exact.max_price) == (
        1.0,
        5000.0,
        10000.0,
        15000.0,
        20000.0,
    )
    rough = stats.brand_transfer_quartiles(many, accuracy).collect()[0]
    for name in ("q1_price", "median_price", "q3_price"):
        assert abs(rough[name] - exact[name]) <= n / accuracy


def test_statistics_by_name(cleaned):
    made = {name: make() for name, make in statistics(cleaned, AS_OF).items()}
    for name, df in made.items():
        stored = store_cast(df, name)
        ids = sorted(r.id for r in stored.collect())
        assert ids == list(range(1, len(ids) + 1)), name
    assert sum(r["count"] for r in made["brand_stats"].collect()) == cleaned.count()
