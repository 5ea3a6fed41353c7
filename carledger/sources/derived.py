"""Test inputs derived from the driver's star-schema tables: raw listings, listing pages, a mutation log.

Only `queries()`, the tests and the bench use this module.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carledger.operators.clean import clean
from carledger.operators.stats import typed_layer
from carledger.schema import RAW_COLUMNS, RAW_SCHEMA
from carledger.session import configure, shared_dir

FILES_A_STEP = 2  # of arrivals
OPEN_FILES = 32  # of a task that writes a layer by province

_STORED: dict[tuple[str, str, str], tuple[str, T.StructType]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(
    spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame], by: str | None = None
) -> DataFrame:
    """Write a derived table to the shared folder on first use in a session, then read it like any other table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = f"{shared_dir(configure(spark))}/{key[0]}/{len(_STORED)}-{name}"
        made = make()
        writer = made.write.mode("overwrite")
        with _open_files(spark, OPEN_FILES):
            (writer.partitionBy(by) if by else writer).parquet(path)
        _STORED[key] = path, made.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


@contextmanager
def _open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """A task writes up to n folders side by side instead of sorting its wide rows by folder first; only rows of more folders are
    sorted."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(n))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _hundredths(cents: Column) -> Column:
    """Cents of a price as units of 10,000 with two decimals, by integer arithmetic."""
    whole = (cents - cents % 1000000) / 1000000
    part = (cents % 1000000 - cents % 10000) / 10000
    return F.concat(
        whole.cast("bigint").cast("string"),
        F.lit("."),
        F.lpad(part.cast("bigint").cast("string"), 2, "0"),
    )


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer: one listing for each line item."""
    return stored(spark, sf_dir, "raw", lambda: make_raw_listings(spark, sf_dir), by="province")


def clean_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse layer: the cleaned listings, which the statistics read."""
    return stored(spark, sf_dir, "clean", lambda: clean(raw_listings(spark, sf_dir)))


def typed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed layer of the cleaned listings."""
    return stored(spark, sf_dir, "typed", lambda: typed_layer(clean_listings(spark, sf_dir)))


def make_raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth order's listings occur twice."""
    keyed = keyed_listings(spark, sf_dir)
    times = F.when(F.col("l_orderkey") % 100 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    copied = keyed.withColumn("_copy", F.explode(times))
    return copied.select(*RAW_COLUMNS, F.col("location").alias("province"))


def listing_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with raw listings as a scraper leaves them: text files named after their province."""
    key = (spark.sparkContext.applicationId, sf_dir, "files")
    if key not in _STORED:
        made = f"{shared_dir(configure(spark))}/{key[0]}/{len(_STORED)}-files"
        raw = raw_listings(spark, sf_dir)
        raw.write.partitionBy("province").option("header", "true").csv(f"{made}/parts")
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{made}/parts")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{made}/named"))
        for province in files.listStatus(folder):  # a few dozen
            name = province.getPath().getName().partition("=")[2]
            for k, file in enumerate(files.globStatus(jvm.org.apache.hadoop.fs.Path(province.getPath(), "part-*")) if name else ()):
                files.rename(file.getPath(), jvm.org.apache.hadoop.fs.Path(f"{made}/named/car_list_{name.replace('_', '-')}_{k}.csv"))
        _STORED[key] = f"{made}/named", RAW_SCHEMA
    return _STORED[key][0]


def keyed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing texts with units, by integer arithmetic, next to the keys of their line item."""
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Parts last: their wide columns then move through no further join.
    rows = (
        line.join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(part, line.l_partkey == part.p_partkey)
    )
    c = F.col
    cents = F.round(c("l_extendedprice") * 100).cast("bigint")
    electric = c("p_size") % 5 == 0
    text = lambda v: v.cast("string")
    pick = lambda *words: F.element_at(F.array(*map(F.lit, words)), (c("p_size") % 3 + 1).cast("int"))
    values = {
        "brand": c("p_brand"),
        "style": F.when(c("l_partkey") % 11 == 0, "Classic").otherwise(
            F.concat(text(1995 + c("l_partkey") % 25), F.lit("款"))
        ),
        "model": c("p_name"),
        "current_price": F.when(c("l_orderkey") % 97 == 0, "0.00万").otherwise(
            F.concat(_hundredths(cents), F.lit("万"))
        ),
        "new_price": F.concat(_hundredths(cents + (c("l_partkey") % 50 + 1) * 100000), F.lit("万")),
        "fuel_type": F.when(electric, "电动").otherwise("汽油"),
        "reg_time": F.when(c("l_orderkey") % 101 == 0, "未上牌").otherwise(
            F.date_format("l_shipdate", "yyyy年MM月")
        ),
        "mileage": F.when(c("l_orderkey") % 89 == 0, "未知").otherwise(
            F.concat(text(c("l_quantity").cast("int")), F.lit("."), text(c("l_partkey") % 10), F.lit("万公里"))
        ),
        "gearbox": pick("自动", "手动", "双离合"),
        "displacement": F.when(electric & (c("l_partkey") % 4 == 1), " ").when(electric & (c("l_partkey") % 4 == 2), "nan").when(
            ~electric, F.concat(text(1 + c("p_size") % 3), F.lit("."), text(c("p_size") % 10), F.lit("L"))
        ),
        "post_time": F.date_format(F.date_add(c("l_shipdate").cast("date"), 30), "yyyy-MM-dd"),
        "inspect_due": pick("2026-03", "2026-09", "2027-01"),
        "insurance_due": pick("2026-02", "2026-08", "2027-05"),
        "transfer_count": F.concat(text(c("l_linenumber") - 1), F.lit("次")),
        "location": c("n_name"),
        "engine": F.when(c("l_partkey") % 53 == 0, "发动机").otherwise(
            F.concat(F.lit("2.0L "), text(80 + c("p_size") * 3), F.lit("马力 L"), text(3 + c("p_size") % 4))
        ),
        "level": F.when(c("l_suppkey") % 17 == 0, "")
        .when(c("l_suppkey") % 19 == 0, "\xa0")
        .when(c("l_suppkey") % 23 == 0, "nan")
        .otherwise(c("p_type")),
        "color": F.when(c("l_orderkey") % 83 == 0, "nan").otherwise(pick("黑", "白", "灰")),
        "drive_mode": pick("前驱", "后驱", "四驱"),
    }
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", *[values[n].alias(n) for n in RAW_COLUMNS])


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page (`url`, `html`, `province`) for each line item, some of them incomplete. Pages are made where they are
    read: stored, they would take a hundred times the space of the tables, and each query reads them once."""
    return make_detail_pages(spark, sf_dir)


def make_detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    html = F.when(order % 5 == 0, _joined(_page(_respelled), _SIMILAR)).otherwise(_page(lambda piece: piece))
    url = _joined("/lot/", order.cast("string"), "-", F.col("l_linenumber").cast("string"), "-", part.cast("string"), ".html")
    return keyed_listings(spark, sf_dir).select(
        url.alias("url"), html.alias("html"), F.col("location").alias("province")
    )


def _joined(*pieces: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def _page(spelled: Callable[[str | Column], str | Column]) -> Column:
    """A detail page over `keyed_listings`, in one spelling of its fixed pieces and of its values."""
    order, part, empty = F.col("l_orderkey"), F.col("l_partkey"), F.lit("")
    c = lambda name: spelled(F.col(name))
    join = lambda *pieces: _joined(*[spelled(p) if isinstance(p, str) else p for p in pieces])
    title = F.when(order % 107 == 0, " ").when(part % 17 == 0, join(" ", c("brand"))).otherwise(
        join(c("brand"), "  ", c("style"), "&nbsp;", c("model"), " &amp; co")
    )
    untitled = order % 103 == 0
    crumbs = F.when(untitled, empty).otherwise(
        join(
            '<div class="bread-crumbs"><p class="content"><a href="/">home</a> <a href="/x">', title, "</a></p></div>"
        )
    )
    heading = F.when(untitled | (part % 7 == 0), empty).otherwise(
        join('<p data-class="car-brand-name">no title</p><h3 data-x="a > b" class="car-brand-name top">', title, "</h3>")
    )
    price = F.when((order % 109 == 0) | (part % 13 == 0), empty).otherwise(
        join('<b data-class="price">no price</b><span class="price">￥', c("current_price"), "</span>")
    )
    new_price = (
        F.when(part % 5 == 0, empty)
        .when(part % 3 == 0, join('<i class="price-nom">', c("new_price"), "</i>"))
        .otherwise(join('<i class="price-nom">新车含税价：', c("new_price"), " </i>"))
    )
    card_price = F.when((order % 109 != 0) & (part % 13 == 0), join("<b>¥</b> ", c("current_price")))
    card = F.coalesce(
        join(
            '<div class="cxc-priceCard"><p class="left-module"><em class="goodstartmoney">', card_price, "</em></p></div>"
        ),
        empty,
    )

    def item(name: str, value: str | Column) -> Column:
        return join('<li><span class="item-name">', name, "</span>", value, "</li>")

    return join(
        "<html><body>",
        crumbs,
        '<div class="car-box">',
        heading,
        '<p class="brand-price-item">',
        price,
        new_price,
        "</p></div>",
        card,
        '<div class="all-basic-content"><ul class="basic-item-ul">',
        item("上牌&nbsp;时间：", c("reg_time")),
        F.when(F.col("fuel_type") == "电动", empty).otherwise(item("燃油标号", "92号")),
        item("表显里程：", join(" ", c("mileage"), " ")),
        item("变速箱", join("<b>", c("gearbox"), "</b>")),
        item("排量", F.coalesce(c("displacement"), empty)),
        item("发布时间：", c("post_time")),
        '</ul><ul class="basic-item-ul more"><li>备注</li>',
        item("年检到期", c("inspect_due")),
        item("保险到期", c("insurance_due")),
        item("过户次数", c("transfer_count")),
        item("所在地", join(c("location"), "所在地")),
        item("车身颜色", "旧色"),
        item("发动机", c("engine")),
        item("车辆级别", c("level")),
        item("车身颜色", c("color")),
        item("驱动方式", c("drive_mode")),
        "</ul></div></body></html>",
    )


# Another listing's parts, outside the elements that hold the page's own.
_SIMILAR = (
    "<div class='similar'><h3 class='car-brand-name'>AD</h3><p class='brand-price-item'><span class='price'>9.99万</span>"
    "<i class='price-nom'>1.00万</i></p><ul class='basic-item-ul'><li><b class='item-name'>所在地</b>AD</li></ul></div>"
)


_SPELLINGS = (
    ('class="car-box"', "CLASS=car-box"), ('"', "'"), ("<li>", "<LI>"), ("</li>", "</LI>"), ("&nbsp;", "&#xA0;"), ("￥", "&#65509;"),
    ("</body></html>", ""),
)


def _respelled(piece: str | Column) -> str | Column:
    """A piece of a page as another tool would write it: quotes, case, character references. None of what is written anew
    reaches over the end of a piece, so pieces are spelled before they are joined: fixed ones once, not for each page."""
    for find, put in _SPELLINGS:
        piece = piece.replace(find, put) if isinstance(piece, str) else F.replace(piece, F.lit(find), F.lit(put))
    return piece


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list page for each part: cards with links between links outside of cards; attributes with longer names, quoted signs,
    references, and links in comments and scripts."""
    key = F.col("p_partkey").cast("string")
    join = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    html = join(
        '<a href="/top">top</a><ul><li class="cards-li list-photo"><a class="carinfo" href="/lot/',
        key,
        '.html?a=1&amp;b=2">x</a><a href="">y</a><!-- <a href="/old"> --><a data-href="/wrong" href="/lot/',
        key,
        '.html">z</a></li><li class="ad" data-class="cards-li"><a href="/ad">ad</a></li><li data-class="ad" class="cards-li">',
        "<script>'<a href=\"/script\">'</script><a title=\"a > b href='/no'\" href='/lot/",
        key,
        ".html'>z</a><a\nHREF=/lot/",
        key,
        ".&eacute;&#x41;?x=1&copy=2>w</a></li></ul>",
    )
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html"))


def mutation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes to a cell table: some delete a row or a cell, the others put a value."""
    event = table(spark, sf_dir, "events")
    number = F.col("event_id")
    op = F.when(number % 101 == 0, "delete_row").when(number % 17 == 0, "delete_cell").otherwise("put")
    return event.select(
        F.lit("activity").alias("tbl"),
        F.concat(F.lit("u"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("row_key"),
        F.lit("cf").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
        number.alias("seq"),
        op.alias("op"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("value"),
    )


def hot_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The puts of the log with a third of them in one row."""
    row = F.when(F.col("seq") % 3 == 0, "hot").otherwise(F.col("row_key"))
    return event_cells(spark, sf_dir).withColumn("row_key", row)


def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as operations of every kind on one cell for each user."""
    n = F.col("seq")
    op = (
        F.when(n % 101 == 0, "delete_row")
        .when(n % 103 == 0, "delete_family")
        .when(n % 29 == 0, "delete_cell")
        .when(n % 6 == 0, "put")
        .when(n % 6 == 1, "append")
        .when(n % 6 == 2, "cas")
        .otherwise("increment")
    )
    value = F.when(n % 6 == 0, (n % 4).cast("string")).when(n % 6 == 1, F.when(n % 5 == 0, "z").otherwise("1"))
    value = value.when(n % 6 == 2, "7").otherwise((n % 3 + 1).cast("string"))
    expected = F.when(n % 6 == 2, F.when(n % 4 == 0, F.lit(None)).otherwise((n % 5).cast("string")))
    return mutation_log(spark, sf_dir).select(
        "tbl", "row_key", "family", F.lit("state").alias("qualifier"), "ts", "seq", op.alias("op"), value.alias("value"),
        expected.cast("string").alias("expected"),
    )


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All puts of the log as versions."""
    return mutation_log(spark, sf_dir).filter(F.col("op") == "put").drop("op")


def arrival_order(puts: DataFrame) -> DataFrame:
    """The puts with `seq` as a number of arrival that doesn't follow their timestamps."""
    return puts.withColumn("seq", F.pmod(F.col("seq") * 613, F.lit(10007)) * 1_000_000_000 + F.col("seq"))


def arrivals(spark: SparkSession, sf_dir: str, steps: int = 4) -> tuple[str, T.StructType]:
    """A folder of files with the puts of the log in the order of their arrival, written one step after the other; the puts of a
    cell in a step are in one file. And the schema. The number of files, and so of a stream's batches, is the same for any log."""
    key = (spark.sparkContext.applicationId, sf_dir, f"arrivals-{steps}")
    if key not in _STORED:
        puts = arrival_order(event_cells(spark, sf_dir)).drop("op")
        path = f"{shared_dir(configure(spark))}/{key[0]}/{len(_STORED)}-arrivals"
        step = F.floor(F.col("seq") / F.lit(1_000_000_000 * -(-10007 // steps)))
        for k in range(steps):
            puts.filter(step == k).repartition(FILES_A_STEP, "tbl", "row_key", "family", "qualifier").write.mode("append").parquet(path)
        _STORED[key] = path, puts.schema
    return _STORED[key]
