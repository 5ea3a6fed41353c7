"""The registered queries: every operator over the whole of the given tables (see sources.derived for the inputs)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carledger.functions import text as X
from carledger.functions.typed import age_years, days_since, to_date, to_float, to_int
from carledger.operators import cells as K
from carledger.operators import checkput, clean, clustered, extract, groupings, incremental, mutations, shredded, stats, timeline
from carledger.operators.rowid import row_id
from carledger.plans.pipeline import PUBLISHED, statistics
from carledger.schema import CELL, ELECTRIC, GASOLINE
from carledger.sources import derived as D
from carledger.session import configure, shared_dir
from carledger.sources.listings import read_listings, read_partitioned, write_listings
from carledger.streaming import newest
from carledger.sources.warehouse import create_listing_table, load_listings, read_table, store_cast

AS_OF = "2025-04-17"
HOST = "https://listings.invalid"
MID_JANUARY = 1705276800000000  # 2024-01-15 00:00 UTC in microseconds
END_JANUARY = 1706659200000000  # 2024-01-31 00:00 UTC in microseconds
DAY = 86_400_000_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _first_pass(spark: SparkSession, sf: str) -> DataFrame:
    return clean.first_pass(D.raw_listings(spark, sf))


# -- sources ------------------------------------------------------------------------------------------------------


@query
def s1_scan_by_province(spark, sf):
    """One scan over a folder with a directory for each province."""
    listings = D.raw_listings(spark, sf)
    return listings.groupBy("province").agg(
        F.count(F.lit(1)).alias("listings"), F.count("displacement").alias("with_displacement")
    )


@query
def s1_read_listings(spark, sf):
    """Text files named after their province, in one scan."""
    listings = read_listings(spark, D.listing_files(spark, sf))
    return listings.groupBy("province").agg(F.count(F.lit(1)).alias("listings"), F.count("style").alias("with_style"))


@query
def s4_load_listings(spark, sf):
    """A catalog table, loaded and read."""
    name = f"loaded_{uuid.uuid4().hex}"
    create_listing_table(spark, name, f"{shared_dir(spark)}/{name}")
    load_listings(D.clean_listings(spark, sf), name)
    return read_table(spark, name)


@query
def s7_write_listings(spark, sf):
    """Listings written by province and read again."""
    path = f"{shared_dir(configure(spark))}/written-{uuid.uuid4().hex}"
    rows = D.clean_listings(spark, sf)
    write_listings(rows, path)
    return read_partitioned(spark, path, rows.schema)


@query
def s5_store_cast(spark, sf):
    return store_cast(stats.brand_avg_price(D.typed_listings(spark, sf)), "brand_avg_price")


@query
def s8_frontier(spark, sf):
    nations = D.table(spark, sf, "nation").select(
        F.col("n_name").alias("name"), F.concat(F.lit(f"{HOST}/"), F.lower("n_name"), F.lit("/list?a=1")).alias("base_url")
    )
    return extract.frontier(nations)


# -- extraction ---------------------------------------------------------------------------------------------------


@query
def e1_links(spark, sf):
    pages = D.table(spark, sf, "pages").select("page_id", "html")
    return extract.links(pages, HOST, card_class=None)


@query
def e1_card_links(spark, sf):
    return extract.links(D.list_pages(spark, sf), HOST)


@query
def e1_page_links(spark, sf):
    """All links of pages with attributes of longer names, quoted signs, references, comments and scripts."""
    return extract.links(D.list_pages(spark, sf), HOST, card_class=None)


@query
def e2_profile_kv(spark, sf):
    pages = D.detail_pages(spark, sf).select("url", "html")
    return extract.profile_rows(pages)


@query
def e3_title_split(spark, sf):
    parts = extract.page_parts(D.detail_pages(spark, sf), ["title"]).filter(X.strip(F.col("title")) != "")
    title = F.col("title")
    return parts.select(
        "url",
        X.title_brand(title).alias("brand"),
        X.title_style(title).alias("style"),
        X.title_model(title).alias("model"),
    )


@query
def e4_price_text(spark, sf):
    parts = extract.page_parts(D.detail_pages(spark, sf), ["price"]).filter(F.col("price").isNotNull())
    return parts.select("url", X.price_text(F.col("price")).alias("current_price"))


@query
def e5_new_price_text(spark, sf):
    parts = extract.page_parts(D.detail_pages(spark, sf), ["new_price"])
    return parts.select("url", X.new_price_text(F.col("new_price")).alias("new_price"))


@query
def e6_fuel_type(spark, sf):
    pages = extract.profiles(D.detail_pages(spark, sf).select("url", "html"))
    return pages.select("url", extract.fuel_type(F.col("profile")).alias("fuel_type"))


@query
def e7_fallback(spark, sf):
    return extract.page_parts(D.detail_pages(spark, sf), ["title", "price"]).select("url", "title", "price")


@query
def e8_profile_pivot(spark, sf):
    pages = extract.profiles(D.detail_pages(spark, sf).select("url", "html"))
    columns = extract.profile_columns(F.col("profile"))
    return pages.select("url", *[c.alias(n) for n, c in columns.items()])


@query
def e9_rejects(spark, sf):
    return extract.rejects(extract.page_parts(D.detail_pages(spark, sf).select("url", "html"), ["title", "price"]))


@query
def e9_listings(spark, sf):
    """The good pages as raw listings: E2-E8 together."""
    return extract.listings(extract.page_parts(D.detail_pages(spark, sf).select("url", "html")))


# -- cleaning -----------------------------------------------------------------------------------------------------


@query
def c1_strip_units(spark, sf):
    return clean.strip_units(D.raw_listings(spark, sf)).select(
        "brand", "model", "current_price", "new_price", "mileage", "displacement"
    )


@query
def c2_reg_month(spark, sf):
    return clean.reg_month(D.raw_listings(spark, sf)).select("brand", "model", "reg_time")


@query
def c3_digits_only(spark, sf):
    return clean.transfer_digits(D.raw_listings(spark, sf)).select("brand", "model", "transfer_count")


@query
def c4_engine_split(spark, sf):
    return clean.split_engine(D.raw_listings(spark, sf)).select("brand", "model", "horsepower", "engine")


@query
def c5_drop_blank_level(spark, sf):
    return clean.drop_blank_level(D.raw_listings(spark, sf)).select("brand", "model", "level")


@query
def c6_union_by_name(spark, sf):
    raw = D.raw_listings(spark, sf).select("brand", "model", "fuel_type", "province")
    gasoline = raw.filter(F.col("fuel_type") == GASOLINE)
    other = raw.filter(F.col("fuel_type") != GASOLINE).select(*reversed(raw.columns))
    return clean.union_provinces([gasoline, other])


@query
def c7_project21(spark, sf):
    return _first_pass(spark, sf)


@query
def c8_style_contains(spark, sf):
    return clean.keep_marked_style(_first_pass(spark, sf)).select("brand", "style", "model")


@query
def c9_mileage_wan(spark, sf):
    return clean.mileage_in_wan(_first_pass(spark, sf)).select("brand", "model", "mileage")


@query
def c10_electric_null_disp(spark, sf):
    return clean.electric_part(_first_pass(spark, sf))


@query
def c11_subtract(spark, sf):
    return clean.without_electric_part(_first_pass(spark, sf))


@query
def c12_dropna_any(spark, sf):
    return _first_pass(spark, sf).filter(clean.complete())


@query
def c13_clean_full(spark, sf):
    return clean.clean(D.raw_listings(spark, sf))


@query
def c13_clean_literal(spark, sf):
    return clean.clean(D.raw_listings(spark, sf), missing="literal")


@query
def c14_stage_counts(spark, sf):
    return clean.stage_counts(D.raw_listings(spark, sf))


@query
def c15_progress(spark, sf):
    return clean.progress(_first_pass(spark, sf))


@query
def c16_valid_rows(spark, sf):
    rows = stats.typed_listings(D.clean_listings(spark, sf), AS_OF)
    valid = F.col("fuel_type").isin(GASOLINE, ELECTRIC) & stats.positive("price") & stats.positive("new_price")
    return rows.filter(valid & F.col("mileage").isNotNull()).select("brand", "price", "new_price", "mileage")


@query
def c17_try_casts(spark, sf):
    rows = clean.mileage_in_wan(_first_pass(spark, sf))
    return rows.select(
        "brand",
        to_float(F.col("current_price")).alias("price"),
        to_float(F.col("mileage")).alias("mileage"),
        to_int(F.col("transfer_count")).alias("transfer_count"),
        to_int(F.col("horsepower")).alias("horsepower"),
        to_date(F.col("reg_time")).alias("reg_date"),
        to_date(F.col("post_time")).alias("post_date"),
    )


@query
def c18_age_days(spark, sf):
    rows = D.clean_listings(spark, sf)
    return rows.select(
        "brand",
        age_years(to_date(F.col("reg_time")), AS_OF).alias("car_age"),
        days_since(to_date(F.col("post_time")), AS_OF).alias("publish_days"),
    )


# -- statistics ---------------------------------------------------------------------------------------------------


@query
def a1_fuel_type_stats(spark, sf):
    return stats.fuel_type_stats(D.typed_listings(spark, sf))


@query
def a2_brand_avg_price(spark, sf):
    return stats.brand_avg_price(D.typed_listings(spark, sf))


@query
def a3_brand_stats(spark, sf):
    return stats.brand_stats(D.typed_listings(spark, sf))


@query
def a4_brand_age_price(spark, sf):
    return stats.brand_age_price(D.typed_listings(spark, sf), AS_OF)


@query
def a5_brand_transfer_quartiles(spark, sf):
    return stats.brand_transfer_quartiles(D.typed_listings(spark, sf))


@query
def a5_brand_transfer_sketch(spark, sf):
    """The quartiles from the mergeable sketch, fine enough to be exact for these groups."""
    return stats.brand_transfer_quartiles(D.typed_listings(spark, sf), accuracy=100_000)


@query
def a6_brand_mileage_price(spark, sf):
    return stats.brand_mileage_price(D.typed_listings(spark, sf))


@query
def a7_brand_price_drop(spark, sf):
    return stats.brand_price_drop(D.typed_listings(spark, sf))


@query
def a8_brand_mileage_age_days(spark, sf):
    return stats.brand_mileage_age_days(D.typed_listings(spark, sf), AS_OF)


@query
def a9_row_id(spark, sf):
    """Ids over a whole table, not over an aggregate."""
    orders = D.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return row_id(orders, [F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


@query
def a10_order_by(spark, sf):
    counts = D.typed_listings(spark, sf).groupBy("brand").agg(F.count(F.lit(1)).alias("count"))
    return stats.ordered(counts, "count", "brand")


# -- cell tables --------------------------------------------------------------------------------------------------


def _day_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Puts stamped with the day: several share a timestamp, the later sequence number is the newer."""
    return D.event_cells(spark, sf).withColumn("ts", F.col("ts") - F.col("ts") % DAY)


def _deleted_rows(spark: SparkSession, sf: str) -> DataFrame:
    return D.mutation_log(spark, sf).filter(F.col("op") == "delete_row").select("row_key").distinct()


def _order_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Each order changes its customer's row; some also delete a cell, a family or the row."""
    entry = lambda gone, column, value: F.struct(
        F.lit(gone).alias("is_delete"),
        F.lit(column).cast("string").alias("column"),
        value.cast("string").alias("value"),
    )
    key, nothing = F.col("o_orderkey"), F.lit(None)
    puts = [entry(False, "cf:status", F.col("o_orderstatus")), entry(False, "cf:priority", F.col("o_orderpriority"))]
    puts += [entry(False, "meta:by:clerk", F.col("o_orderstatus")), entry(False, "meta:at:clerk", F.col("o_orderpriority"))]
    changes = (
        F.when(key % 37 == 0, F.array(entry(True, None, nothing)))
        .when(key % 23 == 0, F.array(*puts, entry(True, "meta", nothing)))
        .when(key % 10 == 0, F.array(*puts, entry(True, "cf:priority", nothing)))
        .otherwise(F.array(*puts))
    )
    return D.table(spark, sf, "orders").select(
        F.lit("customer").alias("tbl"),
        F.col("o_custkey").cast("string").alias("row_key"),
        key.alias("ts"),
        key.alias("seq"),
        changes.alias("mutations"),
    )


@query
def k1_to_cells(spark, sf):
    name = "car_brand_age_price_avg"
    table = store_cast(stats.brand_age_price(D.typed_listings(spark, sf), AS_OF), name)
    return K.to_cells(table, name, ts=0)


@query
def k2_publish_tables(spark, sf):
    made = statistics(D.typed_listings(spark, sf), AS_OF)
    return K.publish({n: store_cast(made[n](), n) for n in PUBLISHED}, ts=0)


@query
def k4_put(spark, sf):
    orders = D.table(spark, sf, "orders").withColumn("stamp", F.col("o_orderkey"))
    puts = mutations.put_rows(
        orders,
        "customer",
        "o_custkey",
        {"cf:status": "o_orderstatus", "cf:priority": "o_orderpriority", "cf:a:b": "o_orderstatus"},
        ts="stamp",
        seq="o_orderkey",
    )
    return mutations.latest_visible(puts)


@query
def k5_batch_mutate(spark, sf):
    return mutations.latest_visible(mutations.expand_batches(_order_batches(spark, sf)))


@query
def k6_latest(spark, sf):
    return mutations.latest_visible(D.mutation_log(spark, sf))


@query
def k7_multi_get(spark, sf):
    """Two columns of the rows that were deleted at some time."""
    return K.get_rows(D.event_cells(spark, sf), _deleted_rows(spark, sf), ["cf:click", "cf:view"])


@query
def k8_apply_deletes(spark, sf):
    return mutations.visible(D.mutation_log(spark, sf))


@query
def k9_versions(spark, sf):
    return K.versions(D.event_cells(spark, sf), 3, MID_JANUARY)


@query
def k8_replay(spark, sf):
    """Operations of every kind in the order of the log."""
    outcomes = mutations.replay(D.state_log(spark, sf))
    return outcomes.select("row_key", "seq", F.col("applied").cast("int").alias("applied"), "value")


@query
def k9_many_versions(spark, sf):
    """Cells of which one row holds a third of all versions: places counted over range partitions."""
    return K.versions(D.hot_cells(spark, sf), 50, spread=True)


@query
def k9_day_versions(spark, sf):
    """Many versions with one timestamp."""
    return K.versions(_day_cells(spark, sf), 4, spread=True)


@query
def k10_row_at(spark, sf):
    return K.get_rows(D.event_cells(spark, sf), _deleted_rows(spark, sf), ["cf"], MID_JANUARY, "as_of")


@query
def k10_row_exactly_at(spark, sf):
    return K.get_rows(_day_cells(spark, sf), _deleted_rows(spark, sf), None, MID_JANUARY)


@query
def k10_rows_as_of(spark, sf):
    """Each order asks for the cells of a row as they were at some time."""
    at = MID_JANUARY - 10 * DAY + (F.col("o_orderkey") * 7919 % 20000) * 130_000_000
    row = F.concat(F.lit("u"), F.lpad((F.col("o_custkey") % 150).cast("string"), 9, "0"))
    row = F.when(F.col("o_custkey") % 7 == 0, "hot").otherwise(row)
    asked = D.table(spark, sf, "orders").select("o_orderkey", F.lit("activity").alias("tbl"), row.alias("row_key"), at.alias("at"))
    return K.rows_as_of(D.hot_cells(spark, sf), asked, "at").select("o_orderkey", *CELL, "at", "ts", "value")


@query
def k11_retention(spark, sf):
    return K.retain(D.event_cells(spark, sf), 3, 10 * 86_400, END_JANUARY, ts_per_second=1_000_000)


@query
def k12_range_scan(spark, sf):
    return K.scan(D.event_cells(spark, sf), "u000000010", "u000000020")


@query
def k13_prefix_scan(spark, sf):
    return K.scan(D.event_cells(spark, sf), prefix="u0000000")


@query
def k14_scan_at(spark, sf):
    return K.scan(_day_cells(spark, sf), "u000000010", "u000000090", ts=MID_JANUARY)


@query
def k15_scan_spec(spark, sf):
    return K.scan(
        D.event_cells(spark, sf),
        start="u000000120",
        stop="u000000005",
        columns=["cf:.*i.*"],
        predicate="cast(value AS bigint) > 1000",
        reverse=True,
    )


@query
def k16_scan_limit(spark, sf):
    """The first rows of two tables."""
    orders = mutations.visible(mutations.expand_batches(_order_batches(spark, sf)))
    both = D.event_cells(spark, sf).unionByName(orders)
    return K.latest(K.first_rows(both, 5, start="5"))


@query
def k3_write_cells(spark, sf):
    """Cells written in key order and read again."""
    path = f"{shared_dir(configure(spark))}/cells-{uuid.uuid4().hex}"
    made = K.latest(D.event_cells(spark, sf))
    K.write_cells(made, path)
    return spark.read.schema(made.schema).parquet(path)


@query
def k17_row_result(spark, sf):
    entry = lambda c: F.concat(c["column"], F.lit("="), c["cell"]["value"], F.lit("@"), c["cell"]["ts"].cast("string"))
    rows = K.row_lists(K.latest(D.event_cells(spark, sf)))
    return rows.select(
        "tbl", "row_key", F.size("columns").alias("n"), F.array_join(F.transform("columns", entry), ";").alias("cells")
    )


@query
def k17_row_map(spark, sf):
    rows = K.row_maps(K.latest(D.event_cells(spark, sf)))
    click = F.try_element_at("columns", F.lit("cf:click"))
    return rows.select(
        "row_key", F.size("columns").alias("n"), click["value"].alias("click"), click["ts"].alias("click_ts")
    )


def _increments(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    log = D.mutation_log(spark, sf).filter(F.col("op") == "put")
    base = (
        log.select("tbl", "row_key", "family")
        .distinct()
        .select(
            "tbl", "row_key", "family", F.lit("click").alias("qualifier"), F.lit(0).alias("ts"), F.lit("100").alias("value")
        )
    )
    return log.select(*CELL, "seq", F.col("value").cast("bigint").alias("amount")), base


@query
def k18_increment(spark, sf):
    return mutations.increment_steps(*_increments(spark, sf))


@query
def k18_increment_totals(spark, sf):
    return mutations.increment_totals(*_increments(spark, sf))


@query
def k19_append(spark, sf):
    log = D.mutation_log(spark, sf)
    requests = log.select(
        "tbl",
        "row_key",
        "seq",
        F.array(F.lit("cf:trail"), F.concat(F.lit("cf:"), F.col("qualifier"))).alias("columns"),
        F.array(F.substring("qualifier", 1, 1), F.concat("value", F.lit(","))).alias("values"),
    )
    return mutations.append_values(mutations.expand_appends(requests))


def _check_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Each event asks its user's state cell for one kind of event and would put its own kind."""
    log = D.mutation_log(spark, sf)
    kinds = F.array(*map(F.lit, ["click", "view", "error", "purchase", "signup"]))
    expected = F.when(F.col("seq") % 7 != 0, F.element_at(kinds, (F.col("seq") % 5 + 1).cast("int")))
    return log.select(
        "tbl",
        "row_key",
        "family",
        F.lit("state").alias("qualifier"),
        "seq",
        expected.alias("expected"),
        F.col("qualifier").alias("value"),
    )


@query
def k20_check_and_put(spark, sf):
    results = checkput.check_and_put(_check_requests(spark, sf))
    return results.select("row_key", "seq", F.col("applied").cast("int").alias("applied"))


@query
def k21_catalog(spark, sf):
    log = D.mutation_log(spark, sf).select(*CELL)
    return K.families(log.unionByName(mutations.expand_batches(_order_batches(spark, sf)).select(*CELL)))


@query
def k21_row_exists(spark, sf):
    keys = D.table(spark, sf, "customer").select(
        F.lit("activity").alias("tbl"),
        F.concat(F.lit("u"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("row_key"),
    )
    found = K.rows_exist(D.event_cells(spark, sf), keys)
    return found.select("row_key", F.col("row_exists").cast("int").alias("row_exists"))


# -- time and groups ----------------------------------------------------------------------------------------------

HOUR = 3_600_000_000
NEW_YEAR = 1704067200000000  # 2024-01-01 00:00 UTC in microseconds


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with whole numbers; user 0 has a third of them, and more."""
    user = F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    cents, at = F.round(F.col("value") * 100).cast("bigint"), F.unix_micros(F.col("ts").cast("timestamp"))
    return D.table(spark, sf, "events").select("event_id", user.cast("bigint").alias("user_id"), at.alias("at"), "event_type", cents.alias("cents"))


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    """Orders moved into the month of the events, at distinct times."""
    key = F.col("o_orderkey")
    at = F.lit(NEW_YEAR) + key * 173 % 2592000 * 1_000_000 + key % 1_000_000
    return D.table(spark, sf, "orders").select((F.col("o_custkey") % 150).alias("user_id"), at.alias("at"), key.alias("o_orderkey"), "o_orderstatus")


@query
def t1_asof_join(spark, sf):
    """Every event with the last order of its user before it."""
    return timeline.asof_join(_events(spark, sf), _visits(spark, sf), ["user_id"], "at", ["o_orderkey"])


@query
def t2_interval_join(spark, sf):
    """Events of a dealer while a listing was on the market: 1 to 50 hours, some for weeks."""
    key = F.col("l_orderkey")
    start = F.lit(NEW_YEAR) + key * 37 % 720 * HOUR
    length = F.col("l_quantity").cast("bigint") * HOUR * F.when(key % 50 == 0, 20).otherwise(1)
    market = D.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("user_id"), "l_orderkey", "l_linenumber", start.alias("posted"), (start + length).alias("sold")
    )
    events = _events(spark, sf).select("user_id", "event_id", "at", F.col("at").alias("until"))
    found = timeline.interval_join(market, events, ["user_id"], ("posted", "sold"), ("at", "until"), base=6 * HOUR)
    return found.groupBy("user_id", "event_id", "at").agg(F.count(F.lit(1)).alias("on_market"), F.min("l_orderkey").alias("first_order"), F.sum("l_linenumber").cast("bigint").alias("lines"))


def _prices(spark: SparkSession, sf: str) -> DataFrame:
    """Prices of listings by brand and day. A third of all belong to one brand."""
    line = D.table(spark, sf, "lineitem")
    part = D.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    brand = F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(F.col("p_brand"))
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return line.join(part, "l_partkey").select(brand.alias("brand"), day.alias("day"), "l_orderkey", "l_linenumber", "l_partkey", cents.alias("cents"))


@query
def t3_moving_price(spark, sf):
    """Listings and prices of the seven days up to each day, by brand."""
    found = timeline.moving_totals(_prices(spark, sf), ["brand"], "day", {"cents": F.col("cents")}, 6)
    return found.select("brand", "day", "n", "cents", (F.col("cents") / F.col("n") / 100).alias("avg_price"))


@query
def t3_lag_lead(spark, sf):
    """Each price with the one before and the one two places later of the same brand."""
    order = ["day", "l_orderkey", "l_linenumber", "l_partkey", "cents", "copy"]
    prices = _prices(spark, sf).groupBy("brand", *order[:-1]).agg(F.count(F.lit(1)).alias("copy"))
    return timeline.neighbours(prices, ["brand"], order, ["cents"], {"before_": -1, "after_": 2})


@query
def t4_sessions(spark, sf):
    """Runs of events of a user with at most two hours between them."""
    return timeline.sessions(_events(spark, sf), ["user_id"], "at", 2 * HOUR, {"cents": F.col("cents")})


STREAM_DELAY, STREAM_TTL = 3_600, 10 * 86_400  # seconds


def _changes(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """The changes of the newest cells while puts arrive file by file, out of order, and the horizon of what lives at the end."""
    path, schema = D.arrivals(spark, sf)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)
    last = spark.read.schema(schema).parquet(path).agg(F.max("ts")).first()[0] or 0
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    changes = newest.run_to_end(stream, f"{folder}/changes", f"{folder}/state", STREAM_DELAY, STREAM_TTL)
    return changes, last - (STREAM_DELAY + STREAM_TTL) * 1_000_000


@query
def t5_stream_newest(spark, sf):
    """The newest cells, by a stream that keeps them in state."""
    changes, horizon = _changes(spark, sf)
    return newest.visible(changes, horizon)


@query
def t5_stream_late(spark, sf):
    """The side table of puts that came too late to be the newest."""
    changes, horizon = _changes(spark, sf)
    return newest.late(changes, horizon)


@query
def g1_cube(spark, sf):
    """Listings and prices at every level of province, brand and fuel."""
    rows = D.clean_listings(spark, sf).withColumn("transfers", to_int(F.col("transfer_count")))
    sums = {"listings": F.lit(1), "transfers": F.col("transfers")}
    return groupings.cube_totals(rows, ["province", "brand", "fuel_type"], sums)


@query
def g1_grouping_sets(spark, sf):
    """Totals by brand and fuel, by province, and of all; a null brand is a value."""
    rows = D.raw_listings(spark, sf).withColumn("brand", F.when(F.col("brand") != "Brand#2", F.col("brand")))
    return groupings.cube_totals(rows, ["province", "brand", "fuel_type"], {"listings": F.lit(1)}, [["brand", "fuel_type"], ["province"], []])


@query
def g2_distinct_models(spark, sf):
    """Exact distinct models by brand and fuel, by brand, and of all, from one set of bitmaps."""
    models = D.raw_listings(spark, sf).select("brand", "fuel_type", F.concat_ws("/", "model", "engine", "mileage").alias("model"))
    bitmaps = groupings.distinct_bitmaps(models, ["brand", "fuel_type"], "model")
    none = F.lit(None).cast("string")
    fine = groupings.distinct_counts(bitmaps, ["brand", "fuel_type"], "n_models")
    brand = groupings.distinct_counts(bitmaps, ["brand"], "n_models").withColumn("fuel_type", none)
    every = groupings.distinct_counts(bitmaps, [], "n_models").withColumns({"brand": none, "fuel_type": none})
    return fine.unionByName(brand).unionByName(every)


def _crawls(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two crawls of the same listings: some are gone, some new, some have another number of copies."""
    rows = D.keyed_listings(spark, sf).select("l_orderkey", "brand", "style", "fuel_type", "displacement")
    key = F.col("l_orderkey")
    old = rows.filter(key % 7 != 0).drop("l_orderkey")
    new = rows.filter(key % 5 != 0).drop("l_orderkey")
    return old, new


@query
def g3_crawl_difference(spark, sf):
    """How many copies of each listing came, went and stayed between two crawls."""
    return groupings.multiset_difference(*_crawls(spark, sf))


@query
def g3_except_all(spark, sf):
    return groupings.except_all(*_crawls(spark, sf))


@query
def g3_intersect_all(spark, sf):
    return groupings.intersect_all(*_crawls(spark, sf))


@query
def i1_incremental_stats(spark, sf):
    """Statistics from a stored state of older listings and two later batches, one after the other."""
    typed = D.typed_listings(spark, sf)
    year = F.coalesce(F.year("post_date"), F.lit(1997))
    folder = f"{shared_dir(spark)}/state-{uuid.uuid4().hex}"
    incremental.state(typed.filter(year < 1997)).write.parquet(f"{folder}/0")
    incremental.advance(f"{folder}/0", typed.filter(year == 1997), f"{folder}/1")
    return incremental.brand_summary(incremental.advance(f"{folder}/1", typed.filter(year > 1997), f"{folder}/2"))


@query
def i2_frequent_pairs(spark, sf):
    """Brand and model pairs that make up more than 0.1 % of the listings."""
    return incremental.frequent(D.raw_listings(spark, sf), ["brand", "model"], 0.001)


def _stored_cells(spark: SparkSession, cells: DataFrame) -> str:
    name = f"cells_{uuid.uuid4().hex}"
    clustered.write_clustered(cells, name, f"{shared_dir(configure(spark))}/{name}", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return name


@query
def k7_clustered_get(spark, sf):
    """The rows that were deleted at some time, read by key from cells stored in buckets."""
    name = _stored_cells(spark, D.hot_cells(spark, sf))
    return clustered.multi_get(spark, name, _deleted_rows(spark, sf).withColumn("tbl", F.lit("activity"))).select(*CELL, "ts", "seq", "value")


def _props(spark: SparkSession, sf: str) -> DataFrame:
    """Properties of events as JSON text: nested, some broken off, some of other types."""
    n, number = F.col("event_id"), F.regexp_extract("props", "([0-9]+)", 1)
    user = F.col("user_id").cast("string")
    nested = F.concat(F.lit('{"k": '), number, F.lit(', "who": {"id": '), user, F.lit(', "tags": ["t'), number, F.lit('", "x"]}}'))
    text = (
        F.when(n % 97 == 0, F.substring(nested, 1, 9))
        .when(n % 89 == 0, F.concat(F.lit('{"k": "many", "who": {"id": '), user, F.lit("}}")))
        .when(n % 83 == 0, F.lit('{"k": null}'))
        .when(n % 79 == 0, F.lit(None))
        .otherwise(nested)
    )
    return D.table(spark, sf, "events").select("event_id", text.alias("props"))


@query
def v1_shredded_props(spark, sf):
    """Properties as typed columns, with the reason why some don't fit."""
    fields = {"k": ("$.k", "bigint"), "user_id": ("$.who.id", "bigint"), "tag": ("$.who.tags[0]", "string")}
    return shredded.shredded(_props(spark, sf), "props", fields)
