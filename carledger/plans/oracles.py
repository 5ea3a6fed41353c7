"""The registered queries as SQL for another engine, over the same tables. Checks only; nothing here runs on Spark."""

from __future__ import annotations

from carledger.functions.text import BLANKS, NBSP
from carledger.operators.extract import PROFILE_FIELDS
from carledger.schema import CLEAN_COLUMNS, RAW_COLUMNS

AS_OF = "DATE '2025-04-17'"
MID_JANUARY = 1705276800000000
END_JANUARY = 1706659200000000
DAY = 86400000000

_WAN = "(({0}) // 1000000)::VARCHAR || '.' || lpad(((({0}) // 10000) % 100)::VARCHAR, 2, '0') || '万'"
_PICK = "CASE p_size % 3 WHEN 0 THEN '{}' WHEN 1 THEN '{}' ELSE '{}' END"

LISTING = f"""
base AS (
  SELECT *, round(l_extendedprice * 100)::BIGINT AS cents
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
listing AS (
  SELECT l_orderkey, l_partkey, l_linenumber,
    p_brand AS brand,
    CASE WHEN l_partkey % 11 = 0 THEN 'Classic' ELSE (1995 + l_partkey % 25)::VARCHAR || '款' END AS style,
    p_name AS model,
    CASE WHEN l_orderkey % 97 = 0 THEN '0.00万' ELSE {_WAN.format("cents")} END AS current_price,
    {_WAN.format("cents + (l_partkey % 50 + 1) * 100000")} AS new_price,
    CASE WHEN p_size % 5 = 0 THEN '电动' ELSE '汽油' END AS fuel_type,
    CASE WHEN l_orderkey % 101 = 0 THEN '未上牌' ELSE strftime(l_shipdate, '%Y年%m月') END AS reg_time,
    CASE WHEN l_orderkey % 89 = 0 THEN '未知'
         ELSE l_quantity::INT::VARCHAR || '.' || (l_partkey % 10)::VARCHAR || '万公里' END AS mileage,
    {_PICK.format("自动", "手动", "双离合")} AS gearbox,
    CASE WHEN p_size % 5 = 0 AND l_partkey % 4 = 1 THEN ' ' WHEN p_size % 5 = 0 AND l_partkey % 4 = 2 THEN 'nan'
         WHEN p_size % 5 <> 0 THEN (1 + p_size % 3)::VARCHAR || '.' || (p_size % 10)::VARCHAR || 'L' END AS displacement,
    strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') AS post_time,
    {_PICK.format("2026-03", "2026-09", "2027-01")} AS inspect_due,
    {_PICK.format("2026-02", "2026-08", "2027-05")} AS insurance_due,
    (l_linenumber - 1)::VARCHAR || '次' AS transfer_count,
    n_name AS location,
    CASE WHEN l_partkey % 53 = 0 THEN '发动机'
         ELSE '2.0L ' || (80 + p_size * 3)::VARCHAR || '马力 L' || (3 + p_size % 4)::VARCHAR END AS engine,
    CASE WHEN l_suppkey % 17 = 0 THEN '' WHEN l_suppkey % 19 = 0 THEN '{NBSP}' WHEN l_suppkey % 23 = 0 THEN 'nan' ELSE p_type END AS level,
    CASE WHEN l_orderkey % 83 = 0 THEN 'nan' ELSE {_PICK.format("黑", "白", "灰")} END AS color,
    {_PICK.format("前驱", "后驱", "四驱")} AS drive_mode,
    n_name AS province
  FROM base
), raw AS (
  SELECT * FROM listing UNION ALL SELECT * FROM listing WHERE l_orderkey % 100 = 0
)"""

_FIRST_COLUMNS = {
    "current_price": "replace(current_price, '万', '')",
    "new_price": "replace(new_price, '万', '')",
    "reg_time": "replace(replace(reg_time, '年', '-'), '月', '')",
    "mileage": "replace(mileage, '公里', '')",
    "displacement": "replace(displacement, 'L', '')",
    "transfer_count": "regexp_replace(transfer_count, '[^0-9]', '', 'g')",
    "engine": "string_split(engine, ' ')[3]",
    "horsepower": "replace(string_split(engine, ' ')[2], '马力', '')",
}
_FIRST = ", ".join(f"{_FIRST_COLUMNS[c]} AS {c}" if c in _FIRST_COLUMNS else c for c in CLEAN_COLUMNS)
_BLANK = "lower(trim({}, '" + BLANKS + "')) IN ('', 'nan')"
_ELECTRIC = f"(fuel_type = '电动' AND (displacement IS NULL OR {_BLANK.format('displacement')}))"
_COMPLETE = " AND ".join(f"{c} IS NOT NULL AND NOT {_BLANK.format(c)}" for c in CLEAN_COLUMNS)
_PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in CLEAN_COLUMNS)
_COLS = ", ".join(CLEAN_COLUMNS)

FIRST = f"{LISTING}, first_pass AS (SELECT {_FIRST} FROM raw WHERE NOT {_BLANK.format('level')})"
MARKED = f"""{FIRST}, marked AS (
  SELECT * REPLACE (replace(mileage, '万', '') AS mileage) FROM first_pass WHERE contains(style, '款')
)"""
CLEAN = f"""{MARKED}, clean AS (
  SELECT DISTINCT * FROM marked WHERE NOT {_ELECTRIC} AND {_COMPLETE}
  UNION ALL SELECT * FROM marked WHERE {_ELECTRIC}
)"""
_AGE = "(date_diff('day', {}, " + AS_OF + ") / 365.0::DOUBLE)::FLOAT"
TYPED = f"""{CLEAN}, typed AS (
  SELECT *, {_AGE.format("reg_date")} AS car_age, date_diff('day', post_date, {AS_OF})::INT AS publish_days
  FROM (SELECT brand, fuel_type, reg_time, post_time, try_cast(current_price AS FLOAT) AS price,
          try_cast(new_price AS FLOAT) AS new_price, try_cast(mileage AS FLOAT) AS mileage,
          try_cast(transfer_count AS INT) AS transfer_count, try_cast(reg_time || '-01' AS DATE) AS reg_date,
          try_cast(post_time AS DATE) AS post_date
        FROM clean)
)"""

A2 = f"""{TYPED}, a2 AS (
  SELECT row_number() OVER (ORDER BY avg_price DESC NULLS LAST, brand) AS id, brand, avg_price
  FROM (SELECT brand, avg(price) AS avg_price FROM typed GROUP BY brand)
)"""
A4 = f"""{TYPED}, a4 AS (
  SELECT row_number() OVER (ORDER BY brand, car_age) AS id, brand, car_age, avg_price
  FROM (SELECT brand, car_age, avg(price) AS avg_price FROM typed WHERE reg_date IS NOT NULL AND price > 0
        GROUP BY brand, car_age)
)"""
_STATS = f"""{TYPED}, a1 AS (
  SELECT row_number() OVER (ORDER BY fuel_type) AS id, fuel_type, count
  FROM (SELECT fuel_type, count(*) AS count FROM clean WHERE fuel_type IN ('汽油', '电动') GROUP BY fuel_type)
), a5 AS (
  SELECT row_number() OVER (ORDER BY brand, transfer_count) AS id, *
  FROM (SELECT brand, transfer_count, min(price) AS min_price, quantile_disc(price, 0.25) AS q1_price,
          quantile_disc(price, 0.5) AS median_price, quantile_disc(price, 0.75) AS q3_price, max(price) AS max_price
        FROM typed WHERE price > 0 AND transfer_count IS NOT NULL GROUP BY brand, transfer_count)
), a6 AS (
  SELECT row_number() OVER (ORDER BY brand, mileage) AS id, brand, mileage, avg_price
  FROM (SELECT brand, mileage, avg(price) AS avg_price FROM typed WHERE price > 0 AND mileage IS NOT NULL
        GROUP BY brand, mileage)
), a7 AS (
  SELECT row_number() OVER (ORDER BY brand) AS id, *, (avg_new_price - avg_current_price) / avg_new_price * 100
         AS price_drop_percent
  FROM (SELECT brand, avg(new_price) AS avg_new_price, avg(price) AS avg_current_price
        FROM typed WHERE new_price > 0 AND price > 0 GROUP BY brand)
)"""


def _cells(table: str, cte: str, columns: dict[str, str]) -> str:
    """Cells of a statistics table: `columns` maps a name to its stored type."""
    shown = {"FLOAT": "{}::FLOAT::DOUBLE::VARCHAR", "INT": "{}::INT::VARCHAR", "VARCHAR": "{}"}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS tbl, coalesce(id::VARCHAR, 'unknown_key') AS row_key, 'cf' AS family, '{name}' AS qualifier, "
        f"0::BIGINT AS ts, coalesce({shown[kind].format(name)}, 'None') AS value FROM {cte}"
        for name, kind in columns.items()
    )


_K2 = " UNION ALL ".join(
    [
        _cells("car_brand_mileage_price_avg", "a6", {"brand": "VARCHAR", "mileage": "FLOAT", "avg_price": "FLOAT"}),
        _cells(
            "car_brand_price_stats",
            "a7",
            {
                "brand": "VARCHAR",
                "avg_new_price": "FLOAT",
                "avg_current_price": "FLOAT",
                "price_drop_percent": "FLOAT",
            },
        ),
        _cells(
            "car_brand_transfer_price_stats",
            "a5",
            {
                "brand": "VARCHAR",
                "transfer_count": "INT",
                "min_price": "FLOAT",
                "q1_price": "FLOAT",
                "median_price": "FLOAT",
                "q3_price": "FLOAT",
                "max_price": "FLOAT",
            },
        ),
        _cells("fuel_type_stats", "a1", {"fuel_type": "VARCHAR", "count": "INT"}),
    ]
)

# -- pages --------------------------------------------------------------------------------------------------------

_TITLE = """CASE WHEN l_orderkey % 107 = 0 THEN ' ' WHEN l_partkey % 17 = 0 THEN ' ' || brand
  ELSE brand || '  ' || style || '&nbsp;' || model || ' &amp; co' END"""


def _item(name: str, value: str) -> str:
    return f"'<li><span class=\"item-name\">{name}</span>' || {value} || '</li>'"


PAGES = f"""{LISTING}, page AS (
  SELECT row_number() OVER () AS pid, '/lot/' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '.html' AS url,
    '<html><body>' ||
    CASE WHEN l_orderkey % 103 = 0 THEN '' ELSE '<div class="bread-crumbs"><p class="content"><a href="/">home</a> <a href="/x">'
      || {_TITLE} || '</a></p></div>' END ||
    '<div class="car-box">' ||
    CASE WHEN l_orderkey % 103 = 0 OR l_partkey % 7 = 0 THEN '' ELSE '<h3 class="car-brand-name top">' || {_TITLE} || '</h3>' END ||
    '<p class="brand-price-item">' ||
    CASE WHEN l_orderkey % 109 = 0 OR l_partkey % 13 = 0 THEN '' ELSE '<span class="price">￥' || current_price || '</span>' END ||
    CASE WHEN l_partkey % 5 = 0 THEN '' WHEN l_partkey % 3 = 0 THEN '<i class="price-nom">' || new_price || '</i>'
         ELSE '<i class="price-nom">新车含税价：' || new_price || ' </i>' END ||
    '</p></div>' ||
    CASE WHEN l_orderkey % 109 <> 0 AND l_partkey % 13 = 0
      THEN '<div class="cxc-priceCard"><p class="left-module"><em class="goodstartmoney"><b>¥</b> ' || current_price || '</em></p></div>'
      ELSE '' END ||
    '<div class="all-basic-content"><ul class="basic-item-ul">' ||
    {_item("上牌&nbsp;时间：", "reg_time")} ||
    CASE WHEN fuel_type = '电动' THEN '' ELSE {_item("燃油标号", "'92号'")} END ||
    {_item("表显里程：", "' ' || mileage || ' '")} ||
    {_item("变速箱", "'<b>' || gearbox || '</b>'")} ||
    {_item("排量", "coalesce(displacement, '')")} ||
    {_item("发布时间：", "post_time")} ||
    '</ul><ul class="basic-item-ul more"><li>备注</li>' ||
    {_item("年检到期", "inspect_due")} ||
    {_item("保险到期", "insurance_due")} ||
    {_item("过户次数", "transfer_count")} ||
    {_item("所在地", "location || '所在地'")} ||
    {_item("车身颜色", "'旧色'")} ||
    {_item("发动机", "engine")} ||
    {_item("车辆级别", "level")} ||
    {_item("车身颜色", "color")} ||
    {_item("驱动方式", "drive_mode")} ||
    '</ul></div></body></html>' AS html
  FROM listing
)"""


def _found(pattern: str) -> str:
    return f"CASE WHEN regexp_matches(html, '{pattern}') THEN regexp_extract(html, '{pattern}', 1) END"


_STRIPPED = "trim({}, '" + BLANKS + "')"
PARTS = f"""{PAGES}, parts AS (
  SELECT pid, url,
    replace(replace(coalesce({_found('<h3 class="car-brand-name top">(.*?)</h3>')}, {_found('<a href="/x">(.*?)</a>')}),
      '&nbsp;', '{NBSP}'), '&amp;', '&') AS title,
    regexp_replace(coalesce({_found('<span class="price">(.*?)</span>')}, {_found('<em class="goodstartmoney">(.*?)</em>')}),
      ' *<[^>]*> *', '', 'g') AS price,
    {_STRIPPED.format(_found('<i class="price-nom">(.*?)</i>'))} AS new_price
  FROM page
), tokens AS (
  SELECT *, list_filter(regexp_split_to_array(title, '[{BLANKS}]+'), lambda w: w <> '') AS words FROM parts
)"""
_BRAND = "words[1] AS brand, coalesce(words[2], '') AS style, coalesce(array_to_string(words[3:], ' '), '') AS model"
_PRICE = "regexp_replace(price, '[万￥¥]', '', 'g') || '万'"
_NEW = (
    "coalesce(" + _STRIPPED.format("coalesce(regexp_split_to_array(new_price, '[:：]')[2], "
    "regexp_split_to_array(new_price, '[:：]')[1])") + ", '')"
)
_REASON = f"""CASE WHEN title IS NULL THEN 'no title' WHEN {_STRIPPED.format("title")} = '' THEN 'empty title'
  WHEN price IS NULL THEN 'no price' END"""

_ENTRIES = f"""item AS (
  SELECT pid, url, unnest(items) AS li, generate_subscripts(items, 1) AS nth
  FROM (SELECT pid, url, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS items FROM page)
), named AS (
  SELECT pid, url, nth, regexp_extract(li, '<span class="item-name">(.*?)</span>', 1) AS name,
    regexp_replace(li, '<[^>]*>', '', 'g') AS body
  FROM item WHERE contains(li, 'item-name')
), entry AS (
  SELECT pid, url, nth, replace(replace(replace(name, '&nbsp;', ''), '：', ''), ' ', '') AS key,
    {_STRIPPED.format("replace(body, name, '')")} AS value
  FROM named
), profile AS (
  SELECT pid, url, key, arg_max(value, nth) AS value FROM entry WHERE key <> '' AND value <> '' GROUP BY pid, url, key
)"""
_PIVOT = ", ".join(
    f"coalesce(max(value) FILTER (key = '{key}'), '') AS {name}" for key, name in PROFILE_FIELDS.items()
)
_FUEL = "CASE WHEN count(*) FILTER (key = '燃油标号') > 0 THEN '汽油' ELSE '电动' END AS fuel_type"
_RAW_ORDER = ", ".join(RAW_COLUMNS)

# -- cells --------------------------------------------------------------------------------------------------------

LOG = """log AS (
  SELECT 'activity' AS tbl, 'u' || lpad(user_id::VARCHAR, 9, '0') AS row_key, 'cf' AS family, event_type AS qualifier,
    epoch_us(ts) AS ts, event_id AS seq,
    CASE WHEN event_id % 101 = 0 THEN 'delete_row' WHEN event_id % 17 = 0 THEN 'delete_cell' ELSE 'put' END AS op,
    round(value * 100)::BIGINT::VARCHAR AS value
  FROM events
), cells AS (SELECT * EXCLUDE (op) FROM log WHERE op = 'put'),
day_cells AS (SELECT * REPLACE (ts - ts % 86400000000 AS ts) FROM cells),
gone AS (SELECT DISTINCT row_key FROM log WHERE op = 'delete_row')"""
_CELL = "tbl, row_key, family, qualifier"
_LATEST = f"SELECT {_CELL}, max(ts) AS ts, arg_max(value, row(ts, seq)) AS value FROM {{}} GROUP BY {_CELL}"
_VISIBLE = """{0} AS (
  SELECT * EXCLUDE (op) FROM {1} p WHERE op = 'put'
    AND NOT EXISTS (SELECT 1 FROM {1} d WHERE d.op = 'delete_cell' AND d.tbl = p.tbl AND d.row_key = p.row_key
                    AND d.family = p.family AND d.qualifier = p.qualifier AND d.ts >= p.ts)
    AND NOT EXISTS (SELECT 1 FROM {1} d WHERE d.op = 'delete_family' AND d.tbl = p.tbl AND d.row_key = p.row_key
                    AND d.family = p.family AND d.ts >= p.ts)
    AND NOT EXISTS (SELECT 1 FROM {1} d WHERE d.op = 'delete_row' AND d.tbl = p.tbl AND d.row_key = p.row_key AND d.ts >= p.ts)
)"""


def _order_puts(columns: list[tuple[str, str, str]], where: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT 'customer' AS tbl, o_custkey::VARCHAR AS row_key, '{family}' AS family, '{qualifier}' AS qualifier,
        o_orderkey AS ts, o_orderkey AS seq, 'put' AS op, {value} AS value FROM orders {where}"""
        for family, qualifier, value in columns
    )


_STATUS, _PRIORITY = ("cf", "status", "o_orderstatus"), ("cf", "priority", "o_orderpriority")
_CLERKS = [("meta", "by:clerk", "o_orderstatus"), ("meta", "at:clerk", "o_orderpriority")]
_ORDER_LOG = f"""order_log AS ({_order_puts([_STATUS, _PRIORITY, *_CLERKS], "WHERE o_orderkey % 37 <> 0")}
  UNION ALL SELECT 'customer', o_custkey::VARCHAR, 'cf', 'priority', o_orderkey, o_orderkey, 'delete_cell', NULL
  FROM orders WHERE o_orderkey % 37 <> 0 AND o_orderkey % 23 <> 0 AND o_orderkey % 10 = 0
  UNION ALL SELECT 'customer', o_custkey::VARCHAR, 'meta', NULL, o_orderkey, o_orderkey, 'delete_family', NULL
  FROM orders WHERE o_orderkey % 37 <> 0 AND o_orderkey % 23 = 0
  UNION ALL SELECT 'customer', o_custkey::VARCHAR, NULL, NULL, o_orderkey, o_orderkey, 'delete_row', NULL
  FROM orders WHERE o_orderkey % 37 = 0
)"""
_HOT = """hot AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'hot' ELSE row_key END AS row_key) FROM cells)"""
_STEPS = f"""steps AS (
  SELECT {_CELL}, seq, value::BIGINT AS amount, sum(value::BIGINT) OVER (PARTITION BY {_CELL} ORDER BY seq)
    + CASE WHEN qualifier = 'click' THEN 100 ELSE 0 END AS value
  FROM cells
)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


_EVENTS = """ev AS (
  SELECT event_id, (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END)::BIGINT AS user_id, epoch_us(ts) AS at, event_type,
    round(value * 100)::BIGINT AS cents FROM events)"""
_VISITS = """visits AS (
  SELECT o_custkey % 150 AS user_id, 1704067200000000 + o_orderkey * 173 % 2592000 * 1000000 + o_orderkey % 1000000 AS at,
    o_orderkey, o_orderstatus FROM orders)"""
_PRICES = """prices AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE p_brand END AS brand, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) AS day,
    l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * 100)::BIGINT AS cents FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_ARRIVALS = f"""{LOG}, arrived AS (SELECT * REPLACE (seq * 613 % 10007 * 1000000000 + seq AS seq) FROM cells),
living AS (SELECT * FROM arrived WHERE ts >= (SELECT max(ts) FROM arrived) - {(3600 + 10 * 86400) * 1000000})"""
_CRAWLS = f"""{LISTING}, old AS (SELECT brand, style, fuel_type, displacement FROM listing WHERE l_orderkey % 7 <> 0),
new AS (SELECT brand, style, fuel_type, displacement FROM listing WHERE l_orderkey % 5 <> 0)"""

ORACLES: dict[str, str] = {
    "s1_scan_by_province": _with(
        LISTING,
        "SELECT province, count(*) AS listings, count(displacement) AS with_displacement FROM raw GROUP BY province",
    ),
    "s1_read_listings": _with(
        LISTING,
        "SELECT replace(province, '_', '-') AS province, count(*) AS listings, count(style) AS with_style FROM raw GROUP BY ALL",
    ),
    "s4_load_listings": _with(CLEAN, f"SELECT {_COLS} FROM clean"),
    "s7_write_listings": _with(CLEAN, f"SELECT {_COLS} FROM clean"),
    "s5_store_cast": _with(A2, "SELECT id::INT AS id, brand, avg_price::FLOAT AS avg_price FROM a2"),
    "s8_frontier": """SELECT n_name AS name, page::INT AS page,
        'https://listings.invalid/' || lower(n_name) || '/list?a=1&page=' || page AS url
        FROM nation, range(1, 101) r(page)""",
    "e1_links": """SELECT page_id, (nth - 1)::INT AS pos, 'https://listings.invalid' || replace(href, '&amp;', '&') AS link
        FROM (SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) AS nth
              FROM (SELECT page_id, list_filter(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1),
                                                lambda x: x <> '') AS h FROM pages))""",
    "e1_card_links": """SELECT p_partkey AS page_id, pos, 'https://listings.invalid/lot/' || p_partkey || tail AS link
        FROM part, (VALUES (0, '.html?a=1&b=2'), (1, '.html'), (2, '.html'), (3, '.éA?x=1&copy=2')) t(pos, tail)""",
    "e1_page_links": """SELECT p_partkey AS page_id, pos, 'https://listings.invalid' || replace(link, '#', p_partkey::VARCHAR) AS link
        FROM part, (VALUES (0, '/top'), (1, '/lot/#.html?a=1&b=2'), (2, '/lot/#.html'), (3, '/ad'), (4, '/lot/#.html'),
                           (5, '/lot/#.éA?x=1&copy=2')) t(pos, link)""",
    "e2_profile_kv": _with(f"{PAGES}, {_ENTRIES}", "SELECT url, key, value FROM profile"),
    "e3_title_split": _with(
        PARTS, f"SELECT url, {_BRAND} FROM tokens WHERE {_STRIPPED.format('title')} <> ''"
    ),
    "e4_price_text": _with(PARTS, f"SELECT url, {_PRICE} AS current_price FROM parts WHERE price IS NOT NULL"),
    "e5_new_price_text": _with(PARTS, f"SELECT url, {_NEW} AS new_price FROM parts"),
    "e6_fuel_type": _with(f"{PAGES}, {_ENTRIES}", f"SELECT url, {_FUEL} FROM profile GROUP BY pid, url"),
    "e7_fallback": _with(PARTS, "SELECT url, title, price FROM parts"),
    "e8_profile_pivot": _with(f"{PAGES}, {_ENTRIES}", f"SELECT url, {_PIVOT} FROM profile GROUP BY pid, url"),
    "e9_rejects": _with(PARTS, f"SELECT url, reason FROM (SELECT url, {_REASON} AS reason FROM parts) WHERE reason IS NOT NULL"),
    "e9_listings": _with(
        f"{PARTS}, {_ENTRIES}, wide AS (SELECT pid, {_FUEL}, {_PIVOT} FROM profile GROUP BY pid)",
        f"""SELECT url, {_RAW_ORDER} FROM (SELECT pid, url, {_BRAND}, {_PRICE} AS current_price, {_NEW} AS new_price
            FROM tokens WHERE {_REASON} IS NULL) JOIN wide USING (pid)""",
    ),
    "c1_strip_units": _with(
        LISTING,
        "SELECT brand, model, "
        + ", ".join(f"{_FIRST_COLUMNS[c]} AS {c}" for c in ("current_price", "new_price", "mileage", "displacement"))
        + " FROM raw",
    ),
    "c2_reg_month": _with(LISTING, f"SELECT brand, model, {_FIRST_COLUMNS['reg_time']} AS reg_time FROM raw"),
    "c3_digits_only": _with(
        LISTING, f"SELECT brand, model, {_FIRST_COLUMNS['transfer_count']} AS transfer_count FROM raw"
    ),
    "c4_engine_split": _with(
        LISTING,
        f"SELECT brand, model, {_FIRST_COLUMNS['horsepower']} AS horsepower, {_FIRST_COLUMNS['engine']} AS engine FROM raw",
    ),
    "c5_drop_blank_level": _with(LISTING, f"SELECT brand, model, level FROM raw WHERE NOT {_BLANK.format('level')}"),
    "c6_union_by_name": _with(
        LISTING,
        """SELECT brand, model, fuel_type, province FROM raw WHERE fuel_type = '汽油'
           UNION ALL SELECT brand, model, fuel_type, province FROM raw WHERE fuel_type <> '汽油'""",
    ),
    "c7_project21": _with(FIRST, f"SELECT {_COLS} FROM first_pass"),
    "c8_style_contains": _with(FIRST, "SELECT brand, style, model FROM first_pass WHERE contains(style, '款')"),
    "c9_mileage_wan": _with(FIRST, "SELECT brand, model, replace(mileage, '万', '') AS mileage FROM first_pass"),
    "c10_electric_null_disp": _with(FIRST, f"SELECT {_COLS} FROM first_pass WHERE {_ELECTRIC}"),
    "c11_subtract": _with(
        FIRST, f"SELECT * FROM first_pass EXCEPT SELECT * FROM first_pass WHERE {_ELECTRIC}"
    ),
    "c12_dropna_any": _with(FIRST, f"SELECT * FROM first_pass WHERE {_COMPLETE}"),
    "c13_clean_full": _with(CLEAN, "SELECT * FROM clean"),
    "c13_clean_literal": _with(
        f"{LISTING}, first_pass AS (SELECT {_FIRST} FROM raw WHERE trim(level, ' ') <> '')"
        + MARKED[len(FIRST) :],
        f"""SELECT DISTINCT * FROM marked WHERE NOT (fuel_type = '电动' AND (displacement IS NULL OR lower(trim(displacement, ' ')) = 'nan'))
            AND {_PRESENT}
            UNION ALL SELECT * FROM marked WHERE fuel_type = '电动' AND (displacement IS NULL OR lower(trim(displacement, ' ')) = 'nan')""",
    ),
    "c14_stage_counts": _with(
        CLEAN,
        """SELECT 'raw' AS stage, count(*) AS n FROM raw UNION ALL SELECT 'with_level', count(*) FROM first_pass
           UNION ALL SELECT 'with_style', count(*) FROM marked UNION ALL SELECT 'clean', count(*) FROM clean""",
    ),
    "c15_progress": _with(FIRST, "SELECT brand, model, province FROM first_pass"),
    "c16_valid_rows": _with(
        TYPED,
        """SELECT brand, price, new_price, mileage FROM typed WHERE fuel_type IN ('汽油', '电动') AND price > 0
           AND new_price > 0 AND mileage IS NOT NULL""",
    ),
    "c17_try_casts": _with(
        FIRST,
        """SELECT brand, try_cast(current_price AS FLOAT) AS price, try_cast(replace(mileage, '万', '') AS FLOAT) AS mileage,
             try_cast(transfer_count AS INT) AS transfer_count, try_cast(horsepower AS INT) AS horsepower,
             try_cast(reg_time || '-01' AS DATE) AS reg_date, try_cast(post_time AS DATE) AS post_date FROM first_pass""",
    ),
    "c18_age_days": _with(TYPED, "SELECT brand, car_age, publish_days FROM typed"),
    "a1_fuel_type_stats": _with(_STATS, "SELECT * FROM a1"),
    "a2_brand_avg_price": _with(A2, "SELECT * FROM a2"),
    "a3_brand_stats": _with(
        CLEAN,
        """SELECT row_number() OVER (ORDER BY count DESC, brand) AS id, brand, count
           FROM (SELECT brand, count(*) AS count FROM clean GROUP BY brand)""",
    ),
    "a4_brand_age_price": _with(A4, "SELECT * FROM a4"),
    "a5_brand_transfer_quartiles": _with(_STATS, "SELECT * FROM a5"),
    "a5_brand_transfer_sketch": _with(_STATS, "SELECT * FROM a5"),
    "a6_brand_mileage_price": _with(_STATS, "SELECT * FROM a6"),
    "a7_brand_price_drop": _with(_STATS, "SELECT * FROM a7"),
    "a8_brand_mileage_age_days": _with(
        TYPED,
        """SELECT row_number() OVER (ORDER BY brand, mileage_float, car_age NULLS FIRST) AS id, *
           FROM (SELECT brand, mileage AS mileage_float, car_age, round(avg(publish_days))::INT AS avg_publish_days
                 FROM typed WHERE reg_time IS NOT NULL AND post_time IS NOT NULL AND mileage IS NOT NULL
                 GROUP BY brand, mileage, car_age)""",
    ),
    "a9_row_id": """SELECT row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS id, o_orderkey,
        o_orderpriority, o_totalprice FROM orders""",
    "a10_order_by": _with(CLEAN, "SELECT brand, count(*) AS count FROM clean GROUP BY brand ORDER BY count DESC, brand"),
    "k1_to_cells": _with(
        A4, _cells("car_brand_age_price_avg", "a4", {"brand": "VARCHAR", "car_age": "FLOAT", "avg_price": "FLOAT"})
    ),
    "k2_publish_tables": _with(_STATS, _K2),
    "k4_put": _with(
        f"puts AS ({_order_puts([_STATUS, _PRIORITY, ('cf', 'a:b', 'o_orderstatus')])})", _LATEST.format("puts")
    ),
    "k5_batch_mutate": _with(f"{_ORDER_LOG}, {_VISIBLE.format('shown', 'order_log')}", _LATEST.format("shown")),
    "k6_latest": _with(f"{LOG}, {_VISIBLE.format('shown', 'log')}", _LATEST.format("shown")),
    "k7_multi_get": _with(
        LOG,
        _LATEST.format("(SELECT * FROM cells WHERE qualifier IN ('click', 'view') AND row_key IN (FROM gone))"),
    ),
    "k8_apply_deletes": _with(f"{LOG}, {_VISIBLE.format('shown', 'log')}", "SELECT * FROM shown"),
    "k9_versions": _with(
        LOG,
        f"""SELECT * FROM cells WHERE ts <= {MID_JANUARY}
            QUALIFY row_number() OVER (PARTITION BY {_CELL} ORDER BY ts DESC, seq DESC) <= 3""",
    ),
    "k9_many_versions": _with(
        f"{LOG}, {_HOT}",
        f"SELECT * FROM hot QUALIFY row_number() OVER (PARTITION BY {_CELL} ORDER BY ts DESC, seq DESC) <= 50",
    ),
    "k9_day_versions": _with(
        LOG,
        f"SELECT * FROM day_cells QUALIFY row_number() OVER (PARTITION BY {_CELL} ORDER BY ts DESC, seq DESC) <= 4",
    ),
    "k8_replay": """WITH RECURSIVE op AS (
        SELECT 'u' || lpad(user_id::VARCHAR, 9, '0') AS row_key, event_id AS seq,
          CASE WHEN event_id % 101 = 0 OR event_id % 103 = 0 OR event_id % 29 = 0 THEN 'delete'
            WHEN event_id % 6 = 0 THEN 'put' WHEN event_id % 6 = 1 THEN 'append' WHEN event_id % 6 = 2 THEN 'cas'
            ELSE 'increment' END AS op,
          CASE event_id % 6 WHEN 0 THEN (event_id % 4)::VARCHAR WHEN 1 THEN CASE WHEN event_id % 5 = 0 THEN 'z' ELSE '1' END
            WHEN 2 THEN '7' ELSE (event_id % 3 + 1)::VARCHAR END AS value,
          CASE WHEN event_id % 6 = 2 AND event_id % 4 <> 0 THEN (event_id % 5)::VARCHAR END AS expected,
          row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth
        FROM events
      ), fold AS (
        SELECT row_key, 0::BIGINT AS seq, 0::BIGINT AS nth, 1 AS applied, NULL::VARCHAR AS value FROM (SELECT DISTINCT row_key FROM op)
        UNION ALL
        SELECT o.row_key, o.seq, o.nth,
          CASE o.op WHEN 'increment' THEN (try_cast(coalesce(f.value, '0') AS BIGINT) IS NOT NULL)::INT
            WHEN 'cas' THEN (f.value IS NOT DISTINCT FROM o.expected)::INT ELSE 1 END,
          CASE o.op WHEN 'delete' THEN NULL WHEN 'put' THEN o.value WHEN 'append' THEN coalesce(f.value, '') || o.value
            WHEN 'increment' THEN coalesce((try_cast(coalesce(f.value, '0') AS BIGINT) + o.value::BIGINT)::VARCHAR, f.value)
            ELSE CASE WHEN f.value IS NOT DISTINCT FROM o.expected THEN o.value ELSE f.value END END
        FROM fold f JOIN op o ON o.row_key = f.row_key AND o.nth = f.nth + 1
      ) SELECT row_key, seq, applied, value FROM fold WHERE nth > 0""",
    "k3_write_cells": _with(LOG, _LATEST.format("cells")),
    "k10_row_at": _with(
        LOG, _LATEST.format(f"(SELECT * FROM cells WHERE ts <= {MID_JANUARY} AND row_key IN (FROM gone))")
    ),
    "k10_row_exactly_at": _with(
        LOG, _LATEST.format(f"(SELECT * FROM day_cells WHERE ts = {MID_JANUARY} AND row_key IN (FROM gone))")
    ),
    "k11_retention": _with(
        LOG,
        f"""SELECT * FROM cells WHERE ts >= {END_JANUARY - 10 * DAY}
            QUALIFY row_number() OVER (PARTITION BY {_CELL} ORDER BY ts DESC, seq DESC) <= 3""",
    ),
    "k12_range_scan": _with(
        LOG, _LATEST.format("(SELECT * FROM cells WHERE row_key >= 'u000000010' AND row_key < 'u000000020')")
    ),
    "k13_prefix_scan": _with(LOG, _LATEST.format("(SELECT * FROM cells WHERE starts_with(row_key, 'u0000000'))")),
    "k14_scan_at": _with(
        LOG,
        _LATEST.format(
            f"(SELECT * FROM day_cells WHERE ts = {MID_JANUARY} AND row_key >= 'u000000010' AND row_key < 'u000000090')"
        ),
    ),
    "k15_scan_spec": _with(
        LOG,
        "SELECT * FROM ("
        + _LATEST.format(
            "(SELECT * FROM cells WHERE row_key <= 'u000000120' AND row_key > 'u000000005' AND contains(qualifier, 'i'))"
        )
        + ") WHERE value::BIGINT > 1000",
    ),
    "k16_scan_limit": _with(
        f"""{LOG}, {_ORDER_LOG}, {_VISIBLE.format('shown', 'order_log')},
        both_tables AS (SELECT * FROM cells UNION ALL SELECT * FROM shown)""",
        _LATEST.format(
            "(SELECT * FROM both_tables WHERE row_key >= '5' QUALIFY dense_rank() OVER (PARTITION BY tbl ORDER BY row_key) <= 5)"
        ),
    ),
    "k17_row_result": _with(
        f"{LOG}, newest AS ({_LATEST.format('cells')})",
        """SELECT tbl, row_key, count(*)::INT AS n,
             string_agg(family || ':' || qualifier || '=' || value || '@' || ts, ';' ORDER BY family || ':' || qualifier) AS cells
           FROM newest GROUP BY tbl, row_key""",
    ),
    "k17_row_map": _with(
        f"{LOG}, newest AS ({_LATEST.format('cells')})",
        """SELECT row_key, count(*)::INT AS n, max(value) FILTER (qualifier = 'click') AS click,
             max(ts) FILTER (qualifier = 'click') AS click_ts FROM newest GROUP BY row_key""",
    ),
    "k18_increment": _with(f"{LOG}, {_STEPS}", "SELECT * REPLACE (value::BIGINT AS value) FROM steps"),
    "k18_increment_totals": _with(
        f"{LOG}, {_STEPS}", f"SELECT {_CELL}, arg_max(value, seq)::BIGINT AS value FROM steps GROUP BY {_CELL}"
    ),
    "k19_append": _with(
        LOG,
        f"""SELECT {_CELL}, string_agg(value, '' ORDER BY seq) AS value
            FROM (SELECT tbl, row_key, family, 'trail' AS qualifier, seq, substr(qualifier, 1, 1) AS value FROM log
                  UNION ALL SELECT tbl, row_key, family, qualifier, seq, value || ',' FROM log)
            GROUP BY {_CELL}""",
    ),
    "k20_check_and_put": "WITH RECURSIVE "
    + LOG
    + """, request AS (
        SELECT row_key, seq, CASE WHEN seq % 7 <> 0 THEN ['click', 'view', 'error', 'purchase', 'signup'][seq % 5 + 1] END AS expected,
          qualifier AS value, row_number() OVER (PARTITION BY row_key ORDER BY seq) AS nth
        FROM log
      ), fold AS (
        SELECT row_key, seq, nth, (expected IS NULL)::INT AS applied, CASE WHEN expected IS NULL THEN value END AS now
        FROM request WHERE nth = 1
        UNION ALL
        SELECT r.row_key, r.seq, r.nth, (r.expected IS NOT DISTINCT FROM f.now)::INT,
          CASE WHEN r.expected IS NOT DISTINCT FROM f.now THEN r.value ELSE f.now END
        FROM fold f JOIN request r ON r.row_key = f.row_key AND r.nth = f.nth + 1
      ) SELECT row_key, seq, applied FROM fold""",
    "k21_catalog": _with(
        f"{LOG}, {_ORDER_LOG}", "SELECT DISTINCT tbl, family FROM (SELECT tbl, family FROM log UNION ALL SELECT tbl, family FROM order_log)"
    ),
    "k21_row_exists": _with(
        LOG,
        """SELECT 'u' || lpad(c_custkey::VARCHAR, 9, '0') AS row_key,
             ('u' || lpad(c_custkey::VARCHAR, 9, '0') IN (SELECT row_key FROM cells))::INT AS row_exists FROM customer""",
    ),
    "k10_rows_as_of": _with(
        f"""{LOG}, hot AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'hot' ELSE row_key END AS row_key) FROM cells),
        asked AS (
          SELECT o_orderkey, 'activity' AS tbl, CASE WHEN o_custkey % 7 = 0 THEN 'hot' ELSE 'u' || lpad((o_custkey % 150)::VARCHAR, 9, '0') END AS row_key,
            {MID_JANUARY - 10 * DAY} + (o_orderkey * 7919 % 20000) * 130000000 AS at FROM orders),
        wanted AS (SELECT * FROM asked JOIN (SELECT DISTINCT {_CELL} FROM hot) USING (tbl, row_key))""",
        f"""SELECT o_orderkey, w.tbl, w.row_key, w.family, w.qualifier, w.at, h.ts, h.value FROM wanted w ASOF JOIN hot h
            ON w.tbl = h.tbl AND w.row_key = h.row_key AND w.family = h.family AND w.qualifier = h.qualifier AND w.at >= h.ts""",
    ),
    "t1_asof_join": _with(
        _EVENTS + ", " + _VISITS,
        "SELECT e.*, v.o_orderkey, v.o_orderstatus FROM ev e ASOF LEFT JOIN visits v ON e.user_id = v.user_id AND e.at >= v.at",
    ),
    "t2_interval_join": _with(
        _EVENTS
        + """, market AS (
          SELECT l_suppkey AS user_id, l_orderkey, l_linenumber, 1704067200000000 + l_orderkey * 37 % 720 * 3600000000 AS posted,
            l_quantity::BIGINT * 3600000000 * CASE WHEN l_orderkey % 50 = 0 THEN 20 ELSE 1 END AS length FROM lineitem)""",
        """SELECT e.user_id, event_id, e.at, count(*) AS on_market, min(l_orderkey) AS first_order, sum(l_linenumber)::BIGINT AS lines
           FROM ev e JOIN market m ON e.user_id = m.user_id AND e.at BETWEEN posted AND posted + length GROUP BY ALL""",
    ),
    "t3_moving_price": _with(
        _PRICES + ", daily AS (SELECT brand, day, count(*) AS n, sum(cents) AS cents FROM prices GROUP BY ALL)",
        """SELECT brand, day, n, cents, cents / n / 100 AS avg_price FROM (
             SELECT brand, day, (sum(n) OVER w)::BIGINT AS n, (sum(cents) OVER w)::BIGINT AS cents FROM daily
             WINDOW w AS (PARTITION BY brand ORDER BY day RANGE BETWEEN 6 PRECEDING AND CURRENT ROW))""",
    ),
    "t3_lag_lead": _with(
        _PRICES + ", one AS (SELECT *, count(*) AS copy FROM prices GROUP BY ALL)",
        """SELECT *, lag(cents) OVER w AS before_cents, lead(cents, 2) OVER w AS after_cents FROM one
           WINDOW w AS (PARTITION BY brand ORDER BY day, l_orderkey, l_linenumber, l_partkey, cents, copy)""",
    ),
    "t4_sessions": _with(
        _EVENTS
        + """, opened AS (
          SELECT *, coalesce("at" - lag("at") OVER (PARTITION BY user_id ORDER BY "at") > 7200000000, true)::INT AS o FROM ev),
        numbered AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY "at" RANGE UNBOUNDED PRECEDING) AS s FROM opened)""",
        """SELECT user_id, min("at") AS session_start, max("at") AS session_end, count(*) AS n, sum(cents)::BIGINT AS cents
           FROM numbered GROUP BY user_id, s""",
    ),
    "t5_stream_newest": _with(
        _ARRIVALS, f"SELECT {_CELL}, max(ts) AS ts, arg_max(seq, row(ts, seq)) AS seq, arg_max(value, row(ts, seq)) AS value FROM living GROUP BY {_CELL}"
    ),
    "t5_stream_late": _with(
        _ARRIVALS,
        f"""SELECT {_CELL}, ts, seq, value FROM living
            QUALIFY max(ts) OVER (PARTITION BY {_CELL} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > ts""",
    ),
    "g1_cube": _with(
        CLEAN,
        """SELECT province, brand, fuel_type, grouping_id(province, brand, fuel_type)::INTEGER AS level, count(*) AS listings,
             sum(TRY_CAST(transfer_count AS INTEGER))::BIGINT AS transfers FROM clean GROUP BY CUBE (province, brand, fuel_type)""",
    ),
    "g1_grouping_sets": _with(
        f"{LISTING}, named AS (SELECT province, fuel_type, nullif(brand, 'Brand#2') AS brand FROM raw)",
        """SELECT province, brand, fuel_type, grouping_id(province, brand, fuel_type)::INTEGER AS level, count(*) AS listings
           FROM named GROUP BY GROUPING SETS ((brand, fuel_type), (province), ())""",
    ),
    "g2_distinct_models": _with(
        f"{LISTING}, models AS (SELECT brand, fuel_type, concat_ws('/', model, engine, mileage) AS m FROM raw)",
        """SELECT brand, fuel_type, count(DISTINCT m) AS n_models FROM models GROUP BY brand, fuel_type
           UNION ALL SELECT brand, NULL, count(DISTINCT m) FROM models GROUP BY brand
           UNION ALL SELECT NULL, NULL, count(DISTINCT m) FROM models""",
    ),
    "g3_crawl_difference": _with(
        _CRAWLS,
        """SELECT brand, style, fuel_type, displacement, greatest(sum(i) - sum(w), 0)::BIGINT AS added, greatest(sum(w) - sum(i), 0)::BIGINT AS gone,
             least(sum(w), sum(i))::BIGINT AS kept
           FROM (SELECT *, 1 AS w, 0 AS i FROM old UNION ALL SELECT *, 0, 1 FROM new) GROUP BY brand, style, fuel_type, displacement""",
    ),
    "g3_except_all": _with(_CRAWLS, "SELECT * FROM old EXCEPT ALL SELECT * FROM new"),
    "g3_intersect_all": _with(_CRAWLS, "SELECT * FROM old INTERSECT ALL SELECT * FROM new"),
    "i1_incremental_stats": _with(
        f"""{CLEAN}, cents AS (
          SELECT brand, round(TRY_CAST(current_price AS DOUBLE) * 100)::BIGINT AS c, round(TRY_CAST(new_price AS DOUBLE) * 100)::BIGINT AS w FROM clean),
        sums AS (SELECT brand, count(*) AS listings, sum(c) / count(c) / 100 AS avg_price,
          (sum(w) FILTER (c > 0 AND w > 0)) / (count(*) FILTER (c > 0 AND w > 0)) / 100 AS avg_new_price,
          (sum(c) FILTER (c > 0 AND w > 0)) / (count(*) FILTER (c > 0 AND w > 0)) / 100 AS avg_current_price FROM cents GROUP BY brand)""",
        "SELECT *, (avg_new_price - avg_current_price) / avg_new_price * 100 AS price_drop_percent FROM sums",
    ),
    "i2_frequent_pairs": _with(
        LISTING, "SELECT brand, model, count(*) AS n FROM raw GROUP BY ALL HAVING count(*) > 0.001 * (SELECT count(*) FROM raw)"
    ),
    "k7_clustered_get": _with(
        f"{LOG}, hot AS (SELECT * REPLACE (CASE WHEN seq % 3 = 0 THEN 'hot' ELSE row_key END AS row_key) FROM cells)",
        f"SELECT {_CELL}, ts, seq, value FROM hot WHERE row_key IN (FROM gone)",
    ),
    "v1_shredded_props": """SELECT event_id,
          CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 79 <> 0 THEN regexp_extract(props, '([0-9]+)', 1)::BIGINT END AS k,
          CASE WHEN event_id % 97 <> 0 AND (event_id % 89 = 0 OR event_id % 83 <> 0 AND event_id % 79 <> 0) THEN user_id END AS user_id,
          CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0 AND event_id % 79 <> 0 THEN 't' || regexp_extract(props, '([0-9]+)', 1) END AS tag,
          CASE WHEN event_id % 97 = 0 THEN 'no json' WHEN event_id % 89 = 0 THEN 'k' END AS reason
        FROM events""",
}
