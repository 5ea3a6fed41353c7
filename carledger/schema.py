"""Column lists and schemas of the layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of a raw listing, in the order a listing is written, with the names used here.
RAW_FIELDS = {
    "品牌": "brand",
    "款式": "style",
    "型号": "model",
    "现价": "current_price",
    "新车价格": "new_price",
    "燃料类型": "fuel_type",
    "上牌时间": "reg_time",
    "表显里程": "mileage",
    "变速箱": "gearbox",
    "排量": "displacement",
    "发布时间": "post_time",
    "年检到期": "inspect_due",
    "保险到期": "insurance_due",
    "过户次数": "transfer_count",
    "所在地": "location",
    "发动机": "engine",
    "车辆级别": "level",
    "车身颜色": "color",
    "驱动方式": "drive_mode",
}

# The cleaned listing, in table order, with the column comments.
CLEAN_COMMENTS = {
    "brand": "品牌",
    "style": "款式",
    "model": "型号",
    "current_price": "现价（万）",
    "new_price": "新车价格（万）",
    "fuel_type": "燃料类型",
    "reg_time": "上牌时间",
    "mileage": "表显里程（万公里）",
    "gearbox": "变速箱",
    "displacement": "排量（L）",
    "post_time": "发布时间",
    "inspect_due": "年检到期",
    "insurance_due": "保险到期",
    "transfer_count": "过户次数",
    "location": "所在地",
    "engine": "发动机",
    "horsepower": "马力",
    "level": "车辆级别",
    "color": "车身颜色",
    "drive_mode": "驱动方式",
    "province": "省份",
}

# Words of the data.
GASOLINE = "汽油"
ELECTRIC = "电动"
WAN = "万"
KILOMETRE = "公里"
STYLE_MARK = "款"
HORSEPOWER = "马力"
FUEL_GRADE_KEY = "燃油标号"

RAW_COLUMNS = list(RAW_FIELDS.values())
CLEAN_COLUMNS = list(CLEAN_COMMENTS)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
RAW_TAGGED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS + ["province"]])

# The eight statistics tables (column, type, comment).
STAT_TABLES: dict[str, list[tuple[str, str, str]]] = {
    "fuel_type_stats": [("id", "INT", ""), ("fuel_type", "STRING", ""), ("count", "INT", "")],
    "brand_avg_price": [("id", "INT", "主键ID"), ("brand", "STRING", "品牌"), ("avg_price", "FLOAT", "平均现价（万）")],
    "brand_stats": [("id", "INT", "主键 ID"), ("brand", "STRING", "品牌"), ("count", "INT", "数量")],
    "car_brand_age_price_avg": [
        ("id", "INT", "主键 ID"),
        ("brand", "STRING", "品牌"),
        ("car_age", "FLOAT", "车龄（年）"),
        ("avg_price", "FLOAT", "平均价格（万）"),
    ],
    "car_brand_transfer_price_stats": [
        ("id", "INT", "主键 ID"),
        ("brand", "STRING", "品牌"),
        ("transfer_count", "INT", "过户次数"),
        ("min_price", "FLOAT", "最低价格"),
        ("q1_price", "FLOAT", "第一四分位数"),
        ("median_price", "FLOAT", "中位数"),
        ("q3_price", "FLOAT", "第三四分位数"),
        ("max_price", "FLOAT", "最高价格"),
    ],
    "car_brand_mileage_price_avg": [
        ("id", "INT", "主键 ID"),
        ("brand", "STRING", "品牌"),
        ("mileage", "FLOAT", "里程数（万公里）"),
        ("avg_price", "FLOAT", "平均价格（万元）"),
    ],
    "car_brand_price_stats": [
        ("id", "INT", "主键 ID"),
        ("brand", "STRING", "品牌"),
        ("avg_new_price", "FLOAT", "平均新车价（万元）"),
        ("avg_current_price", "FLOAT", "平均现价（万元）"),
        ("price_drop_percent", "FLOAT", "平均降幅（百分比）"),
    ],
    "brand_mileage_age_publish_stats": [
        ("id", "INT", "主键 ID"),
        ("brand", "STRING", "品牌"),
        ("mileage_float", "FLOAT", "里程数（万公里）"),
        ("car_age", "FLOAT", "车龄（年）"),
        ("avg_publish_days", "INT", "平均已发布天数"),
    ],
}

CELL = ["tbl", "row_key", "family", "qualifier"]
ROW = ["tbl", "row_key"]

CELL_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in CELL]
    + [T.StructField("ts", T.LongType()), T.StructField("value", T.StringType())]
)
# op: put, delete_cell, delete_row, increment, append, cas (with `expected`).
MUTATION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in CELL]
    + [
        T.StructField("ts", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
PROVINCE_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("base_url", T.StringType())])
