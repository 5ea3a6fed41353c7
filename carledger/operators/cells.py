"""Cell tables: publishing statistics as cells and reading them back.

A cell table is `tbl, row_key, family, qualifier, ts, value` (a `seq` column, where present, breaks ties between
versions of equal timestamp). Reads are DataFrame -> DataFrame.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.group import GroupedData

from carledger.functions.text import float_text
from carledger.operators.scan import running_count
from carledger.operators.timeline import asof_join
from carledger.schema import CELL, ROW
from carledger.session import cut_lineage

# Where a null id and a null value go.
UNKNOWN_KEY = "unknown_key"
NULL_TEXT = "None"

_NO_LIMIT = 0x7FFFFFFF


def cell_text(df: DataFrame, name: str) -> Column:
    """A column as cell text: floats widened to double and written shortest, null as a word."""
    c = F.col(name)
    text = float_text(c) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else c.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def to_cells(
    df: DataFrame, tbl: str, id_column: str = "id", family: str = "cf", ts: int | Column | None = None
) -> DataFrame:
    """K1: one cell for each row and column other than the id. Rows are expanded in place, nothing is dropped."""
    names = [c for c in df.columns if c != id_column]
    stamp = F.unix_millis(F.current_timestamp()) if ts is None else ts if isinstance(ts, Column) else F.lit(ts)
    keyed = df.select(
        F.lit(tbl).alias("tbl"),
        F.coalesce(F.col(id_column).cast("string"), F.lit(UNKNOWN_KEY)).alias("row_key"),
        F.lit(family).alias("family"),
        stamp.cast("bigint").alias("ts"),
        *[cell_text(df, n).alias(n) for n in names],
    )
    return keyed.unpivot(["tbl", "row_key", "family", "ts"], names, "qualifier", "value").select(
        *CELL, "ts", "value"
    )


def publish(tables: dict[str, DataFrame], chosen: list[str] | None = None, **options) -> DataFrame:
    """K2: the cells of the chosen tables (all by default)."""
    names = list(tables) if chosen is None else chosen
    return reduce(DataFrame.unionByName, [to_cells(tables[n], n, **options) for n in names])


MAX_COLUMNS = 100_000  # cells of a row that are returned or sent at once


def write_cells(cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: store cells by table, in key order, so that key ranges prune row groups on reading."""
    order = [*CELL, F.col("ts").desc()]
    (
        cells.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .partitionBy("tbl")
        .parquet(path)
    )


def upload(cells: DataFrame, put: Callable[[str, str, dict[str, str]], None], max_columns: int = MAX_COLUMNS) -> DataFrame:
    """K3: call `put(tbl, row_key, {"family:qualifier": value})` once for each row, from the executors, now; for a row of more
    than `max_columns` cells once for each part of it.

    Returns the rejected rows with the reason, stored, so that reading them sends nothing again. Of several versions of a
    cell the newest is sent. Puts carry their own timestamps, so a task that Spark retries may repeat them.
    """
    entry = F.struct(F.concat_ws(":", "family", "qualifier").alias("column"), F.col("value"))
    rows = _by_row(latest(cells), max_columns).agg(F.map_from_entries(F.collect_list(entry)).alias("columns"))

    def send(batches: Iterator) -> Iterator:
        for batch in batches:
            reasons = []
            for row in batch.itertuples(index=False):
                try:
                    put(row.tbl, row.row_key, dict(row.columns))
                    reasons.append(None)
                except Exception as error:  # noqa: BLE001 - a failed put is reported and skipped
                    reasons.append(f"{type(error).__name__}: {error}")
            out = batch[ROW].assign(reason=reasons)
            yield out[out["reason"].notna()]

    return cut_lineage(rows.mapInPandas(send, "tbl string, row_key string, reason string"))


# -- versions ---------------------------------------------------------------------------------------------------


def _newest(df: DataFrame) -> list[str]:
    return ["ts", "seq"] if "seq" in df.columns else ["ts"]


def latest(cells: DataFrame) -> DataFrame:
    """K6: the newest version of each cell. One row per cell leaves each map task, so a hot cell is no hot task."""
    return versions(cells, 1).select(*CELL, "ts", "value")


def versions(cells: DataFrame, n: int = 1, max_ts: int | None = None, spread: bool = False) -> DataFrame:
    """K9: the newest n versions of each cell, none newer than `max_ts`.

    Spark keeps n rows per cell in each map task before the shuffle (WindowGroupLimit, for n up to its threshold), so a
    cell brings n rows from each task to one. Where that is too much, for large n, `spread` counts places over range
    partitions instead, and no task sees a whole cell. The result is the same.
    """
    kept = cells if max_ts is None else cells.filter(F.col("ts") <= max_ts)
    if spread:
        ranked = running_count(kept, CELL, _newest(cells), "_place", descending=True)
    else:
        newest_first = [F.col(c).desc() for c in _newest(cells)]
        place = F.row_number().over(Window.partitionBy(*CELL).orderBy(*newest_first))
        ranked = kept.withColumn("_place", place)
    return ranked.filter(F.col("_place") <= n).drop("_place")


def rows_as_of(cells: DataFrame, requests: DataFrame, at: str) -> DataFrame:
    """K10 for a frame of requests (tbl, row_key, a time `at`, and others): the newest version of each cell of the row that isn't
    newer than the request's time, with the cell's columns, ts and value. Cells that are all newer, and rows that don't
    exist, give nothing. An as-of join by cell, so neither a row of many requests nor a cell of many versions is one task."""
    wanted = requests.join(cells.select(*CELL).distinct(), ["tbl", "row_key"])
    ties = [c for c in _newest(cells) if c != "ts"]
    versions_ = cells.select(*CELL, F.col("ts").alias(at), *ties, "ts", "value")
    return asof_join(wanted, versions_, CELL, at, ties).filter(F.col("ts").isNotNull()).drop(*ties)


def retain(
    cells: DataFrame,
    max_versions: int = 3,
    time_to_live: int = _NO_LIMIT,
    now: int | None = None,
    ts_per_second: int = 1000,
    spread: bool = False,
) -> DataFrame:
    """Versions younger than `time_to_live` seconds, at most `max_versions` of each cell (`spread` as in K9)."""
    alive = cells
    if time_to_live != _NO_LIMIT:
        clock = F.unix_millis(F.current_timestamp()) * ts_per_second / 1000 if now is None else F.lit(now)
        alive = cells.filter(F.col("ts") >= clock.cast("bigint") - time_to_live * ts_per_second)
    return versions(alive, max_versions, spread=spread)


# -- selections -------------------------------------------------------------------------------------------------


def column_filter(columns: Iterable[str] | None, regex: bool = False) -> Column:
    """Cells of the named columns: `family`, `family:qualifier`, or with `regex` `family:pattern`; None for all."""
    if columns is None:
        return F.lit(True)
    tests = [F.lit(False)]
    for column in columns:
        family, colon, qualifier = column.partition(":")
        test = F.col("family") == family
        if colon and regex and re.escape(qualifier) != qualifier:
            test &= F.col("qualifier").rlike(f"^(?:{qualifier})$")
        elif colon:
            test &= F.col("qualifier") == qualifier
        tests.append(test)
    return reduce(lambda a, b: a | b, tests)


def table_filter(tbl: str | None) -> Column:
    """Cells of one table, or of all."""
    return F.lit(True) if tbl is None else F.col("tbl") == tbl


def ts_filter(ts: int | None, mode: str = "at") -> Column:
    """Cells stored `at` a timestamp, or `as_of` it (not newer)."""
    if ts is None:
        return F.lit(True)
    if mode not in ("at", "as_of"):
        raise ValueError(f"mode must be 'at' or 'as_of', not {mode!r}")
    return F.col("ts") == ts if mode == "at" else F.col("ts") <= ts


def get_rows(
    cells: DataFrame,
    keys: DataFrame | list[str],
    columns: list[str] | None = None,
    ts: int | None = None,
    mode: str = "at",
    tbl: str | None = None,
) -> DataFrame:
    """The newest version of the chosen columns of the given rows, now or at a timestamp, in one table or all.

    A list of keys is pushed to the scan; a frame of keys (`row_key`, or `tbl` and `row_key`) is a semi join.
    """
    chosen = cells.filter(table_filter(tbl) & column_filter(columns) & ts_filter(ts, mode))
    if isinstance(keys, DataFrame):
        on = [c for c in ROW if c in keys.columns]
        chosen = chosen.join(keys.select(*on), on, "left_semi")
    else:
        chosen = chosen.filter(F.col("row_key").isin(list(keys)))
    return latest(chosen)


def scan(
    cells: DataFrame,
    start: str = "",
    stop: str | None = None,
    prefix: str | None = None,
    ts: int | None = None,
    columns: list[str] | None = None,
    predicate: str | Column | None = None,
    reverse: bool = False,
    ordered: bool = True,
    tbl: str | None = None,
) -> DataFrame:
    """Newest cells of the rows from `start` (inclusive) to `stop` (exclusive) of a table or all, in key order.

    `prefix` limits to keys with that start, `ts` to values of exactly that timestamp, `columns` may hold patterns
    for the qualifier, `predicate` is any condition on a cell. A reversed scan also starts at `start`, which is then
    the largest key.
    """
    key = F.col("row_key")
    limits = [table_filter(tbl), column_filter(columns, regex=True), ts_filter(ts)]
    if start:
        limits.append(key <= start if reverse else key >= start)
    if stop:
        limits.append(key > stop if reverse else key < stop)
    if prefix:
        limits.append(key.startswith(prefix))
    found = latest(cells.filter(reduce(lambda a, b: a & b, limits)))
    if predicate is not None:
        found = found.filter(F.expr(predicate) if isinstance(predicate, str) else predicate)
    if not ordered:
        return found
    return found.orderBy("tbl", key.desc() if reverse else key.asc(), "family", "qualifier")


def first_rows(cells: DataFrame, n: int, start: str = "", reverse: bool = False, tbl: str | None = None) -> DataFrame:
    """All cells of the first n row keys of each table, or of one, from `start` on. A top-n of keys, with n keys of a
    table in each map task, comes first; the cells then meet these keys, so they are never ranked or sorted."""
    key = F.col("row_key")
    chosen = cells.filter(table_filter(tbl) & ((key <= start if reverse else key >= start) if start else F.lit(True)))
    place = F.row_number().over(Window.partitionBy("tbl").orderBy(key.desc() if reverse else key.asc()))
    keys = chosen.select(*ROW).distinct().withColumn("_place", place).filter(F.col("_place") <= n).select(*ROW)
    return chosen.join(keys, ROW, "left_semi").select(*cells.columns)


def _by_row(cells: DataFrame, max_columns: int) -> GroupedData:
    """Cells grouped by row. A row wider than `max_columns` makes several groups of about that size, numbered by `part`, as a
    batched scan would return it. There are few such rows, if any: they are found by a count with a map-side half."""
    wide = (
        cells.groupBy(*ROW)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > max_columns)
        .select(*ROW, F.ceil(F.col("_n") / max_columns).alias("_parts"))
    )
    part = F.coalesce(F.pmod(F.xxhash64("family", "qualifier"), F.col("_parts")), F.lit(0))
    return cells.join(wide, ROW, "left").withColumn("part", part).groupBy(*ROW, "part")


def row_maps(cells: DataFrame, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """One row for each key with a map of `family:qualifier` to (value, ts). Takes newest cells.

    `part` is 0, but for rows wider than `max_columns`: these come in several parts with the same key, so that no task holds
    a row of any width whole.
    """
    entry = F.struct(F.concat_ws(":", "family", "qualifier"), F.struct("value", "ts"))
    return _by_row(cells, max_columns).agg(F.map_from_entries(F.collect_list(entry)).alias("columns"))


def row_lists(cells: DataFrame, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """As `row_maps`, with the columns as a list sorted by name."""
    entry = F.struct(
        F.concat_ws(":", "family", "qualifier").alias("column"), F.struct("value", "ts").alias("cell")
    )
    return _by_row(cells, max_columns).agg(F.array_sort(F.collect_list(entry)).alias("columns"))


# -- catalogue --------------------------------------------------------------------------------------------------


def tables(cells: DataFrame) -> DataFrame:
    """K21."""
    return cells.select("tbl").distinct()


def families(cells: DataFrame) -> DataFrame:
    """The column families of each table."""
    return cells.select("tbl", "family").distinct()


def rows_exist(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """`keys` (tbl, row_key) with a column telling whether the row has a cell."""
    found = cells.join(keys.select(*ROW), ROW, "left_semi").select(*ROW).distinct().withColumn("_found", F.lit(True))
    return keys.join(found, ROW, "left").select(
        *keys.columns, F.coalesce("_found", F.lit(False)).alias("row_exists")
    )


def truncate(spark, path: str, tbl: str) -> None:
    """Empty one table of a stored cell folder; the other tables' partitions are not touched."""
    stored = spark.read.parquet(path)
    # The folder is named as Spark's writer names it, with %3A for a colon and so on.
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(tbl)
    if stored.filter(F.col("tbl") == tbl).isEmpty():
        raise ValueError(f"no table {tbl!r} in {path}")
    stored.limit(0).drop("tbl").write.mode("overwrite").parquet(f"{path.rstrip('/')}/tbl={name}")
