"""Batched changes to cell tables.

A mutation log is `tbl, row_key, family, qualifier, ts, seq, op, value` with `seq` unique, and `expected` for checks.
Columns are named `family:qualifier`; the first colon separates, a qualifier may hold more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.operators.cells import latest
from carledger.operators.scan import placed, running_total
from carledger.schema import CELL, MUTATION_SCHEMA, ROW

LOG = MUTATION_SCHEMA.fieldNames()
NO_QUALIFIER = "put without a qualifier"
NO_NUMBER = "value is no 64-bit number"
_NUMBER = re.compile("[+-]?[0-9]+")
MAX_VALUE = (1 << 31) - 64  # bytes that one value can hold


def family(column: Column) -> Column:
    return F.substring_index(column, ":", 1)


def qualifier(column: Column) -> Column:
    """What follows the first colon; null without one."""
    at = F.locate(":", column)
    return F.when(at > 0, F.substr(column, at + 1))


def put_rows(
    df: DataFrame, tbl: str, key: str, columns: dict[str, str], ts: str, seq: str
) -> DataFrame:
    """K4: several columns of each row as puts. `columns` maps `family:qualifier` to the column that holds the value;
    a null value is no put. The puts of a row share its timestamp and its sequence number."""
    if missing := [c for c in columns if ":" not in c]:
        raise ValueError(f"{NO_QUALIFIER}: {missing}")
    wide = df.select(
        F.lit(tbl).alias("tbl"),
        F.col(key).cast("string").alias("row_key"),
        F.col(ts).cast("bigint").alias("ts"),
        F.col(seq).cast("bigint").alias("seq"),
        *[F.col(source).cast("string").alias(name) for name, source in columns.items()],
    )
    puts = wide.unpivot(["tbl", "row_key", "ts", "seq"], [f"`{c}`" for c in columns], "column", "value")
    return puts.filter(F.col("value").isNotNull()).select(
        "tbl",
        "row_key",
        family(F.col("column")).alias("family"),
        qualifier(F.col("column")).alias("qualifier"),
        "ts",
        "seq",
        F.lit("put").alias("op"),
        "value",
    )


def expand_batches(batches: DataFrame) -> DataFrame:
    """K5: `tbl, row_key, ts, seq, mutations array<struct<is_delete, column, value>>` -> log.

    All entries of a batch have its timestamp; a delete without a column is one of the row, a delete of a column without
    a qualifier is one of the family. Puts without a qualifier are left to `rejected_entries`.
    """
    entries = _entries(batches).filter(~_incomplete())
    column = F.col("m.column")
    delete = F.when(column.isNull(), "delete_row").when(column.contains(":"), "delete_cell").otherwise("delete_family")
    return entries.select(
        "tbl",
        "row_key",
        family(column).alias("family"),
        qualifier(column).alias("qualifier"),
        "ts",
        "seq",
        F.when(F.col("m.is_delete"), delete).otherwise("put").alias("op"),
        F.when(~F.col("m.is_delete"), F.col("m.value")).alias("value"),
    )


def _entries(batches: DataFrame) -> DataFrame:
    return batches.select("tbl", "row_key", "ts", "seq", F.explode("mutations").alias("m"))


def _incomplete() -> Column:
    return ~F.col("m.is_delete") & ~F.coalesce(F.col("m.column").contains(":"), F.lit(False))


def rejected_entries(batches: DataFrame) -> DataFrame:
    """K5: the entries of batches that can't be applied, with the reason."""
    rejected = _entries(batches).filter(_incomplete())
    return rejected.select("tbl", "row_key", "seq", F.col("m.column").alias("column"), F.lit(NO_QUALIFIER).alias("reason"))


_FAMILY = [*ROW, "family"]


def _newest_deletes(log: DataFrame, op: str, by: list[str], name: str) -> DataFrame:
    return log.filter(F.col("op") == op).groupBy(*by).agg(F.max("ts").alias(name))


def _join_deletes(cells: DataFrame, log: DataFrame) -> DataFrame:
    """`cells` with the newest delete of their family and of their row."""
    families = _newest_deletes(log, "delete_family", _FAMILY, "_family_gone")
    rows = _newest_deletes(log, "delete_row", ROW, "_row_gone")
    return cells.join(families, _FAMILY, "left").join(rows, ROW, "left")


def visible(log: DataFrame) -> DataFrame:
    """K8: puts that no delete of their cell, family or row with an equal or newer timestamp hides.

    Deletes are reduced to the newest one of each cell, family and row before they meet the puts. Neither side is ever
    gathered by key: AQE broadcasts the reduced deletes when their measured size allows, and splits the puts of a hot
    key when it does not. Other operations depend on the order of the log, see `replay`.
    """
    puts = log.filter(F.col("op") == "put").drop("op")
    cells = puts.join(_newest_deletes(log, "delete_cell", CELL, "_cell_gone"), CELL, "left")
    gone = F.greatest("_cell_gone", "_family_gone", "_row_gone")  # skips nulls
    alive = gone.isNull() | (F.col("ts") > gone)
    return _join_deletes(cells, log).filter(alive).select(*puts.columns)


def latest_visible(log: DataFrame) -> DataFrame:
    """K8 then K6 without joining single puts: the newest put of a cell is visible, or none of its puts is.

    One aggregate with a map-side half gives each cell its newest put and newest delete; deletes of families and rows then
    meet one row for each cell.
    """
    op, newest = F.col("op"), F.struct("ts", "seq")
    cells = (
        log.filter(op.isin("put", "delete_cell"))
        .groupBy(*CELL)
        .agg(
            F.max(F.when(op == "put", F.col("ts"))).alias("ts"),
            F.max_by(F.when(op == "put", F.col("value")), F.when(op == "put", newest)).alias("value"),
            F.max(F.when(op == "delete_cell", F.col("ts"))).alias("_cell_gone"),
        )
    )
    gone = F.greatest("_cell_gone", "_family_gone", "_row_gone")
    return (
        _join_deletes(cells, log)
        .filter(F.col("ts").isNotNull() & (gone.isNull() | (F.col("ts") > gone)))
        .select(*CELL, "ts", "value")
    )


def replay(log: DataFrame) -> DataFrame:
    """K4, K5, K18-K20 in one log: the outcome of every operation, applied in `seq` order.

    `op` is put, delete_cell, delete_family, delete_row, increment, append or cas. `value` is what is put, added or
    appended; a cas puts it if the checked cell holds `expected` (null: is absent). The checked cell is the put one unless
    `check_family` and `check_qualifier` name another of the row.

    -> `CELL, seq, op, applied, reason, value`, the value being the cell's after the operation (null: absent). Only rows with a cas
    that checks another cell must be streamed in order as a whole. All other rows are split: how many deletes of its row and of
    its family come before an operation is counted over range partitions, however many operations the row has; then the
    operations of each cell are streamed on their own, the cell being absent again whenever these numbers change. Rows of puts
    and deletes alone need no replay, see `latest_visible`.
    """
    extra = [c for c in ("expected", "check_family", "check_qualifier") if c not in log.columns]
    whole = log.withColumns({c: F.lit(None).cast("string") for c in extra})
    columns = [*CELL, "seq", "op", "value", "expected", "check_family", "check_qualifier"]
    whole = whole.select(*columns)
    elsewhere = F.col("check_family").isNotNull() & ~((F.col("check_family") == F.col("family")) & F.col("check_qualifier").eqNullSafe(F.col("qualifier")))
    tied = whole.filter((F.col("op") == "cas") & elsewhere).select(*ROW).distinct()
    one = lambda op: F.when(F.col("op") == op, 1).otherwise(0)
    free = whole.join(tied, ROW, "left_anti")
    free = running_total(free, ROW, ["seq"], one("delete_row"), "_rows")
    free = running_total(free, _FAMILY, ["seq"], one("delete_family"), "_families")
    return _streamed(free, [*CELL, "_rows", "_families"]).unionByName(_streamed(whole.join(tied, ROW, "left_semi"), ROW))


def _streamed(log: DataFrame, group: list[str]) -> DataFrame:
    """The outcome of operations that depend on nothing outside of their group, streamed by `seq`. A task holds the present cells
    of one group."""
    by = [c for c in group if c in CELL]
    # By a hash of the keys: a repartitioning by the keys alone is left out after a join on them, whose partitions adaptive
    # execution may then change.
    ordered = log.repartition(F.xxhash64(*by)).sortWithinPartitions(*by, "seq")
    columns = [*CELL, "seq", "op", "value", "expected", "check_family", "check_qualifier", *[c for c in group if c not in CELL]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row, cells = None, {}
        for batch in batches:
            out = []
            batch = batch.astype(object).where(batch.notna(), None)
            own = list(zip(*[batch[c] for c in group], strict=True))
            for at_row, (tbl, key, fam, qual, seq, op, value, expected, check_fam, check_qual, *_) in zip(own, batch.itertuples(index=False), strict=True):
                if at_row != row:
                    row, cells = at_row, {}
                at, reason = (fam, qual), None
                now = cells.get(at)
                if op == "put":
                    cells[at] = value
                elif op == "delete_cell":
                    cells.pop(at, None)
                elif op == "delete_family":
                    cells = {c: v for c, v in cells.items() if c[0] != fam}
                elif op == "delete_row":
                    cells = {}
                elif op == "increment":
                    parts = [now or "0", value or ""]
                    total = sum(map(int, parts)) if all(map(_NUMBER.fullmatch, parts)) else None
                    if total is not None and max(abs(total), *map(abs, map(int, parts))) < 1 << 63:
                        cells[at] = str(total)
                    else:
                        reason = NO_NUMBER
                elif op == "append":
                    cells[at] = (now or "") + (value or "")
                elif op == "cas":
                    checked = at if check_fam is None else (check_fam, check_qual)
                    if cells.get(checked) == expected:
                        cells[at] = value
                    else:
                        reason = "check failed"
                else:
                    reason = f"unknown operation {op}"
                out.append((tbl, key, fam, qual, seq, op, reason is None, reason, cells.get(at)))
            yield pd.DataFrame(out, columns=[*CELL, "seq", "op", "applied", "reason", "value"])

    kinds = "tbl string, row_key string, family string, qualifier string, seq long, op string"
    return ordered.select(*columns).mapInPandas(run, f"{kinds}, applied boolean, reason string, value string")


def increment_steps(increments: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """`CELL, seq, amount` plus `value`, the cell after each increment in `seq` order.

    `base` holds the cells before (value as text). A cell without any increment is not in the result.
    """
    return _on_base(running_total(increments, CELL, ["seq"], F.col("amount"), "value"), base)


def increment_totals(increments: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Only the cells after all increments; a sum with a map-side half."""
    return _on_base(increments.groupBy(*CELL).agg(F.sum("amount").alias("value")), base)


def _on_base(sums: DataFrame, base: DataFrame | None) -> DataFrame:
    """Sums on top of the cells before: an absent cell counts as 0, on a text that is no number the result is null."""
    if base is None:
        return sums
    start = latest(base).select(*CELL, F.col("value").alias("_base"))
    number = F.when(F.col("_base").isNull(), 0).otherwise(F.col("_base").try_cast("bigint"))
    return sums.join(start, CELL, "left").withColumn("value", F.col("value") + number).select(*sums.columns)


def expand_appends(requests: DataFrame) -> DataFrame:
    """`tbl, row_key, seq, columns array, values array` -> one row for each column and value."""
    pairs = requests.select("tbl", "row_key", "seq", F.explode(F.arrays_zip("columns", "values")).alias("p"))
    return pairs.select(
        "tbl",
        "row_key",
        family(F.col("p.columns")).alias("family"),
        qualifier(F.col("p.columns")).alias("qualifier"),
        "seq",
        F.col("p.values").alias("value"),
    )


def append_values(appends: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """`CELL, seq, value` -> the text of each cell after all appends, in `seq` order, behind its base value.

    Texts are joined part by part first, so ordering the appends of a hot cell is spread over tasks; only the finished
    pieces, which make up the one result value, meet. A cell that would grow beyond what a value can hold is an error.
    """

    def joined(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        pieces = F.array_sort(F.collect_list(F.struct(*order, F.col("value").alias("piece"))))
        text = F.array_join(F.transform(pieces, lambda p: p.piece), "")
        return df.groupBy(*keys).agg(text.alias("value"))

    parts = joined(placed(appends, CELL, ["seq"]), [*CELL, "_part"], ["seq", "_tie"])
    size = F.sum(F.octet_length("value"))
    sizes = parts.groupBy(*CELL).agg(F.when(size > MAX_VALUE, F.raise_error(F.lit("a cell outgrows a value"))).alias("_over"))
    after = joined(parts.join(sizes, CELL).filter("_over is null"), CELL, ["_part"])
    if base is None:
        return after
    start = latest(base).select(*CELL, F.col("value").alias("_base"))
    return after.join(start, CELL, "left").select(
        *CELL, F.concat(F.coalesce("_base", F.lit("")), F.col("value")).alias("value")
    )
