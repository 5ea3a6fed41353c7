"""Raw listings -> clean listings (C1-C17). Every function is DataFrame -> DataFrame without an action.

`missing` chooses what counts as a missing value:
  strict   null, blank text (any whitespace) and the text `nan`; the rule the cleaning is meant to apply
  literal  null only (plus NaN text for the displacement of electric cars, and U+0020 blanks for the level)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carledger.functions import text as X
from carledger.schema import CLEAN_COLUMNS, ELECTRIC, HORSEPOWER, KILOMETRE, STYLE_MARK, WAN


def _check(missing: str) -> None:
    if missing not in ("strict", "literal"):
        raise ValueError(f"missing must be 'strict' or 'literal', not {missing!r}")


def strip_units(raw: DataFrame) -> DataFrame:
    """Units out of the values. `1.5T` keeps its T."""
    return raw.withColumns(
        {
            "current_price": X.literal_replace(F.col("current_price"), WAN),
            "new_price": X.literal_replace(F.col("new_price"), WAN),
            "mileage": X.literal_replace(F.col("mileage"), KILOMETRE),
            "displacement": X.literal_replace(F.col("displacement"), "L"),
        }
    )


def reg_month(raw: DataFrame) -> DataFrame:
    """C2."""
    return raw.withColumn("reg_time", X.year_month(F.col("reg_time")))


def transfer_digits(raw: DataFrame) -> DataFrame:
    """Only digits stay; none at all gives ''."""
    return raw.withColumn("transfer_count", X.digits_only(F.col("transfer_count")))


def split_engine(raw: DataFrame) -> DataFrame:
    """C4: second token without its unit is the horsepower, third the engine; too few tokens give null."""
    parts = F.split(F.col("engine"), " ")
    return raw.withColumns(
        {
            "horsepower": X.literal_replace(F.get(parts, F.lit(1)), HORSEPOWER),
            "engine": F.get(parts, F.lit(2)),
        }
    )


def has_level(missing: str = "strict") -> Column:
    _check(missing)
    level = F.col("level")
    return ~X.blank_text(level) if missing == "strict" else F.trim(level) != ""


def drop_blank_level(raw: DataFrame, missing: str = "strict") -> DataFrame:
    """C5. A null level goes too."""
    return raw.filter(has_level(missing))


def union_provinces(frames: list[DataFrame]) -> DataFrame:
    """By name, copies kept. Files of one layout are better read by one scan (sources.listings)."""
    return reduce(DataFrame.unionByName, frames)


def project(df: DataFrame) -> DataFrame:
    """C7."""
    return df.select(*CLEAN_COLUMNS)


def progress(df: DataFrame) -> DataFrame:
    """What a progress line shows."""
    return df.select("brand", "model", "province")


def first_pass(raw: DataFrame, missing: str = "strict") -> DataFrame:
    """C1-C5 and C7."""
    # The level filter looks at an untouched column, so it comes first and reaches the scan.
    kept = drop_blank_level(raw, missing)
    return project(split_engine(transfer_digits(reg_month(strip_units(kept)))))


def keep_marked_style(df: DataFrame) -> DataFrame:
    """C8."""
    return df.filter(F.col("style").contains(STYLE_MARK))


def mileage_in_wan(df: DataFrame) -> DataFrame:
    """C9."""
    return df.withColumn("mileage", X.literal_replace(F.col("mileage"), WAN))


def _electric(missing: str) -> Column:
    """C10 as a filter; null for a null fuel type. The fuel type alone reaches the files."""
    _check(missing)
    displacement = F.col("displacement")
    if missing == "strict":
        absent = displacement.isNull() | X.blank_text(displacement)
    else:
        absent = X.nan_text(displacement)
    return (F.col("fuel_type") == ELECTRIC) & absent


def electric_without_displacement(missing: str = "strict") -> Column:
    """C10 as a condition that is never null."""
    return F.coalesce(_electric(missing), F.lit(False))


def complete(missing: str = "strict", columns: list[str] = CLEAN_COLUMNS) -> Column:
    """C12 as a condition: no column is missing. (Electric rows without displacement are never complete.)"""
    _check(missing)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    if missing == "literal":
        return present
    # One lambda over the columns instead of one regex call each keeps the generated method small enough for the JIT.
    return present & ~F.exists(F.array(*columns), X.blank_text)


def electric_part(df: DataFrame, missing: str = "strict") -> DataFrame:
    return df.filter(_electric(missing))


def without_electric_part(df: DataFrame, missing: str = "strict") -> DataFrame:
    """C11: EXCEPT DISTINCT against the electric part.

    The part taken away is a selection of the same rows, so the difference is the opposite selection plus
    duplicate removal: no join. Exact copies meet in the map-side half of the aggregate.
    """
    return df.filter(~electric_without_displacement(missing)).distinct()


def second_pass(df: DataFrame, missing: str = "strict", dedupe_all: bool = False) -> DataFrame:
    """Complete rows once each, plus the electric rows without displacement, copies included.

    `df` is read by both branches. The electric branch is a plain filter, whose fuel type prunes the second read, and
    its copies need no shuffle.
    """
    marked = mileage_in_wan(keep_marked_style(df))
    # Incomplete rows leave before the duplicate removal, so they are never shuffled.
    rest = without_electric_part(marked.filter(complete(missing)), missing)
    kept = rest.unionByName(electric_part(marked, missing))
    return kept.distinct() if dedupe_all else kept


def clean(raw: DataFrame, missing: str = "strict", dedupe_all: bool = False) -> DataFrame:
    """Both passes."""
    return second_pass(first_pass(raw, missing), missing, dedupe_all)


def stage_counts(raw: DataFrame, missing: str = "strict") -> DataFrame:
    """C14: rows left after each stage, from one scan and one pre-aggregated shuffle.

    Only rows that finish are told apart, for their copies; the others shrink to one row for each stage in a map task.
    """
    rows = mileage_in_wan(project(split_engine(transfer_digits(reg_month(strip_units(raw))))))
    level = F.coalesce(has_level(missing), F.lit(False))
    style = F.coalesce(F.col("style").contains(STYLE_MARK), F.lit(False))
    electric = electric_without_displacement(missing)
    flags = rows.withColumns({"_level": level, "_style": level & style})
    flags = flags.withColumns({"_electric": F.col("_style") & electric, "_done": F.col("_style") & ~electric & complete(missing)})
    told = [F.when(F.col("_done"), F.col(c)).alias(c) for c in CLEAN_COLUMNS]
    copies = flags.groupBy("_level", "_style", "_electric", "_done", *told).agg(F.count(F.lit(1)).alias("n"))
    leveled, styled, electric, finished = F.col("_level"), F.col("_style"), F.col("_electric"), F.col("_done")
    totals = copies.agg(
        F.sum("n").alias("raw"),
        F.sum(F.when(leveled, F.col("n")).otherwise(0)).alias("with_level"),
        F.sum(F.when(styled, F.col("n")).otherwise(0)).alias("with_style"),
        F.sum(F.when(electric, F.col("n")).when(finished, F.lit(1)).otherwise(0)).alias("clean"),
    )
    return totals.unpivot([], ["raw", "with_level", "with_style", "clean"], "stage", "n").select(
        "stage", F.coalesce("n", F.lit(0)).alias("n")
    )
