"""Nested values (JSON text) taken apart into typed columns, with a side table of what doesn't fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_JSON = "no json"


def _parsed(column: str) -> Column:
    return F.try_parse_json(F.col(column))


def shredded(df: DataFrame, column: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """`df` without `column`, plus a typed column for each field (name -> (path, type)) and `reason`: null, `no json` or the fields
    whose values don't have their type. A missing field, a null and a null text are null and fit. The text is parsed once."""
    rest = [c for c in df.columns if c != column]
    parsed = df.select(*rest, F.col(column).isNotNull().alias("_given"), _parsed(column).alias("_v"))
    typed = {n: F.try_variant_get("_v", path, kind) for n, (path, kind) in fields.items()}
    held = {n: F.variant_get("_v", path, "variant") for n, (path, _) in fields.items()}
    wrong = [F.when(held[n].isNotNull() & ~F.is_variant_null(held[n]) & typed[n].isNull(), n) for n in fields]
    reason = F.when(F.col("_given") & F.col("_v").isNull(), NO_JSON).otherwise(F.nullif(F.concat_ws(", ", *wrong), F.lit("")))
    return parsed.select(*rest, *[c.alias(n) for n, c in typed.items()], reason.alias("reason"))


def accepted(found: DataFrame) -> DataFrame:
    return found.filter(F.col("reason").isNull()).drop("reason")


def rejected(found: DataFrame) -> DataFrame:
    """The side table: rows whose text is no JSON or whose fields have other types, with the reason."""
    return found.filter(F.col("reason").isNotNull())
