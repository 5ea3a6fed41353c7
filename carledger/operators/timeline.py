"""Joins and windows along time, for groups of any size.

Nothing here is done by one task a group. Rows are range-partitioned by group and time (`scan.placed`), so a group with a third
of all rows lies in many partitions; each is worked through on its own, and one row for each of them, its state at the border,
carries what later ones need. Times are whole numbers (microseconds, days, ...), so that results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carledger.operators.scan import carried_last, placed, running_count, running_totals

_KIND, _FOUND = "_kind", "_found"


def asof_join(left: DataFrame, right: DataFrame, by: list[str], time: str, ties: list[str], strict: bool = False) -> DataFrame:
    """Every row of `left` with the latest row of `right` of the same `by` that isn't later than it (with `strict`: earlier).

    Both have the columns `by` and `time`; the other columns of `right` are added, null where there is no such row. Of right
    rows of one time the last by `ties` (columns of `right`) counts. Null keys are equal to each other; a right row without
    time is never found, a left row without time finds nothing. No other column of `right` may have the name of one of `left`.

    The rows of both are put in one order; a left row sees the last right row before it in its partition, or else the one
    carried over from the partitions before.
    """
    others = [c for c in right.columns if c not in [*by, time]]
    clash = set(others) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    # Of right rows of one key and time only the last can be found: they are reduced before anything is ordered.
    value = F.struct(*[F.col(c) for c in [*ties, *(c for c in others if c not in ties)]])
    latest = right.filter(F.col(time).isNotNull()).groupBy(*by, time).agg(F.max(value).alias(_FOUND))
    rows = left.select(*by, time, F.struct(*[F.col(c) for c in left.columns]).alias("_row"))
    both = rows.withColumn(_KIND, F.lit(0 if strict else 1)).unionByName(
        latest.withColumn(_KIND, F.lit(1 if strict else 0)), allowMissingColumns=True
    )
    seen = carried_last(both, by, [time, _KIND], F.when(F.col(_FOUND).isNotNull(), F.struct(time, _FOUND)), "_last")
    asked = seen.filter(F.col("_row").isNotNull())
    last = F.when(F.col(time).isNotNull(), F.col(f"_last.{_FOUND}"))
    return asked.select(*[F.col(f"_row.{c}").alias(c) for c in left.columns], *[last[c].alias(c) for c in others])


def _levels(start: Column, end: Column, base: int, levels: int) -> Column:
    """The smallest level whose bins (base * 4^level wide) are as long as the interval."""
    level = F.lit(levels - 1)
    for k in reversed(range(levels - 1)):
        level = F.when(end - start <= base * 4**k, k).otherwise(level)
    return level


def interval_join(
    left: DataFrame, right: DataFrame, by: list[str], left_span: tuple[str, str], right_span: tuple[str, str], base: int, levels: int = 12
) -> DataFrame:
    """All pairs of rows of the same `by` whose closed intervals [start, end] overlap; a point has equal ends.

    Both sides have the columns `by`; their other columns must have different names. Rows with a null end or key, or whose end
    lies before their start, have no pairs. Bins grow in levels: base, 4 base, 16 base, ... An interval goes into the bins it
    meets at its own level and at the wider ones that the other side has intervals of, at most two of each, so long intervals
    aren't multiplied by their length.
    A pair meets at the wider of both levels, in the first bin that both share; other meetings are dropped, so no pair
    comes twice. The join is one on equal keys, bins and levels; a hot key is spread over its bins, and hot bins are split
    by the engine's skew handling.
    """

    width = F.expr(f"cast({base} * pow(4, _level) as bigint)")

    # Levels and first bins follow from the spans: they are worked out on both sides of the shuffle rather than sent through it.
    def own(span: tuple[str, str]) -> Column:
        return _levels(F.col(span[0]), F.col(span[1]), base, levels).cast("int")

    def first(span: tuple[str, str]) -> Column:
        return F.floor(F.col(span[0]) / width)

    def leveled(df: DataFrame, span: tuple[str, str]) -> tuple[DataFrame, list[int]]:
        some = df.filter(F.col(span[0]) <= F.col(span[1])).dropna(subset=by)
        used = some.select(own(span).alias("_own")).distinct().collect()  # as many as there are levels, at most
        return some, [r[0] for r in used]

    def binned(df: DataFrame, span: tuple[str, str], others: list[int]) -> DataFrame:
        wider = F.filter(F.array(*map(F.lit, others)).cast("array<int>"), lambda x: x > own(span))
        placed_ = df.withColumn("_level", F.explode(F.concat(F.array(own(span)), wider)))
        # The widest level is one of long intervals too: its bins are as many as they meet.
        return placed_.withColumn("_bin", F.explode(F.sequence(first(span), F.floor(F.col(span[1]) / width))))

    (a, a_levels), (b, b_levels) = leveled(left, left_span), leveled(right, right_span)
    a, b = binned(a, left_span, b_levels), binned(b, right_span, a_levels)
    met = a.join(b, [*by, "_level", "_bin"])
    met = met.filter((F.col("_level") == F.greatest(own(left_span), own(right_span))) & (F.col("_bin") == F.greatest(first(left_span), first(right_span))))
    met = met.filter((F.col(left_span[0]) <= F.col(right_span[1])) & (F.col(right_span[0]) <= F.col(left_span[1])))
    return met.select(*by, *[c for c in left.columns if c not in by], *[c for c in right.columns if c not in by])


def moving_totals(df: DataFrame, group: list[str], time: str, amounts: dict[str, Column], width: int) -> DataFrame:
    """group, time, n and the sums of `amounts` (whole numbers) over the rows of the group from `time - width` to `time`, both
    included, for each time that occurs: a range frame.

    Rows are first added up by time. Frames aren't looked at row by row: a total over a frame is the running total at its end
    less the one before its start, which an as-of join finds, so the work doesn't grow with the rows in a frame.
    """
    names = ["n", *amounts]
    sums = [F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in amounts.items()]]
    totals = df.filter(F.col(time).isNotNull()).groupBy(*group, time).agg(*sums)
    for name in names:
        totals = totals.withColumnRenamed(name, f"_one_{name}")
    totals = running_totals(totals, group, [time], {f"_to_{n}": F.col(f"_one_{n}") for n in names}).drop(*[f"_one_{n}" for n in names])
    before = totals.select(*group, F.col(time).alias("_at"), *[F.col(f"_to_{n}").alias(f"_from_{n}") for n in names], F.col(time).alias("_seen"))
    frames = totals.withColumn("_at", F.col(time) - width)
    found = asof_join(frames, before, group, "_at", ["_seen"], strict=True)
    return found.select(*group, time, *[(F.col(f"_to_{n}") - F.coalesce(f"_from_{n}", F.lit(0))).alias(n) for n in names])


def neighbours(df: DataFrame, group: list[str], order: list[str], columns: list[str], offsets: dict[str, int]) -> DataFrame:
    """`df` plus, for each prefix and offset, the `columns` of the row so many places later (earlier if negative) in its group by
    `order`, which must identify a row; null where there is none. Places are counted over range partitions, and rows meet by
    group and place, so no group is in one task."""
    numbered = running_count(df, group, order, "_place")
    out = numbered
    for prefix, offset in offsets.items():
        on = [*group, "_place"]
        there = numbered.select(*group, (F.col("_place") - offset).alias("_place"), *[F.col(c).alias(f"{prefix}{c}") for c in columns])
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on]
        names = [*out.columns]
        out = out.alias("a").join(there.alias("b"), same, "left").select(*[F.col(f"a.{c}").alias(c) for c in names], *[f"b.{prefix}{c}" for c in columns])
    return out.drop("_place")


def sessions(df: DataFrame, group: list[str], time: str, gap: int, amounts: dict[str, Column]) -> DataFrame:
    """group, session_start, session_end, n and sums of `amounts`: runs of rows of a group with at most `gap` between each and
    the next. Rows without time are left out.

    Each range partition finds the sessions of its own rows. Only the first of a group in a partition can go on an earlier
    one: it does if the latest end before it is near enough, and then belongs to the last session that was opened before. Both
    are carried from partition to partition in one row for each group and partition.
    """
    rows = placed(df.filter(F.col(time).isNotNull()), group, [time])
    here = Window.partitionBy(*group, "_part").orderBy(time, "_tie")
    far = F.col(time) - F.lag(time).over(here) > gap
    opened = rows.withColumn("_open", F.coalesce(far, F.lit(True)).cast("int"))
    number = F.sum("_open").over(here.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(n) for n, c in amounts.items()]]
    local = opened.withColumn("_nth", number).groupBy(*group, "_part", "_nth")
    local = local.agg(F.min(time).alias("_start"), F.max(time).alias("_end"), *sums)
    # One row for each group and partition: its first start, last end, and the last start that isn't its first.
    state = local.groupBy(*group, "_part").agg(
        F.min("_start").alias("_first"), F.max("_end").alias("_until"), F.max(F.when(F.col("_nth") > 1, F.col("_start"))).alias("_inner")
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    state = state.withColumn("_goes_on", F.coalesce(F.col("_first") - F.max("_until").over(earlier) <= gap, F.lit(False)))
    last = F.greatest("_inner", F.when(~F.col("_goes_on"), F.col("_first")))
    state = state.withColumn("_last", last).withColumn("_root", F.max("_last").over(earlier))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*group, "_part"]]
    borders = state.filter("_goes_on").select(*group, "_part", "_root")
    joined = local.alias("a").join(borders.alias("b"), on, "left")
    start = F.when((F.col("a._nth") == 1) & F.col("b._root").isNotNull(), F.col("b._root")).otherwise(F.col("a._start"))
    merged = joined.select(*[f"a.{c}" for c in group], start.alias("session_start"), "a._end", *[f"a.{c}" for c in ["n", *amounts]])
    merged = merged.groupBy(*group, "session_start").agg(F.max("_end").alias("session_end"), *[F.sum(c).alias(c) for c in ["n", *amounts]])
    return merged.select(*group, "session_start", "session_end", "n", *amounts)
