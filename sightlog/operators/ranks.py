"""Ranks and medians over whole frames without bringing them into one task.

Medians come from two passes: a summary of ranks gives bounds around the middle of each column,
and only values between them are ordered.  Positions in a long queue come from ranges of about
equally many distinct keys; range totals are put in one order.  Results are exact: bounds and cut
points decide how work is spread, never what comes out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

RANGES = 1024

#: Entries of the rank summary: ranks are off by at most a share of 1 / ACCURACY.
ACCURACY = 10_000
#: Share of the ranks kept on either side of a median: ten times that.
BAND = 10 / ACCURACY

_BUCKET = "__bucket"
_CUTS = "__cuts"


def _bucket_of(value: Column, cuts: Column, ranges: int) -> Column:
    """How many cut points lie below ``value``: binary search in a sorted array."""
    steps = []
    step = ranges // 2
    while step:
        steps.append(step)
        step //= 2
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: at + F.when(value > F.get(cuts, at + s - 1), s).otherwise(0),
    )
    # never null; saying so keeps Spark from testing it for null below the aggregation
    return F.coalesce(found, F.lit(0))


def into_ranges(
    counts: DataFrame, value: str, weight: str, ranges: int = RANGES
) -> DataFrame:
    """``counts`` with the range each distinct value falls in; ``ranges`` is a power of two."""
    fractions = ", ".join(f"{i / ranges}D" for i in range(1, ranges))
    # the always-true test on the weight keeps this branch on the same shuffle as the others
    cuts = counts.agg(
        F.expr(
            f"percentile_approx(CASE WHEN {weight} > 0 THEN {value} END, "
            f"array({fractions}), {4 * ranges})"
        ).alias(_CUTS)
    )
    with_cuts = counts.withColumn(_CUTS, cuts.select(_CUTS).scalar())
    bucket = _bucket_of(F.col(value), F.col(_CUTS), ranges)
    return with_cuts.withColumn(_BUCKET, bucket).drop(_CUTS)


def range_totals(ranged: DataFrame, weight: str) -> DataFrame:
    """Per range: rows in it and rows in earlier ranges; one row each, ordered in one task."""
    totals = ranged.groupBy(_BUCKET).agg(F.sum(weight).alias("inside"))
    window = Window.orderBy(_BUCKET)
    upto = F.sum("inside").over(window.rowsBetween(Window.unboundedPreceding, 0))
    return totals.withColumn("before", upto - F.col("inside"))


def bands(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows of each group, and for each column its values, an approximate median and two bounds
    around it: (by..., rows, n_i, q_i) for column number i.

    The bounds lie BAND of the rows to either side, several times what the approximation may be
    off, so the exact middle is between them.
    """
    found = []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        at = [max(0.0, 0.5 - BAND), 0.5, min(1.0, 0.5 + BAND)]
        found += [F.count(value).alias(f"n_{i}"), F.percentile_approx(value, at, ACCURACY).alias(f"q_{i}")]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *found)


def band_rows(around: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``bands`` as rows: (by..., metrics_name, n, low, middle, high)."""
    each = F.array(*[
        F.struct(
            F.lit(c).alias("metrics_name"), F.col(f"n_{i}").alias("n"), F.get(f"q_{i}", F.lit(0)).alias("low"),
            F.get(f"q_{i}", F.lit(1)).alias("middle"), F.get(f"q_{i}", F.lit(2)).alias("high"),
        )
        for i, c in enumerate(columns)
    ])
    return around.select(*by, F.explode(each).alias("e")).select(*by, "e.*")


def exact_medians(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], around: DataFrame, few: bool | None = None
) -> DataFrame:
    """Interpolated median of each column: (by..., metrics_name, metrics_value), null where a
    column has no values.

    ``around`` are the ``band_rows`` of the same frame, or ``summaries.spans``.  Values are counted,
    those below the band are summed without being ordered, and only the band's are ordered: a share of
    about 2 * BAND of a group's rows, whatever its size.  With ``few`` groups, whose number the caller
    has checked, or without any, the bounds are broadcast and values beyond them are not shuffled.
    """
    few = not by if few is None else few
    group = [*by, "metrics_name"]
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(by), list(columns), "metrics_name", "value"
    )
    value = F.col("value")
    given = long.where(value.isNotNull())
    inside = F.when(value >= F.col("low"), value).alias("value")
    if not few:
        # equal values are counted before they meet the bounds
        counts = given.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("rows"))
    else:
        counts, around = given.withColumn("rows", F.lit(1)), F.broadcast(around)
    placed = (
        counts.join(around, _same(counts, around, group)).where(value <= F.col("high"))
        .select(*[counts[g] for g in group], "n", "rows", inside)
        .groupBy(*group, "n", "value").agg(F.sum("rows").alias("rows"))
    )
    upto = F.sum("rows").over(
        Window.partitionBy(*group).orderBy(F.asc_nulls_first("value")).rowsBetween(Window.unboundedPreceding, 0)
    )
    low, high = F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")
    ranked = placed.withColumn("upto", upto)
    inside = F.col("value").isNotNull()
    ends = ranked.groupBy(*group).agg(
        F.min(F.when(inside & (F.col("upto") >= low), value)).alias("a"),
        F.min(F.when(inside & (F.col("upto") >= high), value)).alias("b"),
        F.max(F.when(~inside, F.col("upto") >= low)).alias("missed"),
    )
    held = F.coalesce(~F.col("missed"), F.lit(True)) & F.col("a").isNotNull() & F.col("b").isNotNull()
    median = F.when(held, (F.col("a") + F.col("b")) / 2).otherwise(
        F.raise_error(F.lit("the middle of a column lies outside its band"))
    )
    found = ends.select(*group, median.cast("double").alias("metrics_value"))
    return around.join(found, _same(around, found, group), "left").select(
        *[around[g] for g in group], "metrics_value"
    )


def _same(a: DataFrame, b: DataFrame, names: Sequence[str]) -> Column:
    """Equality of all columns named, nulls alike: a load without a key is a load."""
    equal = [a[n].eqNullSafe(b[n]) for n in names]
    return reduce(lambda x, y: x & y, equal)


def split_batches(queue: DataFrame, key: str, size: int, copies_per_block: int = 100_000) -> DataFrame:
    """Queue rows in ascending key order, cut into batches of ``size``: (batch, position, key).

    Positions come from running counts of distinct keys, so neither a long queue nor a key
    that is queued very often is ever ordered or expanded within one task.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    counts = (
        queue.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    )
    ranged = into_ranges(counts, key, "rows")
    totals = range_totals(ranged, "rows").select(_BUCKET, "before")
    running = F.sum("rows").over(
        Window.partitionBy(_BUCKET).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    )
    # at most RANGES total rows: safe to broadcast
    starts = (
        ranged.withColumn("upto", running)
        .join(F.broadcast(totals), _BUCKET)
        .select(key, "rows", (F.col("before") + F.col("upto") - F.col("rows")).alias("start"))
    )
    blocks = starts.select(
        key, "rows", "start",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr("rows - 1"), F.lit(copies_per_block)))
        .alias("first"),
    ).repartition(key, "first")
    last = F.least(F.col("rows"), F.col("first") + copies_per_block) - 1
    return blocks.select(
        key, "start", F.explode(F.sequence(F.col("first"), last)).alias("copy")
    ).select(
        F.expr(f"(start + copy) div {size}").alias("batch"),
        (F.col("start") + F.col("copy")).alias("position"),
        key,
    )
