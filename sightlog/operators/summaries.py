"""Rank summaries of loads: kept with the metrics, merged over any span, precise about what they miss.

A summary of a column in one load is its number of values and ``POINTS`` + 1 values at evenly spaced
ranks.  Summaries add up: the points of many loads, each standing for its load's share of values, give
the ranks of all loads together, and ``slack`` says by how many values such a rank may be off.  So the
median of a year comes from the summaries of its loads alone, with bounds that hold the exact one for
certain; ``ranks.exact_medians`` then orders only the values between them, in one pass over the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sightlog.operators.ranks import ACCURACY

POINTS = 2000

SUMMARY = ("metrics_name", "n", "slack", "points")


def summarize(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), points: int = POINTS) -> DataFrame:
    """(by..., metrics_name, n, slack, points) of each column, in one pass; no row without values."""
    # as text: so many literals are parsed much faster than they are built one by one
    at = ", ".join(f"{i / points}D" for i in range(points + 1))
    found = []
    for i, c in enumerate(columns):
        value = f"CAST(`{c}` AS DOUBLE)"
        found += [F.expr(f"count({value}) AS n_{i}"), F.expr(f"percentile_approx({value}, array({at}), {ACCURACY}) AS p_{i}")]
    each = F.array(*[
        F.struct(F.lit(c).alias("metrics_name"), F.col(f"n_{i}").alias("n"), F.col(f"p_{i}").alias("points"))
        for i, c in enumerate(columns)
    ])
    rows = df.groupBy(*by).agg(*found).select(*by, F.explode(each).alias("e")).select(*by, "e.*").where(F.col("n") > 0)
    # what the summary's ranks and the gap between two points may hide, and a value for rounding each
    slack = F.ceil(F.col("n") * (1 / points + 1 / ACCURACY)) + 2
    return rows.select(*by, "metrics_name", "n", slack.cast("bigint").alias("slack"), "points")


def _upto(summaries: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., metrics_name, total, slack, value, before, upto): values of all points with the number of
    values up to each, counted in shares of points."""
    group = [*by, "metrics_name"]
    share = F.col("n") / (F.size("points") - 1)
    points = summaries.select(*group, "n", "slack", share.alias("share"), F.posexplode("points").alias("i", "value"))
    first = F.col("i") == 0
    values = points.groupBy(*group, "value").agg(
        F.sum(F.when(first, 0.0).otherwise(F.col("share"))).alias("weight"),
        F.sum(F.when(first, F.col("n"))).alias("n"), F.sum(F.when(first, F.col("slack"))).alias("slack"),
    )
    whole, running = Window.partitionBy(*group), Window.partitionBy(*group).orderBy("value")
    upto = F.sum("weight").over(running.rowsBetween(Window.unboundedPreceding, 0))
    return values.select(
        *group, F.sum("n").over(whole).alias("total"), F.sum("slack").over(whole).alias("slack"), "value", "weight", upto.alias("upto")
    ).withColumn("before", F.col("upto") - F.col("weight"))


def merged(summaries: DataFrame, by: Sequence[str] = (), points: int = POINTS) -> DataFrame:
    """One summary for all loads of a group, to be merged further or kept; its slack is theirs and its own."""
    group = [*by, "metrics_name"]
    at = F.col("total") / points
    # the points between the running counts before and after a value are that value
    first = F.when(F.col("before") <= 0, 0).otherwise(F.floor(F.col("before") / at + 1e-9) + 1)
    last = F.least(F.lit(points), F.floor(F.col("upto") / at + 1e-9))
    taken = _upto(summaries, by).select(
        *group, "total", "slack", "value", F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))).alias("at")
    )
    each = taken.select(*group, "total", "slack", "value", F.explode("at").alias("i"))
    # a point that two values reach by rounding is the smaller one
    one = each.groupBy(*group, "total", "slack", "i").agg(F.min("value").alias("value"))
    rows = one.groupBy(*group).agg(
        F.max("total").alias("n"), F.max("slack").alias("slack"), F.array_sort(F.collect_list(F.struct("i", "value"))).alias("p")
    )
    p = F.transform("p", lambda s: s["value"])
    slack = F.col("slack") + F.ceil(F.col("n") / points) + 2
    return rows.select(*group, "n", slack.cast("bigint").alias("slack"), p.alias("points"))


def spans(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., metrics_name, n, low, middle, high): an approximate median of all loads of a group and
    bounds that hold the exact one, in the form that ``ranks.exact_medians`` takes.

    Without a bound the band is open: NaN is above every number.
    """
    group = [*by, "metrics_name"]
    middle = F.col("total") / 2
    value, upto, slack = F.col("value"), F.col("upto"), F.col("slack")
    return _upto(summaries, by).groupBy(*group).agg(
        F.max("total").alias("n"),
        F.coalesce(F.max(F.when(upto + slack < middle - 1, value)), F.lit(float("-inf"))).alias("low"),
        F.min(F.when(upto >= middle, value)).alias("middle"),
        F.coalesce(F.min(F.when(upto - slack > middle + 1, value)), F.lit(float("nan"))).alias("high"),
    )
