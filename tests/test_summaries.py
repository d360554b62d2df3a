"""Rank summaries: bounds hold the exact median, whatever is merged."""

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from sightlog.operators.ranks import exact_medians
from sightlog.operators.summaries import merged, spans, summarize


def data(seed: int):
    rng = random.Random(seed)
    rows = []
    for load in range(30):
        n = rng.choice([1, 2, 7, 50, 400])
        shift = rng.choice([0, 0, 100, -50])
        rows += [(load, load // 10, shift + rng.choice([rng.gauss(0, 30), 5.0]), None if rng.random() < 0.3 else rng.randrange(5)) for _ in range(n)]
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("points", [2000, 20])
def test_spans_hold_the_exact_median(spark, seed, points):
    rows = data(seed)
    df = spark.createDataFrame(rows, "load int, span int, a double, b int").repartition(5)
    loads = summarize(df, ["a", "b"], ["load"], points).withColumn("span", F.expr("load div 10"))
    tens = merged(loads, ["span"], points)
    for by, summaries in ((["span"], loads), ([], loads), (["span"], tens), ([], tens)):
        around = spans(summaries, by)
        for few in (True, False):
            found = exact_medians(df, ["a", "b"], by, around, few).collect()
            assert len(found) == (6 if by else 2)
            for r in found:
                at = 2 if r["metrics_name"] == "a" else 3
                values = [x[at] for x in rows if x[at] is not None and (not by or x[1] == r["span"])]
                assert r["metrics_value"] == pytest.approx(median(values))
        for r in around.collect():
            at = 2 if r["metrics_name"] == "a" else 3
            values = sorted(x[at] for x in rows if x[at] is not None and (not by or x[1] == r["span"]))
            assert r["n"] == len(values)
            # the approximate median is off by no more ranks than the summaries say
            slack = max(s["slack"] for s in summaries.groupBy(*by, "metrics_name").agg(F.sum("slack").alias("slack")).collect())
            below, upto = sum(v < r["middle"] for v in values), sum(v <= r["middle"] for v in values)
            assert below - slack <= len(values) / 2 <= upto + slack


def test_summaries_are_small_and_merge_in_any_order(spark):
    df = spark.range(50_000).selectExpr("id % 7 AS load", "cast((id * 7919) % 50000 AS double) AS v")
    loads = summarize(df, ["v"], ["load"])
    once = merged(loads)
    again = merged(merged(loads.withColumn("half", F.expr("load % 2")), ["half"]))
    for one in (once.first(), again.first()):
        assert one["n"] == 50_000 and len(one["points"]) == 2001 and one["slack"] < 500
        assert all(abs(p - 25 * i) <= one["slack"] for i, p in enumerate(one["points"]))
    bounds = spans(loads).first()
    assert 24_000 < bounds["low"] <= bounds["middle"] <= bounds["high"] < 26_000


def test_columns_without_values_have_no_summary(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "load int, v double")
    assert summarize(df, ["v"], ["load"]).count() == 0 and spans(summarize(df, ["v"], ["load"])).count() == 0
    assert summarize(df.where("load > 5"), ["v"]).count() == 0
