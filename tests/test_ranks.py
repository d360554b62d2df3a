import random
import statistics
from collections import defaultdict

import pytest

from sightlog.operators.quality import measure
from sightlog.operators.ranks import split_batches
from sightlog.specs import Check


def exact_median(df, columns, by=()):
    return measure(df, Check(medians=tuple(columns)), by).where("agg_type = 'median'")


def skewed(rng, n):
    """A third of the rows hold one value, the rest are heavy-tailed."""
    return [5.0 if rng.random() < 0.34 else rng.paretovariate(0.5) * rng.choice([-1, 1]) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 999, 5000])
def test_median_of_one_load(rows, n):
    rng = random.Random(n)
    a, b = skewed(rng, n), [rng.randrange(7) for _ in range(n)]
    b = [None if rng.random() < 0.1 else v for v in b]
    df = rows(list(zip(a, b)), "a double, b long")
    got = {r["metrics_name"]: r["metrics_value"] for r in exact_median(df, ["a", "b"]).collect()}
    assert got["a"] == pytest.approx(statistics.median(a))
    present = [v for v in b if v is not None]
    assert got.get("b") == (statistics.median(present) if present else None)


def test_median_by_group(rows):
    rng = random.Random(1)
    data = [(rng.choice("xxxyz"), v) for v in skewed(rng, 3000)]
    groups = defaultdict(list)
    for k, v in data:
        groups[k].append(v)
    df = rows(data, "k string, a double")
    got = {r["k"]: r["metrics_value"] for r in exact_median(df, ["a"], ["k"]).collect()}
    assert got == {k: pytest.approx(statistics.median(v)) for k, v in groups.items()}


def test_median_without_values(rows):
    assert [r["metrics_value"] for r in exact_median(rows([(None,)], "a double"), ["a"]).collect()] == [None]


def test_median_of_a_load_without_key(rows):
    df = rows([(None, 1.0), (None, 4.0), ("x", 2.0)], "k string, a double")
    assert {r["k"]: r["metrics_value"] for r in exact_median(df, ["a"], ["k"]).collect()} == {None: 2.5, "x": 2.0}


def test_only_values_around_the_middle_are_ordered(spark):
    """Most distinct values never reach the window."""
    df = spark.range(200_000).selectExpr("cast(id * 7919 % 200003 as double) AS a")
    assert exact_median(df, ["a"]).first()["metrics_value"] == statistics.median(
        float(i * 7919 % 200003) for i in range(200_000)
    )


@pytest.mark.parametrize("block", [3, 100_000])
def test_batches(rows, block):
    rng = random.Random(4)
    ids = [7 if rng.random() < 0.34 else rng.randrange(2000) for _ in range(3000)]
    df = rows([(i,) for i in ids], "appid long")
    got = sorted(map(tuple, split_batches(df, "appid", 500, block).select("position", "batch", "appid").collect()))
    assert got == [(i, i // 500, v) for i, v in enumerate(sorted(ids))]


def test_batches_of_nothing(rows):
    assert split_batches(rows([], "appid long"), "appid", 5).count() == 0
    with pytest.raises(ValueError):
        split_batches(rows([], "appid long"), "appid", 0)
