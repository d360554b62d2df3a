import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sightlog.functions.hashing import with_audit
from sightlog.operators.limits import first_seen, latest_per_key, limit_by, with_global_max
from sightlog.plans.staging import staging_view
from sightlog.tables import CATALOG, PACKAGES, SALE_LOG

DAY = datetime(2025, 1, 1)


def log(rows, data):
    return with_audit(rows(data, "appid long, name string, last_update timestamp"), CATALOG)


def test_same_state_keeps_the_first_sighting(rows):
    raw = log(rows, [(1, "a", DAY + timedelta(days=d)) for d in (2, 0, 1)])
    got = staging_view(raw, CATALOG).collect()
    assert [(r["appid"], r["last_update"]) for r in got] == [(1, DAY)]
    assert "ver" not in got[0]


def test_returning_state_keeps_its_first_date(rows):
    raw = log(rows, [(1, n, DAY + timedelta(days=i)) for i, n in enumerate("ABA")])
    view = staging_view(raw, CATALOG)
    assert view.count() == 2
    assert latest_per_key(view, "appid", ["row_hash"]).first()["name"] == "B"


def test_daily_key(rows):
    at = [DAY, DAY + timedelta(hours=5), DAY + timedelta(days=1)]
    raw = with_audit(
        rows([(1, "a", t) for t in at], "appid long, name string, last_update timestamp"), SALE_LOG
    )
    got = {r["last_update"] for r in staging_view(raw, SALE_LOG).collect()}
    assert got == {at[0], at[2]}


def test_view_with_a_late_column(rows):
    raw = with_audit(
        rows(
            [(1, 2, "t", 5, "new", DAY + timedelta(days=1)), (1, 2, "t", 5, "old", DAY)],
            "appid long, packageid long, package_option_text string, "
            "package_price_with_discount long, name string, last_update timestamp",
        ),
        PACKAGES,
    )
    assert "name" not in staging_view(raw, PACKAGES).columns
    view = staging_view(raw, PACKAGES, [*PACKAGES.view_columns, "name"])
    assert [r["name"] for r in view.collect()] == ["old"]


@pytest.mark.parametrize("slices", [None, 4])
def test_limit_by_against_brute_force(rows, slices):
    rng = random.Random(3)
    # one key holds most rows
    data = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(20), i) for i in range(400)]
    df = rows(data, "k long, v long, i long")
    expected = set()
    for key in {k for k, _, _ in data}:
        mine = sorted((r for r in data if r[0] == key), key=lambda r: (-r[1], r[2]))
        expected |= set(mine[:3])
    got = limit_by(df, 3, ["k"], [F.desc("v")], ["i"], slices)
    assert {tuple(r) for r in got.collect()} == expected
    assert got.columns == ["k", "v", "i"]


def test_limit_by_needs_a_tie_breaker(rows):
    df = rows([(1, 2)], "k long, v long")
    with pytest.raises(ValueError):
        limit_by(df, 1, ["k"], ["v"], [])
    with pytest.raises(ValueError):
        limit_by(df, 0, ["k"], ["v"], ["v"])


def test_limit_is_pushed_below_the_shuffle(rows):
    plan = limit_by(rows([(1, 2, 3)], "k long, v long, i long"), 2, ["k"], ["v"], ["i"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in text and "WindowGroupLimit" in text


def test_first_seen_equals_limit_by(rows):
    rng = random.Random(5)
    data = [(rng.randrange(5), rng.choice("ab"), DAY + timedelta(hours=rng.randrange(90))) for _ in range(200)]
    raw = log(rows, data)
    fast = first_seen(raw, ["appid", "row_hash"], ["appid", "name", "row_hash"])
    slow = limit_by(raw, 1, ["appid", "row_hash"], ["last_update"], ["name"]).select(*fast.columns)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))


def test_global_max_does_not_gather_rows(rows):
    df = rows([(1, 5), (2, 9)], "k long, v long")
    got = with_global_max(df, "v", "m")
    assert {tuple(r) for r in got.collect()} == {(1, 5, 9), (2, 9, 9)}
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
