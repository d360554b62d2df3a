import math
from datetime import date, datetime

import pytest

from sightlog.functions.hashing import with_audit
from sightlog.operators.quality import (
    CheckError,
    collect_metrics,
    compare_metrics,
    compare_series,
    freshness,
    measure,
    not_null,
    not_null_test,
    previous_metrics,
    require_stable,
    run_tests,
)
from sightlog.specs import Check
from sightlog.tables import PRICES

AT = datetime(2025, 11, 3, 0, 30)
CHECK = Check(medians=("price_initial", "price_final"))
HISTORY = (
    "dag_id string, schema_name string, table_name string, metrics_name string, "
    "agg_type string, metrics_value double, last_update timestamp"
)


def history(rows, *entries):
    return rows(
        [(load, "raw", "prices", name, "count", value, at) for load, name, value, at in entries],
        HISTORY,
    )


def test_collect(rows):
    df = rows([(1, 10, None), (2, 20, None), (3, None, None), (4, 40, None), (5, 50, None)],
              "appid long, price_initial long, price_final long")
    got = {r["metrics_name"]: r for r in collect_metrics(df, PRICES, CHECK, AT, "hourly").collect()}
    assert got["row_count"]["metrics_value"] == 5.0 and got["row_count"]["agg_type"] == "count"
    assert got["price_initial"]["metrics_value"] == 30.0 and got["price_initial"]["agg_type"] == "median"
    assert got["price_final"]["metrics_value"] is None
    assert {(r["dag_id"], r["schema_name"], r["table_name"], r["last_update"]) for r in got.values()} == {
        ("hourly", "raw", "prices", AT)}


def test_collect_empty_load(rows):
    df = rows([], "appid long, price_initial long, price_final long")
    got = {r["metrics_name"]: r["metrics_value"] for r in measure(df, CHECK).collect()}
    assert got == {"row_count": 0.0, "price_initial": None, "price_final": None}


def test_approximate_medians(rows):
    df = rows([(i, i) for i in range(101)], "price_initial long, price_final long")
    got = {r["metrics_name"]: r["metrics_value"] for r in measure(df, CHECK, approximate=True).collect()}
    assert got["price_initial"] == pytest.approx(50, abs=1)


@pytest.mark.parametrize("stamp", [datetime(2025, 11, 2), datetime(2025, 11, 2, 0, 30)])
def test_previous_is_found_at_any_time_of_day(rows, stamp):
    h = history(
        rows, ("hourly", "row_count", 7.0, stamp), ("hourly", "row_count", 5.0, datetime(2025, 11, 1)),
        ("hourly", "other", 5.0, stamp), ("weekly", "row_count", 9.0, datetime(2025, 11, 2, 5)),
        ("hourly", "row_count", 1.0, datetime(2025, 11, 4)),
    )
    got = previous_metrics(h, PRICES, CHECK, AT, "hourly").collect()
    assert [tuple(r) for r in got] == [("row_count", 7.0)]


def test_previous_is_inclusive(rows):
    h = history(rows, ("hourly", "row_count", 7.0, AT))
    assert previous_metrics(h, PRICES, CHECK, AT, "hourly").count() == 1


@pytest.mark.parametrize(
    "new, old, status",
    [
        (120.0, 100.0, "ok"), (121.0, 100.0, "warn"), (100.0, 121.0, "warn"),
        (150.0, 100.0, "warn"), (151.0, 100.0, "error"), (100.0, 151.0, "error"),
        (0.0, 100.0, "skip"), (100.0, 0.0, "skip"), (None, 100.0, "skip"), (100.0, None, "skip"),
        (math.nan, 100.0, "ok"),
    ],
)
def test_drift_classes(rows, new, old, status):
    metrics = rows([("row_count", new)], "metrics_name string, metrics_value double")
    previous = rows([("row_count", old)], "metrics_name string, old_value double")
    got = compare_metrics(metrics, previous, CHECK).collect()
    assert [r["status"] for r in got] == [status]
    if status == "error":
        with pytest.raises(CheckError):
            require_stable(got, PRICES)
    else:
        require_stable(got, PRICES)


def test_first_load_is_skipped(rows):
    metrics = rows([("row_count", 5.0)], "metrics_name string, metrics_value double")
    previous = rows([], "metrics_name string, old_value double")
    assert compare_metrics(metrics, previous, CHECK).first()["status"] == "skip"


def test_empty_load_can_be_an_error(rows):
    check = Check(empty_stops=True)
    metrics = rows([("row_count", 0.0)], "metrics_name string, metrics_value double")
    previous = rows([("row_count", 5.0)], "metrics_name string, old_value double")
    assert compare_metrics(metrics, previous, check).first()["status"] == "error"


def test_series(rows):
    df = rows([("a", 1, 10.0), ("a", 2, 13.0), ("a", 3, 13.0), ("b", 1, 1.0)],
              "s string, last_update int, metrics_value double")
    got = {(r["s"], r["last_update"]): r["status"] for r in compare_series(df, Check(), ["s"]).collect()}
    assert got == {("a", 1): "skip", ("a", 2): "warn", ("a", 3): "ok", ("b", 1): "skip"}


@pytest.mark.parametrize("day, failed", [(3, 0), (4, 0), (2, 0), (5, 1), (1, 1)])
def test_freshness(rows, day, failed):
    df = rows([(datetime(2025, 11, 3, 23, 59),), (datetime(2025, 10, 1),)], "last_update timestamp")
    assert freshness(df, date(2025, 11, day)).count() == failed


def test_empty_table_is_not_fresh(rows):
    got = freshness(rows([], "last_update timestamp"), date(2025, 11, 3)).collect()
    assert [r["last_observed_date"] for r in got] == [date(1970, 1, 1)]


def test_run_tests_stores_failures(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS dq_test")
    df = rows([(1, None), (2, "x")], "appid long, name string")
    tests = [not_null_test("null_name", df, "name"), not_null_test("null_id", df, "appid", "error"),
             not_null_test("strict", df, "name", "error")]
    for _ in range(2):
        outcomes = run_tests(tests, "dq_test")
    assert [(o.name, o.status, o.failures) for o in outcomes] == [
        ("null_name", "warn", 1), ("null_id", "pass", 0), ("strict", "error", 1)]
    assert spark.table("dq_test.null_name").first()["appid"] == 1
    assert not spark.catalog.tableExists("dq_test.null_id")
    run_tests([not_null_test("null_name", df.where("name IS NOT NULL"), "name")], "dq_test")
    assert not spark.catalog.tableExists("dq_test.null_name")


def test_metrics_hash_ignores_the_load(rows):
    from sightlog.tables import METRICS

    h = history(rows, ("hourly", "row_count", 7.0, AT), ("weekly", "row_count", 7.0, AT))
    assert with_audit(h, METRICS).select("row_hash").distinct().count() == 1
