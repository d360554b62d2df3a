"""Load metrics, drift against the previous load, and table tests."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from sightlog.functions.scalar import days_apart, instant, relative_drift
from sightlog.operators.ranks import band_rows, bands, exact_medians
from sightlog.specs import Check, TableSpec

EPOCH = date(1970, 1, 1)


class CheckError(RuntimeError):
    """A load that differs too much from the one before it."""


def measure(
    df: DataFrame, check: Check, by: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Row count and medians, long form: (by..., metrics_name, agg_type, metrics_value).

    ``by`` measures several loads at once.  A column without values has a null median.  One
    pass counts rows and finds the medians, or with exact ones the values around them, which a
    second pass orders.
    """
    by = list(by)
    around = bands(df, check.medians, by)
    rows = around.select(
        *by, F.lit(check.rows_as).alias("metrics_name"), F.lit("count").alias("agg_type"),
        F.col("rows").cast("double").alias("metrics_value"),
    )
    if not check.medians:
        return rows
    named = band_rows(around, check.medians, by)
    if approximate:
        medians = named.withColumn("metrics_value", F.col("middle"))
    else:
        medians = exact_medians(df, check.medians, by, named)
    return rows.unionByName(
        medians.select(*by, "metrics_name", F.lit("median").alias("agg_type"), "metrics_value")
    )


def collect_metrics(
    df: DataFrame, spec: TableSpec, check: Check, at: datetime, load: str,
    approximate: bool = False,
) -> DataFrame:
    """Metric rows of one load, ready for the metrics table."""
    return measure(df, check, approximate=approximate).select(
        F.lit(load).alias("dag_id"),
        F.lit(spec.schema).alias("schema_name"),
        F.lit(spec.name).alias("table_name"),
        "metrics_name", "agg_type", "metrics_value",
        instant(at).alias("last_update"),
    )


def previous_metrics(
    history: DataFrame, spec: TableSpec, check: Check, at: datetime | Column, load: str
) -> DataFrame:
    """Metrics of the latest load of the same kind, up to and including ``at``.

    "Latest" compares full timestamps, so a load stamped at any time of day is found.
    """
    at = at if isinstance(at, Column) else instant(at)
    same = history.where(
        (F.col("dag_id") == load)
        & (F.col("schema_name") == spec.schema)
        & (F.col("table_name") == spec.name)
    )
    last = same.where(F.col("last_update") <= at).agg(F.max("last_update")).scalar()
    return same.where(
        (F.col("last_update") == last) & F.col("metrics_name").isin(*check.measures)
    ).select("metrics_name", F.col("metrics_value").alias("old_value"))


def drift_columns(new: Column, old: Column, check: Check) -> list[Column]:
    """``drift`` and its class: ok, warn, error, or skip when there is nothing to compare."""
    drift = relative_drift(new, old)
    status = (
        F.when(drift.isNull(), "skip")
        .when(F.isnan(drift), "ok")  # Spark orders NaN above every number
        .when(drift > check.limits.stop, "error")
        .when(drift > check.limits.report, "warn")
        .otherwise("ok")
    )
    if check.empty_stops:
        status = F.when(new.isNull() | (new == 0), "error").otherwise(status)
    return [drift.alias("drift"), status.alias("status")]


def compare_metrics(metrics: DataFrame, previous: DataFrame, check: Check) -> DataFrame:
    """Each new metric with its old value, drift and status; without history all are skip."""
    return metrics.join(previous, "metrics_name", "left").select(
        "metrics_name", F.col("metrics_value").alias("new_value"), "old_value",
        *drift_columns(F.col("metrics_value"), F.col("old_value"), check),
    )


def compare_series(
    metrics: DataFrame, check: Check, series: Sequence[str], at: str = "last_update"
) -> DataFrame:
    """Drift of every load against the one before it, within each series of loads."""
    previous = F.lag("metrics_value").over(Window.partitionBy(*series).orderBy(at))
    return metrics.withColumn("old_value", previous).select(
        *series, at, F.col("metrics_value").alias("new_value"), "old_value",
        *drift_columns(F.col("metrics_value"), F.col("old_value"), check),
    )


def require_stable(compared: list, spec: TableSpec) -> None:
    """Stop the load if any compared metric is an error."""
    moved = [
        f"{r['metrics_name']} went from {r['old_value']} to {r['new_value']}"
        for r in compared if r["status"] == "error"
    ]
    if moved:
        raise CheckError(f"load of {spec.full_name} refused: {'; '.join(moved)}")


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows that fail the not-null test."""
    return df.where(F.col(column).isNull())


def freshness(
    df: DataFrame, run_date: date, max_days: int = 1, at: str = "last_update"
) -> DataFrame:
    """A row when the newest date is further than ``max_days`` from the run date, else none.

    An empty table counts as last seen at the epoch, so it fails.
    """
    newest = F.coalesce(F.max(F.to_date(at)), F.lit(EPOCH))
    return (
        df.agg(newest.alias("last_observed_date"))
        .select("last_observed_date", F.lit(run_date).alias("expected_date"))
        .where(days_apart(F.col("last_observed_date"), F.col("expected_date")) > max_days)
    )


@dataclass(frozen=True)
class TableTest:
    """A named test of a table: an aggregate that counts its failures, and the failing rows."""

    name: str
    rows: DataFrame
    failures: Column
    failing: Callable[[DataFrame], DataFrame]
    severity: str = "warn"


@dataclass(frozen=True)
class TestOutcome:
    name: str
    status: str
    failures: int


def not_null_test(name: str, rows: DataFrame, column: str, severity: str = "warn") -> TableTest:
    return TableTest(
        name, rows, F.count_if(F.col(column).isNull()), lambda df: not_null(df, column), severity
    )


def freshness_test(
    name: str, rows: DataFrame, run_date: date, max_days: int = 1, severity: str = "warn"
) -> TableTest:
    newest = F.coalesce(F.max(F.to_date("last_update")), F.lit(EPOCH))
    stale = days_apart(newest, F.lit(run_date)) > max_days
    return TableTest(
        name, rows, stale.cast("bigint"), lambda df: freshness(df, run_date, max_days), severity
    )


def run_tests(tests: Sequence[TableTest], schema: str = "dbt_dq") -> list[TestOutcome]:
    """Pass, warn or error of each test, with the failing rows as a table in ``schema``.

    All tests of one frame are counted in one pass over it; rows are read again and stored only
    for tests that fail.  The table of a test that passes is dropped.
    """
    frames: dict[int, list[TableTest]] = {}
    for test in tests:
        frames.setdefault(id(test.rows), []).append(test)
    counts: dict[str, int] = {}
    for group in frames.values():
        measured = [t.failures.alias(f"t{i}") for i, t in enumerate(group)]
        found = group[0].rows.agg(*measured).first()
        counts |= {t.name: found[f"t{i}"] for i, t in enumerate(group)}
    for test in tests:
        spark, table = test.rows.sparkSession, f"{schema}.{test.name}"
        if counts[test.name]:
            test.failing(test.rows).write.mode("overwrite").saveAsTable(table)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return [TestOutcome(t.name, t.severity if counts[t.name] else "pass", counts[t.name]) for t in tests]
