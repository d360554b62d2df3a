"""The store's jobs end to end: page loads, card loads, views, queue and table tests."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from sightlog.functions.scalar import run_date_or_default
from sightlog.operators import flatten
from sightlog.operators.pages import missing_ranges, require_totals
from sightlog.operators.quality import (
    CheckError,
    TestOutcome,
    freshness_test,
    not_null_test,
    run_tests,
)
from sightlog.plans.load import TABLE_CHECK, gated_load
from sightlog.plans.queue import export_queue, fetch_queue, require_workable
from sightlog.plans.staging import register, staging_view, staging_views
from sightlog.sources import staged
from sightlog.sources.warehouse import Warehouse
from sightlog.specs import Check, TableSpec
from sightlog.tables import (
    CARDS,
    CATALOG,
    METRICS,
    NOT_NULL_RAW,
    NOT_NULL_VIEWS,
    RAW_TABLES,
    SALE_LOG,
    SNAPSHOTS,
)

logger = logging.getLogger(__name__)

QUEUE_VIEW = "fetch_queue"


@dataclass(frozen=True)
class SearchReport:
    """What a search load did not get: pages that never landed, items without an id."""

    missing_pages: int | None
    dropped_items: int


def load_search(
    warehouse: Warehouse, landing: DataFrame, run_dir: str, at: datetime, load: str,
    spec: TableSpec = CATALOG, now: datetime | None = None, metrics_spec: TableSpec = METRICS,
    check: Check | None | str = TABLE_CHECK, page_rows: int | None = None, max_rows: int | None = None,
) -> SearchReport:
    """Landed search pages into the catalog, or into the sale log.

    Every page must announce a usable total.  Metric history is kept per ``load``, so daily
    slices and full crawls of one table are not compared with each other; ``check=None`` loads
    a crawl without comparing it.  Where pages carry their ``offset``, ``page_rows`` asks for
    those that did not land, up to ``max_rows`` in a bounded walk.
    """
    pages = require_totals(landing)
    missing = None
    if page_rows is not None:
        totals = pages.agg(F.max("total_count").alias("total_count"))
        gaps = missing_ranges(pages, totals, [], page_rows, max_rows=max_rows)
        missing = gaps.agg(F.coalesce(F.sum("pages"), F.lit(0))).first()[0]
        if missing:
            logger.warning("%s: %d pages did not land", spec.full_name, missing)
    path = f"{run_dir}/{spec.name}"
    staged.stage(flatten.search_rows(landing), spec, path)
    dropped = flatten.search_items(landing).where(F.col("appid").isNull()).count()
    if dropped:
        logger.warning("%s: %d items without an id dropped", spec.full_name, dropped)
    gated_load(warehouse, spec, path, at, load, now, metrics_spec=metrics_spec, check=check)
    return SearchReport(missing, dropped)


def load_cards(
    warehouse: Warehouse, landing: DataFrame, run_dir: str, at: datetime, load: str,
    now: datetime | None = None, metrics_spec: TableSpec = METRICS,
) -> None:
    """Landed card responses into cards, prices and packages.

    The three tables are gated one by one: one that drifts does not hold back the others.
    After all three were tried, those refused are raised together.
    """
    paths = staged.fan_out(landing, run_dir)
    refused: list[CheckError] = []
    for spec, _ in staged.CARD_STREAMS:
        try:
            gated_load(warehouse, spec, paths[spec.name], at, load, now, metrics_spec=metrics_spec)
        except CheckError as e:
            refused.append(e)
    if refused:
        raise ExceptionGroup(f"{load}: tables refused", refused)


def load_snapshots(
    warehouse: Warehouse, landing: DataFrame, run_dir: str, at: datetime, load: str,
    now: datetime | None = None,
) -> None:
    """Landed keyed pages into the snapshot table."""
    path = f"{run_dir}/{SNAPSHOTS.name}"
    staged.stage(flatten.keyed_rows(landing, SNAPSHOTS), SNAPSHOTS, path)
    gated_load(warehouse, SNAPSHOTS, path, at, load, now)


def build_views(
    warehouse: Warehouse, run_date: date | None = None, now: datetime | None = None,
    specs: Sequence[TableSpec] = RAW_TABLES,
) -> dict[str, DataFrame]:
    """Staging views and the queue, registered for SQL."""
    views = staging_views(warehouse, specs)
    register(views)
    queue = fetch_queue(
        views[CATALOG.name], views[SALE_LOG.name], views[CARDS.name], run_date, now
    )
    queue.createOrReplaceTempView(QUEUE_VIEW)
    return {**views, QUEUE_VIEW: queue}


def export(views: dict[str, DataFrame], path: str) -> None:
    """Queue rows in id order as Parquet; a queue that cannot be worked off is an error."""
    queue = views[QUEUE_VIEW]
    require_workable(queue)
    export_queue(queue).write.mode("overwrite").parquet(path)


def check_tables(
    warehouse: Warehouse, views: dict[str, DataFrame], run_date: date | None = None,
    schema: str = "dbt_dq",
) -> list[TestOutcome]:
    """All declared not-null tests and the freshness of the snapshots; failing rows are stored."""
    warehouse.create_databases([schema])
    tests = []
    for s in RAW_TABLES:
        rows = warehouse.read(s)
        tests += [not_null_test(f"raw_{s.name}_{c}_not_null", rows, c) for c in NOT_NULL_RAW[s.name]]
    for name, columns in NOT_NULL_VIEWS.items():
        tests += [not_null_test(f"stg_{name}_{c}_not_null", views[name], c) for c in columns]
    snapshots = staging_view(warehouse.read(SNAPSHOTS), SNAPSHOTS, ["appid"])
    tests.append(freshness_test("stg_snapshots_is_fresh", snapshots, run_date_or_default(run_date)))
    return run_tests(tests, schema)
