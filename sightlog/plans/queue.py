"""The work queue: which entities to fetch next.

Three arms: entities whose sale status changed on the run date, entities never fetched, and
on Sundays a retry of failed or undated cards.  Every input is first reduced to what the
queue needs per entity, so all joins run on one partitioning by ``appid``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from sightlog.functions.scalar import instant, run_date_or_default, week_start
from sightlog.operators.limits import latest_per_key, limit_by

# ``appid`` is a required column.  Saying so on every input gives the joins below the same
# scan to share: Spark adds this filter itself, but only on some sides of some joins.
_KNOWN = "appid IS NOT NULL"

NEW_LIMIT = 2000
RETRY_LIMIT = 500
SALE_GAP_DAYS = 5


def current_cards(
    cards: DataFrame, tie_breaker: Sequence[str] = ("row_hash",)
) -> DataFrame:
    """Current card per entity: (appid, success, release_date, last_update).

    A state that was seen, left and seen again keeps its first date, so "current" is the
    state that appeared last.
    """
    return latest_per_key(cards.where(_KNOWN), "appid", tie_breaker).select(
        "appid", "success", "release_date", "last_update"
    )


def newest_load(current: DataFrame) -> DataFrame:
    """Newest sighting over all card states, as one row.

    The newest state of all is the current state of its entity, so current cards suffice.
    """
    return current.agg(F.max("last_update").alias("max_last_update"))


def latest_sales(
    sales: DataFrame, tie_breaker: Sequence[str] = ("row_hash",), n: int = 2
) -> DataFrame:
    """Latest ``n`` sale observations per entity: (appid, last_upd)."""
    return limit_by(sales.where(_KNOWN), n, ["appid"], [F.desc("last_update")], tie_breaker).select(
        "appid", F.to_date("last_update").alias("last_upd")
    )


def eligible_sales(sales_latest: DataFrame, current: DataFrame) -> DataFrame:
    """Latest sales of entities whose card succeeded or that have no card.

    The test looks at the entity only, so it commutes with the per-entity limit; limiting
    first keeps a much-observed entity from filling a join task.
    """
    card = current.select("appid", "success", F.lit(True).alias("has_card"))
    return (
        sales_latest.join(card, "appid", "left")
        .where(F.col("success") | F.col("has_card").isNull())
        .select("appid", "last_upd")
    )


def sale_transitions(eligible: DataFrame, run_date: date) -> DataFrame:
    """Entities on sale on the run date after a single sighting or a gap."""
    gap = F.datediff("newest", "oldest")
    return (
        eligible.groupBy("appid")
        .agg(F.max("last_upd").alias("newest"), F.min("last_upd").alias("oldest"))
        .where((gap == 0) | (gap > SALE_GAP_DAYS))
        .where(F.col("newest") == F.lit(run_date))
        .select("appid")
    )


def never_fetched(
    catalog: DataFrame, current: DataFrame, sales_latest: DataFrame,
    tie_breaker: Sequence[str] = ("row_hash",), limit: int = NEW_LIMIT,
    distinct_ids: bool = False,
) -> DataFrame:
    """Catalog rows without a card and never on sale, newest first.

    A renamed entity has several catalog rows and may repeat; ``distinct_ids`` keeps its
    newest row only.
    """
    catalog = catalog.where(_KNOWN)
    if distinct_ids:
        catalog = latest_per_key(catalog, "appid", tie_breaker)
    # One anti join for both tests, with bare shuffles on both sides: the form in which Spark
    # splits the partition of an entity that holds very many catalog rows.
    known = current.select("appid").unionByName(sales_latest.select("appid"))
    return (
        catalog.join(known, "appid", "left_anti")
        .orderBy(F.desc("last_update"), "appid", *tie_breaker)
        .limit(limit)
        .select("appid")
    )


def retry_failed(
    current: DataFrame, eligible: DataFrame, run_date: date, now: datetime | None = None,
    limit: int = RETRY_LIMIT,
) -> DataFrame:
    """On a Sunday without a load today: failed or undated cards not among eligible sales.

    The calendar test is a literal, so on other days the arm folds to an empty relation.
    """
    day = F.lit(run_date)
    today = F.to_date(F.current_timestamp() if now is None else instant(now))
    newest = newest_load(current).scalar()
    return (
        current.where(day == week_start(day))
        .where(F.to_date(newest) != today)
        .where((~F.col("success")) | F.col("release_date").isNull())
        .join(eligible.select("appid"), "appid", "left_anti")
        .orderBy(F.desc("appid"))
        .limit(limit)
        .select("appid")
    )


def fetch_queue(
    catalog: DataFrame,
    sales: DataFrame,
    cards: DataFrame,
    run_date: date | None = None,
    now: datetime | None = None,
    catalog_tie: Sequence[str] = ("row_hash",),
    sales_tie: Sequence[str] = ("row_hash",),
    cards_tie: Sequence[str] = ("row_hash",),
    distinct_ids: bool = False,
) -> DataFrame:
    """The queue over staging views: (appid), duplicates kept unless ``distinct_ids``.

    ``run_date`` and ``now`` are separate: the first belongs to the run, the second to the
    time of reading.
    """
    run_date = run_date_or_default(run_date)
    current = current_cards(cards, cards_tie)
    latest = latest_sales(sales, sales_tie)
    eligible = eligible_sales(latest, current)
    return (
        sale_transitions(eligible, run_date)
        .unionByName(
            never_fetched(catalog, current, latest, catalog_tie, distinct_ids=distinct_ids)
        )
        .unionByName(retry_failed(current, eligible, run_date, now))
    )


class QueueError(ValueError):
    """A queue that cannot be worked off."""


def require_workable(queue: DataFrame) -> None:
    """An empty queue and ids below 1 are errors."""
    found = queue.agg(F.count(F.lit(1)).alias("n"), F.min("appid").alias("least")).first()
    if not found["n"]:
        raise QueueError("the queue holds no ids")
    if found["least"] is None or found["least"] < 1:
        raise QueueError(f"ids must be 1 or more, the least is {found['least']}")


def export_queue(queue: DataFrame) -> DataFrame:
    """Queue in ascending id order, duplicates kept."""
    return queue.select("appid").orderBy("appid")
