"""Replace-merge compaction and loads that may be repeated."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from sightlog.functions.hashing import load_month, version
from sightlog.operators.limits import first_seen, limit_by
from sightlog.specs import TableSpec


def _with_month(df: DataFrame) -> DataFrame:
    return df if "load_month" in df.columns else df.withColumn("load_month", load_month())


def _late_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Payload columns in which two sightings of one state can differ."""
    return [c for c in df.columns if c in spec.payload and c not in spec.hash_columns]


def compact(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per (month, key): the earliest sighting.

    Where the state fixes the whole payload this is a hash aggregate; only tables with late
    columns need rows to be ranked.  A table that does not keep states (a plain log, such as
    the metrics) stays as it is: equal rows of it are different events.
    """
    if not spec.keep_states:
        return df
    dated = _with_month(df)
    keys = ["load_month", *spec.key]
    late = _late_columns(dated, spec)
    if late:
        kept = limit_by(dated, 1, keys, ["last_update"], late)
    else:
        fixed = [c for c in dated.columns if c not in ("last_update", "ver")]
        kept = first_seen(dated, keys, fixed).withColumn("ver", version())
    return kept.select(*df.columns)


def unseen(
    batch: DataFrame,
    target: DataFrame,
    spec: TableSpec,
    months: Sequence[date] | None = None,
) -> DataFrame:
    """Rows of ``batch`` whose key the target lacks in the same month, one per key.

    Both sides are reduced to one row per key before they meet, so repeated sightings of one
    state never pile up in a join task.  Only the target's partitions from the batch's first
    month to its last are read; ``months`` names them where the load knows them, else the two
    are scalar subqueries over the batch.  All rows of a plain log are new.
    """
    if not spec.keep_states:
        return batch
    exprs = ["load_month", *spec.key]
    names = [f"__k{i}" for i in range(len(exprs))]

    def keyed() -> list[Column]:
        return [F.expr(e).alias(n) for e, n in zip(exprs, names, strict=True)]

    known, dated = _with_month(target), _with_month(batch)
    if months is not None:
        known = known.where(F.col("load_month").isin(list(months)))
    else:
        first, last = (dated.agg(f("load_month")).scalar() for f in (F.min, F.max))
        known = known.where(F.col("load_month").between(first, last))
    known = known.select(*keyed()).distinct()
    dated = dated.select("*", *keyed())
    # ranked on the join keys, so the join below needs no second shuffle
    late = _late_columns(dated, spec) or ["row_hash"]
    fresh = limit_by(dated, 1, names, ["last_update"], late)
    return fresh.join(known, names, "left_anti").select(*batch.columns)


def idempotent_append(target: DataFrame, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Target plus the unseen rows of the batch; a second run adds nothing."""
    return target.unionByName(unseen(batch, target, spec))


def add_column(old: DataFrame, new: DataFrame, defaults: dict) -> DataFrame:
    """Old and new rows together; columns the old rows lack read as their default."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.fillna(defaults) if defaults else both
