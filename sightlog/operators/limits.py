"""Per-key limits: keep the first n rows of each key, or the first sighting of each state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"
_SLICE = "__slice"


def limit_by(
    df: DataFrame,
    n: int,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    tie_breaker: Sequence[str | Column],
    slices: int | None = None,
) -> DataFrame:
    """First ``n`` rows per key under ``order``; ``tie_breaker`` makes the choice unique.

    Spark pushes a ``row_number() <= n`` filter below the shuffle, so each map task sends at
    most n rows per key and one hot key stays small.  With ``slices`` rows are first ranked
    within that many hashed slices of each key: ask for it where n is so large that Spark
    does not push the filter (``spark.sql.optimizer.windowGroupLimitThreshold``).
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if not tie_breaker:
        raise ValueError("a tie_breaker is required: equal order values have no fixed order")
    key_columns = [F.expr(k) if isinstance(k, str) else k for k in keys]
    ordering = [*order, *tie_breaker]
    if slices is not None:
        hashed = F.pmod(F.xxhash64(*df.columns), F.lit(slices))
        df = _ranked(df.withColumn(_SLICE, hashed), n, [*key_columns, F.col(_SLICE)], ordering)
        df = df.drop(_SLICE)
    return _ranked(df, n, key_columns, ordering)


def _ranked(df: DataFrame, n: int, keys: list[Column], ordering: list) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def first_seen(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], at: str = "last_update"
) -> DataFrame:
    """One row per key with the earliest ``at``; ``columns`` must be determined by the key.

    Because the kept columns are the same for every sighting of a state, this is a plain
    ``min``: a hash aggregate with map-side combine, no sort and no hot-key risk.
    """
    names = list(dict.fromkeys(columns))
    derived = [F.expr(k).alias(f"__key{i}") for i, k in enumerate(keys) if k not in names]
    return (
        df.groupBy(*names, *derived)
        .agg(F.min(at).alias(at))
        .select(*names, at)
    )


def latest_per_key(
    df: DataFrame, key: str, tie_breaker: Sequence[str | Column], at: str = "last_update"
) -> DataFrame:
    """Current row per key."""
    return limit_by(df, 1, [key], [F.desc(at)], tie_breaker)


def with_global_max(df: DataFrame, column: str, alias: str) -> DataFrame:
    """Each row with the maximum over the whole frame.

    A scalar subquery: the maximum is pre-aggregated in every task.  A window over the whole
    frame would move all rows to one partition.
    """
    return df.withColumn(alias, df.agg(F.max(column)).scalar())
