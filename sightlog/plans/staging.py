"""Staging views: raw tables with every repeated sighting of a state collapsed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sightlog.operators.limits import first_seen, limit_by
from sightlog.sources.warehouse import Warehouse
from sightlog.specs import SpecError, TableSpec
from sightlog.tables import RAW_TABLES


def staging_view(
    raw: DataFrame, spec: TableSpec, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key with its first sighting; ``ver`` stays internal.

    ``columns`` asks for fewer payload columns, and then only those are read.
    """
    if not spec.keep_states:
        raise SpecError(f"{spec.full_name} is a plain log and has no states to collapse")
    wanted = list(spec.view_columns if columns is None else columns)
    out = [*wanted, "row_hash"]
    if set(wanted) <= set(spec.hash_columns):
        return first_seen(raw, spec.key, out)
    loose = [c for c in wanted if c not in spec.hash_columns]
    return limit_by(raw, 1, spec.key, ["last_update"], loose).select(*out, "last_update")


def staging_views(warehouse: Warehouse, specs: Sequence[TableSpec] = RAW_TABLES) -> dict[str, DataFrame]:
    """Staging views over the raw tables of a catalog, by table name."""
    return {s.name: staging_view(warehouse.read(s), s) for s in specs}


def register(views: dict[str, DataFrame], prefix: str = "stg_") -> None:
    """Make views available to SQL; they are computed anew whenever they are read."""
    for name, view in views.items():
        view.createOrReplaceTempView(f"{prefix}{name}")


def resolve(spark: SparkSession, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """A source by name: a frame handed in, or else the catalog table or view."""
    if given and name in given:
        return given[name]
    return spark.table(name)
