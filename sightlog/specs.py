"""Declared tables: columns with constraints, dedup key, partitioning and load checks.

One declaration drives everything else: the Spark schema, the table DDL, the state hash,
the validation rules and the data-quality metrics of a table.
"""

from __future__ import annotations

import types
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any, Union, get_args, get_origin

from pyspark.sql import types as T


class SpecError(ValueError):
    """A declaration that cannot be turned into a table."""


# The supported column types and their Spark types.
SPARK_TYPES: dict[Any, T.DataType] = {
    int: T.LongType(),
    float: T.DoubleType(),
    str: T.StringType(),
    bool: T.BooleanType(),
    datetime: T.TimestampType(),
    list[str]: T.ArrayType(T.StringType()),
    list[int]: T.ArrayType(T.LongType()),
    list[float]: T.ArrayType(T.DoubleType()),
}


@dataclass(frozen=True)
class Column:
    """One payload column.

    ``type`` is a Python annotation such as ``int`` or ``str | None``; a plain type is
    required, an optional one may be null.
    """

    name: str
    type: Any
    ge: float | None = None
    blank_to_null: bool = False

    def __post_init__(self) -> None:
        self.spark_type  # noqa: B018 - fail at declaration, not at first use

    @property
    def optional(self) -> bool:
        return get_origin(self.type) in (Union, types.UnionType)

    @property
    def required(self) -> bool:
        return not self.optional

    @property
    def base_type(self) -> Any:
        if not self.optional:
            return self.type
        members = set(get_args(self.type))
        concrete = members - {type(None)}
        if len(concrete) != 1 or len(members) != 2:
            raise SpecError(f"column {self.name!r}: only 'T | None' unions are supported")
        return concrete.pop()

    @property
    def spark_type(self) -> T.DataType:
        base = self.base_type
        if base not in SPARK_TYPES:
            raise SpecError(f"column {self.name!r}: unsupported type {base!r}")
        return SPARK_TYPES[base]

    @property
    def is_array(self) -> bool:
        return isinstance(self.spark_type, T.ArrayType)


@dataclass(frozen=True)
class Limits:
    """Relative drift above which a metric is reported, and above which it stops the load."""

    # The shares of the previous value.
    report: float = 0.20
    stop: float = 0.50


@dataclass(frozen=True)
class Check:
    """What a load is compared on with the load before: its rows and medians of columns.

    An empty load passes, as there is nothing to compare, unless ``empty_stops``.
    """

    medians: tuple[str, ...] = ()
    limits: Limits = Limits()
    rows_as: str = "row_count"
    empty_stops: bool = False

    @property
    def measures(self) -> dict[str, str]:
        """Kind of each metric by its name."""
        return {self.rows_as: "count"} | dict.fromkeys(self.medians, "median")


@dataclass(frozen=True)
class TableSpec:
    """A table of observations.

    ``key`` holds SQL expressions over the payload and audit columns; rows that agree on the
    key are sightings of one state.  ``hash_columns`` names the payload columns that make up
    a state; a column added after the table was created stays out of it.
    ``keep_states=False`` declares a plain append-only table.
    """

    schema: str
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    hash_columns: tuple[str, ...] = ()
    view_columns: tuple[str, ...] = ()
    check: Check | None = None
    keep_states: bool = True
    hash_algorithm: str = "xxhash64"
    added_defaults: dict[str, Any] = field(default_factory=dict, hash=False)

    def __post_init__(self) -> None:
        for label, value in (("schema", self.schema), ("name", self.name),
                             ("columns", self.columns), ("key", self.key)):
            if not value:
                raise SpecError(f"table {self.schema}.{self.name}: {label} must not be empty")
        names = [c.name for c in self.columns]
        if len(names) != len(set(names)):
            raise SpecError(f"table {self.full_name}: duplicate column names")
        if not self.hash_columns:
            object.__setattr__(self, "hash_columns", tuple(names))
        if not self.view_columns:
            object.__setattr__(self, "view_columns", tuple(names))
        unknown = {*self.hash_columns, *self.view_columns} - set(names)
        if self.check:
            unknown |= set(self.check.medians) - set(names)
        if unknown:
            raise SpecError(f"table {self.full_name}: unknown columns {sorted(unknown)}")

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.name}"

    @property
    def payload(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def struct(self) -> T.StructType:
        """Schema of the payload, as staged before a load."""
        return T.StructType(
            [T.StructField(c.name, c.spark_type, not c.required) for c in self.columns]
        )

    def stored_struct(self) -> T.StructType:
        """Schema at rest: payload, audit columns, month partition."""
        hash_type = T.LongType() if self.hash_algorithm == "xxhash64" else T.StringType()
        audit = [
            T.StructField("row_hash", hash_type),
            T.StructField("last_update", T.TimestampType()),
            T.StructField("ver", T.LongType()),
            T.StructField("load_month", T.DateType()),
        ]
        return T.StructType(
            [T.StructField(c.name, c.spark_type) for c in self.columns] + audit
        )

    def ddl(self) -> str:
        body = ",\n  ".join(
            f"`{f.name}` {f.dataType.simpleString().upper()}" for f in self.stored_struct()
        )
        return (
            f"CREATE TABLE IF NOT EXISTS {self.full_name} (\n  {body}\n)\n"
            "USING parquet\nPARTITIONED BY (load_month)"
        )
