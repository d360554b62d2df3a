"""State identity and the audit columns every stored row carries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sightlog.functions.scalar import instant
from sightlog.specs import TableSpec

NULL_MARK = "\\N"


def canonical_text(name: str, dtype: T.DataType) -> Column:
    """Text form of a value that keeps different values different.

    Arrays print as JSON (a plain cast would make ``['a, b']`` equal ``['a', 'b']``), a null
    array counts as empty because that is how it is stored, booleans print as 0/1, and null
    prints as a marker because Spark's hash functions skip nulls.
    """
    value = F.col(name)
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.to_json(value), F.lit("[]"))
    if isinstance(dtype, T.BooleanType):
        value = value.cast("int")
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.coalesce(value.cast("string"), F.lit(NULL_MARK))


def row_hash(df: DataFrame, columns: Sequence[str], algorithm: str = "xxhash64") -> Column:
    """Hash over ``columns`` in order.

    ``xxhash64`` is the fast form.  ``md5`` hashes length-prefixed text and gives the same
    hex in any engine.
    """
    texts = [canonical_text(c, df.schema[c].dataType) for c in columns]
    if algorithm == "xxhash64":
        return F.xxhash64(*texts)
    if algorithm == "md5":
        prefixed = [F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]
        return F.md5(F.concat(*prefixed))
    raise ValueError(f"unknown hash algorithm {algorithm!r}")


def version(at: str = "last_update") -> Column:
    """Negated milliseconds, so the highest version is the earliest sighting."""
    return -F.unix_millis(F.col(at).cast("timestamp"))


def load_month(at: str = "last_update") -> Column:
    return F.trunc(F.col(at), "MM")


def load_time(now: datetime | None = None) -> Column:
    """Load stamp in whole seconds; pass ``now`` to make a load repeatable."""
    stamp = F.current_timestamp() if now is None else instant(now)
    return F.date_trunc("second", stamp)


def with_audit(df: DataFrame, spec: TableSpec, now: datetime | None = None) -> DataFrame:
    """Payload in declared order plus row_hash, last_update, ver and load_month.

    A frame that already carries ``last_update`` keeps it.  Null arrays become empty.
    """
    payload = [
        F.coalesce(F.col(c.name), F.array().cast(c.spark_type)).alias(c.name)
        if c.is_array else F.col(c.name)
        for c in spec.columns
    ]
    at = F.col("last_update") if "last_update" in df.columns else load_time(now)
    stamped = df.select(*payload, at.alias("last_update"))
    return stamped.select(
        *spec.payload,
        row_hash(stamped, spec.hash_columns, spec.hash_algorithm).alias("row_hash"),
        "last_update",
        version().alias("ver"),
        load_month().alias("load_month"),
    )
