"""Clustering on several columns at once.

Rows ordered by one column put each value of it into few files and spread every other column over
all of them.  Here each column is cut into ranges of about equal numbers of rows, and the bits of
the range numbers are interleaved: rows that are near in all columns get near numbers, so a filter on
any one of the columns leaves most files out by their minimum and maximum.

Nulls count as the first range.  Texts are ranged by their first seven bytes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Bits of a range number: 2^BITS ranges a column.
BITS = 8
_TEXT_BYTES = 7


def _number(df: DataFrame, name: str) -> Column:
    """A number with the order of a column's values."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return value.cast("int")
    if isinstance(kind, T.StringType):
        begin = F.hex(F.substring(F.encode(value, "UTF-8"), 1, _TEXT_BYTES))
        return F.conv(F.rpad(begin, 2 * _TEXT_BYTES, "0"), 16, 10).cast("bigint")
    if isinstance(kind, T.DecimalType):
        return value.cast("double")
    if isinstance(kind, T.NumericType):
        return value
    raise TypeError(f"column {name!r}: {kind.simpleString()} values cannot be clustered by")


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """The lower bounds of all ranges but the first of each column, from one pass over all rows.

    2^bits - 1 numbers a column come to the driver, however many rows there are; a column without
    values has no bounds.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(
        *[F.percentile_approx(_number(df, c), F.lit(shares), F.lit(20 * 2**bits)).alias(str(i)) for i, c in enumerate(columns)]
    ).first()
    return {c: list(found[i] or []) for i, c in enumerate(columns)}


def _range_of(number: Column, bounds: Sequence, bits: int) -> Column:
    """How many bounds a number reaches, by halving."""
    if not bounds:
        return F.lit(0)
    held = F.lit(list(bounds))
    steps = F.array(*[F.lit(2**i) for i in reversed(range(bits))])
    reached = F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(number >= F.element_at(held, at + step), step).otherwise(F.lit(0))
    )
    return F.coalesce(reached, F.lit(0))


def cluster_key(df: DataFrame, bounds: dict[str, list], bits: int = BITS) -> Column:
    """Interleaved bits of the columns' range numbers, the highest bits of all columns first."""
    if bits * len(bounds) > 63:
        raise ValueError(f"{len(bounds)} columns of {bits} bits do not fit a bigint")
    key = F.lit(0).cast("bigint")
    for place, (name, limits) in enumerate(reversed(bounds.items())):
        number = _range_of(_number(df, name), limits, bits).cast("bigint")
        for bit in range(bits):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(bounds) + place))
    return key


def clustered(
    df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), files: int | None = None,
    bits: int = BITS, bounds: dict[str, list] | None = None,
) -> DataFrame:
    """``df`` dealt and sorted for writing, so that filters on any of ``columns`` skip files.

    Rows stay apart by ``within`` first (a partition column).  Rows alike in all columns are dealt on by
    a hash of the row, so one hot value is not one task.  ``files`` sets their number; otherwise it
    follows the size.  ``bounds`` are those of ``range_bounds``, if they are known.
    """
    names, key, deal = df.columns, "__cluster_key", "__cluster_deal"
    limits = bounds if bounds is not None else range_bounds(df, columns, bits)
    hashable = [f"`{f.name}`" for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [*[F.col(f"`{c}`") for c in within], F.col(key), *[F.col(f"`{c}`") for c in columns]]
    keyed = df.withColumns({key: cluster_key(df, limits, bits), deal: F.xxhash64(*hashable)})
    spread = [*order, F.col(deal)]
    dealt = keyed.repartitionByRange(*spread) if files is None else keyed.repartitionByRange(files, *spread)
    return dealt.sortWithinPartitions(*order).select(*[F.col(f"`{c}`") for c in names])


def file_ranges(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value of each column in every file of a table that is read from files."""
    return stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[f(f"`{c}`").alias(f"{label}_{c}") for c in columns for label, f in (("min", F.min), ("max", F.max))]
    )
