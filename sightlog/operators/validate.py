"""Typed rows from text rows, with every broken rule named.

Coercion is lenient about spelling (``"18"`` is 18) and strict about meaning (``"18+"`` is a
violation, never a silent null).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sightlog.functions.scalar import blank_to_null, stripped
from sightlog.specs import Column as SpecColumn, TableSpec

VIOLATIONS = "violations"
_RAW = "__raw_"

# Accepted spellings of booleans.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")


class ValidationError(ValueError):
    """Rows broke declared rules; ``counts`` maps 'column:rule' to the number of rows."""

    def __init__(self, table: str, counts: dict[str, int]):
        self.counts = counts
        listed = ", ".join(f"{rule} x{n}" for rule, n in sorted(counts.items()))
        super().__init__(f"{table}: {listed}")


def _from_text(text: Column, target: T.DataType) -> Column:
    if isinstance(target, T.StringType):
        return text
    word = stripped(text)
    if isinstance(target, T.LongType):
        # "18.0" and "1_000" are whole numbers too; plain digits take the short way
        whole = F.regexp_replace(word, r"^([+-]?\d+)\.0+$", "$1")
        digits = F.regexp_replace(whole, r"(?<=\d)_(?=\d)", "")
        return F.coalesce(text.try_cast(target), digits.try_cast(target))
    if isinstance(target, T.DoubleType):
        # the cast alone would take type suffixes such as "1.5d"
        lowered = F.lower(word)
        suffixed = F.right(lowered, F.lit(1)).isin("d", "f") & ~lowered.endswith("inf")
        return F.when(~suffixed, word.try_cast(target))
    if isinstance(target, T.BooleanType):
        lowered = F.lower(word)
        return F.when(lowered.isin(*TRUE_WORDS), F.lit(True)).when(
            lowered.isin(*FALSE_WORDS), F.lit(False)
        )
    return word.try_cast(target)


def coerce(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` as ``target``, null where it does not convert."""
    if source == target:
        return value
    if isinstance(target, T.ArrayType):
        if not isinstance(source, T.ArrayType):
            return F.lit(None).cast(target)
        return F.transform(value, lambda v: coerce(v, source.elementType, target.elementType))
    if isinstance(source, T.StringType):
        return _from_text(value, target)
    if isinstance(target, T.LongType) and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(value == F.floor(value), value.try_cast(target))
    return value.try_cast(target)


def _rules(c: SpecColumn, source: T.DataType | None, shaped: bool) -> list[Column]:
    """The rules column ``c`` may break, each as a label or null."""
    typed, raw = F.col(c.name), F.col(_RAW + c.name)
    if source is None:
        return [F.lit(f"{c.name}:required")] if c.required else []
    rules = []
    if source != c.spark_type:
        rules.append(F.when(raw.isNotNull() & typed.isNull(), F.lit(f"{c.name}:type")))
    if c.is_array:
        rules.append(F.when(F.exists(typed, lambda v: v.isNull()), F.lit(f"{c.name}:type")))
    if c.required:
        missing = raw.isNull()
        if shaped:  # a value of a wrong type is there, but not as a value
            missing &= ~F.array_contains(VIOLATIONS, f"{c.name}:type")
        rules.append(F.when(missing, F.lit(f"{c.name}:required")))
    if c.ge is not None:
        rules.append(F.when(typed < F.lit(c.ge), F.lit(f"{c.name}:ge")))
    return rules


def validate(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Declared columns in declared types, ``keep`` columns, and the broken rules per row.

    Columns that are neither declared nor kept are dropped.  Rules that rows come with (a column
    ``violations``, from parsing) count along.  Types are converted in one projection and judged
    in the next, so no value is converted twice.
    """
    shaped = VIOLATIONS in df.columns
    sources = {f.name: f.dataType for f in df.schema.fields}
    converted, rules = [], []
    for c in spec.columns:
        source = sources.get(c.name)
        if source is None:
            converted.append(F.lit(None).cast(c.spark_type).alias(c.name))
        else:
            raw = F.col(c.name)
            if c.blank_to_null and isinstance(source, T.StringType):
                raw = blank_to_null(raw)
            converted.append(coerce(raw, source, c.spark_type).alias(c.name))
            converted.append(raw.alias(_RAW + c.name))
        rules.extend(_rules(c, source, shaped))
    labels = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    if shaped:
        labels = F.array_distinct(F.concat(F.coalesce(VIOLATIONS, F.array().cast("array<string>")), labels))
        converted.append(F.col(VIOLATIONS))
    return df.select(*converted, *keep).select(*spec.payload, *keep, labels.alias(VIOLATIONS))


def violation_counts(validated: DataFrame) -> DataFrame:
    """Rows per broken rule."""
    return (
        validated.select(F.explode(VIOLATIONS).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
