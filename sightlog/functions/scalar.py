"""Column helpers: blank handling, id and date extraction, calendar rules, drift."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, functions as F

# The characters that count as blank space.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The release-date spellings that parse; everything else is null.
MONTH_FIRST_FORMATS = ("MMM d, yyyy", "MMMM d, yyyy")
DAY_FIRST_FORMATS = ("d MMM, yyyy", "d MMMM, yyyy")

# Fixed value: where an entity id stands in an image link.
LINK_ID_PATTERN = r"/apps/(\d+)/"

DEFAULT_RUN_DATE = date(2026, 1, 1)


def instant(moment: datetime) -> Column:
    """Timestamp literal; a moment without a zone is UTC, whatever zone the driver runs in."""
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc))


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    """Null for empty and all-blank text; other text unchanged."""
    return F.when(stripped(c) != "", c)


def link_id(c: Column, pattern: str = LINK_ID_PATTERN) -> Column:
    """Number captured by ``pattern``, null where it does not match."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("bigint")


def release_date(c: Column) -> Column:
    """Timestamp of the spelling that fits, else null.

    Failed parses are dear, so only the spellings with the right first character are tried,
    and only on text with a comma, which all of them have.  A run of blanks counts as one.
    """
    c = F.regexp_replace(c, r"\s+", " ")

    def any_of(formats: tuple[str, ...]) -> Column:
        return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])

    first = F.left(c, F.lit(1))
    return F.when(
        c.contains(","),
        F.when(first.between("0", "9"), any_of(DAY_FIRST_FORMATS)).otherwise(
            any_of(MONTH_FIRST_FORMATS)
        ),
    )


def week_start(d: Column) -> Column:
    """The Sunday on or before ``d`` (``date_trunc('week')`` would give the Monday)."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def days_apart(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def relative_drift(new: Column, old: Column) -> Column:
    """``abs(max/min - 1)``; null when either side is null or zero."""
    comparable = (new != 0) & (old != 0)
    return F.when(comparable, F.abs(F.greatest(new, old) / F.least(new, old) - 1))


def run_stamp(c: Column) -> Column:
    """Run time as text with milliseconds."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")


def run_date_or_default(run_date: date | None) -> date:
    return DEFAULT_RUN_DATE if run_date is None else run_date
