"""Completeness checks over landed pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


class PageError(ValueError):
    """A page walk without a usable total."""


def total_count(landing: DataFrame, payload: str = "payload") -> DataFrame:
    """Landed pages with the total they announce; null unless a JSON whole number >= 0.

    A text or a fraction is no total, also where it spells a whole number.
    """
    stated = F.try_variant_get(F.try_parse_json(payload), "$.total_count", "variant")
    number = F.try_variant_get(stated, "$", "bigint")
    return landing.withColumn(
        "total_count", F.when((F.schema_of_variant(stated) == "BIGINT") & (number >= 0), number)
    )


def require_totals(landing: DataFrame, payload: str = "payload") -> DataFrame:
    """Landed pages with their totals; a page without a usable total is an error."""
    pages = total_count(landing, payload)
    bad = pages.where(F.col("total_count").isNull()).count()
    if bad:
        raise PageError(f"{bad} landed pages announce no usable total_count")
    return pages


def missing_pages(
    landed: DataFrame, totals: DataFrame, keys: Sequence[str], page_rows: int, block: int = 10_000,
    max_rows: int | None = None,
) -> DataFrame:
    """Offsets ``0, page_rows, ...`` below the total that did not land: (keys..., offset).

    ``totals`` has one row per walk with ``total_count``.  A walk bounded by ``max_rows`` is
    expected to read that many rows, whatever the total.  Expected offsets are made block by
    block on all executors.
    """
    if page_rows < 1:
        raise ValueError("page_rows must be at least 1")
    if max_rows is not None:
        if max_rows < 1:
            raise ValueError("max_rows must be at least 1")
        totals = totals.withColumn("total_count", F.lit(max_rows).cast("bigint"))
    keys = list(keys)
    span = block * page_rows
    starts = F.sequence(F.lit(0).cast("long"), F.col("total_count") - 1, F.lit(span).cast("long"))
    blocks = (
        totals.where(F.col("total_count") > 0)
        .select(*keys, "total_count", F.explode(starts).alias("first"))
        .repartition(*keys, "first")
    )
    last = F.least(F.col("total_count"), F.col("first") + span) - 1
    expected = blocks.select(
        *keys, F.explode(F.sequence("first", last, F.lit(page_rows).cast("long"))).alias("offset")
    )
    seen = landed.select(*keys, "offset").distinct()
    return expected.join(seen, [*keys, "offset"], "left_anti")


def missing_ranges(
    landed: DataFrame, totals: DataFrame, keys: Sequence[str], page_rows: int, block: int = 10_000,
    max_rows: int | None = None,
) -> DataFrame:
    """The pages of ``missing_pages`` as ranges: (keys..., first, last, pages), offsets of their ends.

    Gaps are read off between landed pages, so work follows what landed and not what was expected.  The
    page before each one is looked for in its block of pages, and for the first of a block in the block
    before: only one row for each block of a walk is ordered across blocks.
    """
    if page_rows < 1:
        raise ValueError("page_rows must be at least 1")
    if max_rows is not None:
        if max_rows < 1:
            raise ValueError("max_rows must be at least 1")
        totals = totals.withColumn("total_count", F.lit(max_rows).cast("bigint"))
    keys = list(keys)
    walk = [*keys, "__walk"]  # a constant, for walks without keys
    wanted = totals.where(F.col("total_count") > 0).select(
        *keys, F.lit(0).alias("__walk"), F.expr(f"(total_count + {page_rows - 1}) div {page_rows}").alias("__pages")
    )
    page = F.expr(f"offset div {page_rows}")
    seen = landed.where((F.col("offset") >= 0) & (F.col("offset") % page_rows == 0)).select(
        *keys, F.lit(0).alias("__walk"), page.alias("__page")
    ).distinct()
    inside = seen.join(wanted, walk).where(F.col("__page") < F.col("__pages")).withColumn("__block", F.expr(f"__page div {block}"))
    blocks = inside.groupBy(*walk, "__block").agg(F.min("__page").alias("__page"), F.max("__page").alias("__end"))
    before = F.lag("__end", 1, -1).over(Window.partitionBy(*walk).orderBy("__block"))
    between = F.lag("__page").over(Window.partitionBy(*walk, "__block").orderBy("__page"))
    firsts = blocks.select(*walk, before.alias("__from"), F.col("__page").alias("__to"))
    others = inside.select(*walk, between.alias("__from"), F.col("__page").alias("__to")).where(F.col("__from").isNotNull())
    ends = blocks.groupBy(*walk).agg(F.max("__end").alias("__end"))
    rest = wanted.join(ends, walk, "left").select(*walk, F.coalesce("__end", F.lit(-1)).alias("__from"), F.col("__pages").alias("__to"))
    gaps = firsts.unionByName(others).unionByName(rest).where(F.col("__to") - F.col("__from") > 1)
    return gaps.select(
        *keys, ((F.col("__from") + 1) * page_rows).alias("first"), ((F.col("__to") - 1) * page_rows).alias("last"),
        (F.col("__to") - F.col("__from") - 1).alias("pages"),
    )


def islands(
    positions: DataFrame, keys: Sequence[str], position: str, block: int = 10_000
) -> DataFrame:
    """Maximal runs of consecutive positions per key: (keys..., first, last, length).

    Runs are found inside fixed blocks of positions; only runs that touch a block edge are
    ordered across blocks, so one key with very many positions is still shared out.
    """
    keys = list(keys)
    cut = positions.select(*keys, F.col(position).alias("p")).distinct().withColumn(
        "b", F.floor(F.col("p") / block)
    )
    inside = Window.partitionBy(*keys, "b").orderBy("p")
    runs = (
        cut.withColumn("g", F.col("p") - F.row_number().over(inside))
        .groupBy(*keys, "b", "g")
        .agg(F.min("p").alias("first"), F.max("p").alias("last"))
    )
    at_edge = (F.pmod("first", F.lit(block)) == 0) | (
        F.pmod("last", F.lit(block)) == block - 1
    )
    across = Window.partitionBy(*keys).orderBy("first")
    starts_new = F.coalesce(F.lag("last").over(across) != F.col("first") - 1, F.lit(True))
    joined = (
        runs.where(at_edge)
        .withColumn("new", starts_new.cast("int"))
        .withColumn("g", F.sum("new").over(across))
        .groupBy(*keys, "g")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
    )
    columns = [*keys, "first", "last"]
    return (
        runs.where(~at_edge).select(*columns)
        .unionByName(joined.select(*columns))
        .withColumn("length", F.col("last") - F.col("first") + 1)
    )


def truncation(
    manifest: DataFrame, keys: Sequence[str], page: str, rows: str,
    max_pages: int, stop_after_empty: int, block: int = 10_000,
) -> DataFrame:
    """Per walk: pages seen, longest run of empty pages, and whether it was cut off.

    A walk that reaches the page cap without ``stop_after_empty`` empty pages in a row has
    probably not seen everything.
    """
    if max_pages < 1 or stop_after_empty < 1:
        raise ValueError("max_pages and stop_after_empty must be at least 1")
    keys = list(keys)
    walked = manifest.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pages"), F.max(page).alias("last_page")
    )
    empty = islands(manifest.where(F.col(rows) == 0), keys, page, block)
    longest = empty.groupBy(*keys).agg(F.max("length").alias("longest_empty_run"))
    joined = walked.join(longest, keys, "left")
    run = F.coalesce(F.col("longest_empty_run"), F.lit(0).cast("long"))
    return joined.select(
        *keys, "pages", "last_page", run.alias("longest_empty_run"),
        ((F.col("last_page") >= max_pages - 1) & (run < stop_after_empty)).alias("truncated"),
    )
