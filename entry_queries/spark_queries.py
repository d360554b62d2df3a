"""One query per operator over the given tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from entry_queries import roles as R
from sightlog.functions.hashing import row_hash, version
from sightlog.functions.scalar import blank_to_null, instant, link_id, release_date, week_start
from sightlog.operators import flatten
from sightlog.operators.clustering import clustered, file_ranges
from sightlog.operators.compaction import add_column, compact, idempotent_append
from sightlog.operators.limits import with_global_max
from sightlog.operators.pages import islands, missing_pages, missing_ranges, total_count, truncation
from sightlog.operators.quality import (
    CheckError,
    collect_metrics,
    compare_series,
    freshness,
    freshness_test,
    measure,
    not_null,
    not_null_test,
    previous_metrics,
    run_tests,
)
from sightlog.operators.ranks import exact_medians, split_batches
from sightlog.operators.summaries import merged, spans, summarize
from sightlog.operators.validate import VIOLATIONS, validate
from sightlog.plans import queue as Q
from sightlog.plans.load import gated_load
from sightlog.plans.staging import staging_view
from sightlog.sources import staged
from sightlog.sources.drift import stored_drift
from sightlog.sources.versions import VersionedWarehouse
from sightlog.specs import Check, Column, TableSpec
from sightlog.streaming.incremental import append_new, new_files, run_available, run_stateful
from sightlog.tables import CARDS, CATALOG, METRICS, PACKAGES, PRICES, SALE_LOG, SNAPSHOTS, SUMMARIES

QUERIES = {}


def query(fn, name: str | None = None):
    """Register ``fn`` under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return R.comparable(fn(spark, sf_dir))

    QUERIES[name or fn.__name__] = run
    return fn


def _json_arrays(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.to_json(n) for n in names})


def _rules(df: DataFrame) -> DataFrame:
    """Broken rules as one text column."""
    return df.withColumn("broken", F.array_join(VIOLATIONS, ",")).drop(VIOLATIONS)


@query
def scan_count(spark, sf_dir):
    return R.table(spark, sf_dir, "lineitem").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_shipdate").alias("n_dated")
    )


# -- staging views -------------------------------------------------------------------------


@query
def stg_catalog(spark, sf_dir):
    return R.stg_catalog(spark, sf_dir)


@query
def stg_daily(spark, sf_dir):
    return staging_view(R.raw_daily(spark, sf_dir), R.SALE_LOG_MD5)


@query
def stg_cards(spark, sf_dir):
    view = staging_view(R.raw_cards(spark, sf_dir), R.CARDS_MD5)
    arrays = [c.name for c in CARDS.columns if c.is_array]
    return _json_arrays(view, *arrays)


@query
def stg_prices(spark, sf_dir):
    return staging_view(R.raw_prices(spark, sf_dir), R.PRICES_MD5)


@query
def stg_composite(spark, sf_dir):
    return staging_view(R.raw_packages(spark, sf_dir), R.PACKAGES_MD5)


@query
def stg_added_column(spark, sf_dir):
    """The same view with the late column: now rows of a state can differ."""
    return staging_view(
        R.raw_packages(spark, sf_dir), R.PACKAGES_MD5, [*R.PACKAGES_MD5.view_columns, "name"]
    )


@query
def stg_snapshots(spark, sf_dir):
    return staging_view(R.raw_snapshots(spark, sf_dir), R.SNAPSHOTS_MD5)


# -- the work queue ------------------------------------------------------------------------


def _current(spark, sf_dir):
    return Q.current_cards(R.stg_queue_cards(spark, sf_dir))


def _eligible(spark, sf_dir):
    return Q.eligible_sales(
        Q.latest_sales(R.stg_sales(spark, sf_dir)), _current(spark, sf_dir)
    )


def _queue(spark, sf_dir):
    return Q.fetch_queue(
        R.stg_catalog(spark, sf_dir), R.stg_sales(spark, sf_dir),
        R.stg_queue_cards(spark, sf_dir), R.RUN_DATE, R.NOW,
    )


@query
def latest_state(spark, sf_dir):
    return _current(spark, sf_dir)


@query
def latest_two(spark, sf_dir):
    return Q.latest_sales(R.stg_sales(spark, sf_dir))


@query
def global_max(spark, sf_dir):
    return with_global_max(
        R.stg_queue_cards(spark, sf_dir).select("appid", "success", "last_update"),
        "last_update", "max_last_update",
    )


@query
def specials_eligible(spark, sf_dir):
    return _eligible(spark, sf_dir)


@query
def sale_transitions(spark, sf_dir):
    return Q.sale_transitions(_eligible(spark, sf_dir), R.RUN_DATE)


@query
def never_fetched(spark, sf_dir):
    return Q.never_fetched(
        R.stg_catalog(spark, sf_dir), _current(spark, sf_dir),
        Q.latest_sales(R.stg_sales(spark, sf_dir)),
    )


@query
def retry_failed(spark, sf_dir):
    return Q.retry_failed(
        _current(spark, sf_dir), _eligible(spark, sf_dir), R.RUN_DATE, R.NOW
    )


@query
def fetch_queue(spark, sf_dir):
    return _queue(spark, sf_dir)


@query
def queue_export(spark, sf_dir):
    return Q.export_queue(_queue(spark, sf_dir))


@query
def batch_split(spark, sf_dir):
    return split_batches(
        R.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("appid")), "appid", 500
    )


# -- functions, audit and storage ----------------------------------------------------------


@query
def week_starts(spark, sf_dir):
    day = F.to_date("ts")
    return R.table(spark, sf_dir, "events").select(
        "event_id", week_start(day).alias("week"), (day == week_start(day)).alias("is_start")
    )


@query
def state_hash(spark, sf_dir):
    rows = R.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation"),
        (F.col("c_acctbal") >= 0).alias("solvent"),
        F.split("c_name", "#").alias("words"),
    )
    columns = ["segment", "nation", "solvent", "words"]
    return rows.select("c_custkey", row_hash(rows, columns, "md5").alias("row_hash"))


@query
def audit_cols(spark, sf_dir):
    rows = R.table(spark, sf_dir, "events").withColumnRenamed("ts", "last_update")
    return rows.select(
        "event_id", "last_update", version().alias("ver"),
        F.trunc("last_update", "MM").alias("load_month"),
    )


@query
def compact_monthly(spark, sf_dir):
    return compact(R.raw_catalog(spark, sf_dir), R.CATALOG_MD5)


@query
def view_of_compacted(spark, sf_dir):
    """The staging view of a compacted table, which is that of the table."""
    return staging_view(compact(R.raw_daily(spark, sf_dir), R.SALE_LOG_MD5), R.SALE_LOG_MD5)


@query
def compact_late_column(spark, sf_dir):
    return compact(R.raw_packages(spark, sf_dir), R.PACKAGES_MD5)


@query
def compact_metrics(spark, sf_dir):
    """Load metrics are a plain log: equal values of different loads all stay."""
    return compact(R.repeated_metrics(spark, sf_dir), R.METRICS_MD5).withColumn(
        "metrics_value", F.round("metrics_value", 6)
    ).drop("row_hash")


@query
def idempotent_load(spark, sf_dir):
    daily = R.raw_daily(spark, sf_dir)
    stored = compact(daily.where(F.to_date("last_update") < F.lit(date(2024, 1, 16))), R.SALE_LOG_MD5)
    return idempotent_append(stored, daily, R.SALE_LOG_MD5)


@query
def added_column(spark, sf_dir):
    rows = R.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.col("l_returnflag").alias("name")
    )
    cut = instant(datetime(1998, 1, 1))
    return add_column(
        rows.where(F.col("l_shipdate") < cut).drop("name"),
        rows.where(F.col("l_shipdate") >= cut),
        {"name": ""},
    )


# -- load metrics and table tests ----------------------------------------------------------


def _monthly_metrics(spark, sf_dir):
    rows = R.table(spark, sf_dir, "lineitem").withColumn("load_month", F.trunc("l_shipdate", "MM"))
    return measure(rows, R.LINEITEM_CHECK, by=["load_month"])


@query
def dq_collect(spark, sf_dir):
    return _monthly_metrics(spark, sf_dir).withColumn(
        "metrics_value", F.round("metrics_value", 6)
    )


@query
def dq_collect_load(spark, sf_dir):
    """All events as one load."""
    check = R.EVENT_CHECK
    return collect_metrics(
        R.table(spark, sf_dir, "events"), SALE_LOG, check, datetime(2024, 1, 31), "events_all"
    ).withColumn("metrics_value", F.round("metrics_value", 6))


@query
def dq_previous(spark, sf_dir):
    return previous_metrics(
        R.daily_event_metrics(spark, sf_dir), SALE_LOG, R.EVENT_CHECK,
        datetime(2024, 1, 20, 12), "events_daily",
    ).withColumn("old_value", F.round("old_value", 6))


@query
def dq_drift(spark, sf_dir):
    rows = R.table(spark, sf_dir, "lineitem").withColumn("load_month", F.trunc("l_shipdate", "MM"))
    metrics = measure(rows, R.LINEITEM_CHECK, by=["l_returnflag", "load_month"])
    drifted = compare_series(
        metrics, R.LINEITEM_CHECK, ["l_returnflag", "metrics_name"], at="load_month"
    )
    return drifted.withColumns(
        {c: F.round(c, 6) for c in ("new_value", "old_value", "drift")}
    )


@query
def drift_of_empty(spark, sf_dir):
    """Days without sales beside days with some: skipped, or an error where an empty load is one."""
    sales = R.day_manifest(spark, sf_dir).select(
        "walk", "page", F.lit("row_count").alias("metrics_name"), F.col("rows").cast("double").alias("metrics_value")
    )
    out = None
    for name, check in (("passes", Check()), ("stops", Check(empty_stops=True))):
        case = compare_series(sales, check, ["walk", "metrics_name"], at="page").select(
            F.lit(name).alias("empty"), "walk", "page", "new_value", "old_value", "status"
        )
        out = case if out is None else out.unionByName(case)
    return out


@partial(query, name="freshness_test")
def freshness_cases(spark, sf_dir):
    events = R.table(spark, sf_dir, "events").withColumnRenamed("ts", "last_update")
    cases = [
        ("fresh", events, date(2024, 1, 31)),
        ("stale", events, date(2024, 2, 2)),
        ("empty", events.where(F.col("value") < 0), date(2024, 1, 31)),
    ]
    out = None
    for name, rows, day in cases:
        case = freshness(rows, day).withColumn("case_name", F.lit(name))
        out = case if out is None else out.unionByName(case)
    return out


@query
def test_not_null(spark, sf_dir):
    rows = R.table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return not_null(rows, "segment")


# -- validation ----------------------------------------------------------------------------


@query
def coerce_types(spark, sf_dir):
    spec = TableSpec(
        schema="raw", name="coerced",
        columns=(
            Column("event_id", int), Column("k", int | None), Column("whole", int | None),
            Column("amount", float | None), Column("flag", bool | None),
        ),
        key=("event_id",),
    )
    rows = R.dealt(R.table(spark, sf_dir, "events"), "event_id").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit(" "), F.get_json_object("props", "$.k"), F.lit(" ")).alias("k"),
        F.col("value").cast("string").alias("whole"),
        F.concat(F.col("value").cast("string"), F.when(F.col("event_type") == "error", "d").otherwise("")).alias("amount"),
        F.when(F.col("event_type") == "view", "on").when(F.col("event_type") == "click", "No")
        .otherwise(F.col("event_type")).alias("flag"),
    )
    return _rules(validate(rows, spec))


@query
def constraint_ge(spark, sf_dir):
    spec = TableSpec(
        schema="raw", name="accounts",
        columns=(Column("c_custkey", int, ge=0), Column("c_acctbal", float, ge=0)),
        key=("c_custkey",),
    )
    return _rules(validate(R.table(spark, sf_dir, "customer"), spec)).where("broken <> ''")


@query
def constraint_required(spark, sf_dir):
    spec = TableSpec(
        schema="raw", name="segments",
        columns=(Column("c_custkey", int), Column("segment", str), Column("absent", str | None)),
        key=("c_custkey",),
    )
    rows = R.table(spark, sf_dir, "customer").withColumn(
        "segment", F.nullif("c_mktsegment", F.lit("BUILDING"))
    )
    return _rules(validate(rows, spec)).where("broken <> ''")


@query
def blank_lines(spark, sf_dir):
    lines = F.split("text", "\n")
    return R.table(spark, sf_dir, "documents").select(
        "doc_id", F.size(lines).cast("bigint").alias("n_lines"),
        F.size(F.filter(lines, lambda x: blank_to_null(x).isNotNull())).cast("bigint").alias("n_text"),
    )


# -- nested data ---------------------------------------------------------------------------


@query
def regex_id(spark, sf_dir):
    ids = link_id(F.col("url"), r"/(\d+)")
    return R.table(spark, sf_dir, "pages").select("page_id", ids.alias("id")).where("id IS NOT NULL")


@query
def release_dates(spark, sf_dir):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "MMM d, yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "d MMM, yyyy"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(day, "d MMMM, yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format(day, "MMMM d, yyyy"))
        .otherwise(F.concat(F.lit("Q3 "), F.date_format(day, "yyyy")))
    )
    return R.table(spark, sf_dir, "orders").select(
        "o_orderkey", release_date(text).alias("released")
    )


@query
def json_field(spark, sf_dir):
    props = F.try_parse_json("props")
    return R.table(spark, sf_dir, "events").select(
        "event_id",
        flatten.variant_text(props, "$.k", "").alias("k"),
        flatten.variant_text(props, "$.absent", "none").alias("absent"),
    )


@query
def array_project(spark, sf_dir):
    objects = F.transform(
        F.split("p_name", " "),
        lambda w, i: F.struct((i + 1).alias("id"), w.alias("description")),
    )
    landed = R.table(spark, sf_dir, "part").select("p_partkey", F.parse_json(F.to_json(objects)).alias("categories"))
    return landed.select(
        "p_partkey",
        F.array_join(flatten.field_texts(F.col("categories"), "id"), "|").alias("ids"),
        F.array_join(flatten.field_texts(F.col("categories"), "description"), "|").alias("names"),
    )


@query
def explode_two(spark, sf_dir):
    """Line items nested two deep and flattened again; empty groups give no rows."""
    sub = F.struct(
        F.col("l_suppkey").alias("packageid"), F.col("l_returnflag").alias("option_text")
    )
    other = F.struct(
        F.col("l_partkey").alias("packageid"), F.col("l_linestatus").alias("option_text")
    )
    groups = F.array(
        F.struct(F.array(sub, other).alias("subs")),
        F.struct(F.slice(F.array(sub), 1, 0).alias("subs")),
    )
    landed = R.dealt(R.table(spark, sf_dir, "lineitem"), "l_orderkey").select(
        "l_orderkey", "l_linenumber", F.parse_json(F.to_json(groups)).alias("groups")
    )
    return landed.select(
        "l_orderkey", "l_linenumber", F.explode(flatten.nested_items(F.col("groups"), "subs")).alias("s")
    ).select(
        "l_orderkey", "l_linenumber",
        F.variant_get("s", "$.packageid", "bigint").alias("packageid"),
        F.variant_get("s", "$.option_text", "string").alias("option_text"),
    )


@query
def flatten_cards(spark, sf_dir):
    rows = flatten.card_rows(flatten.parse_cards(R.card_landing(spark, sf_dir)))
    arrays = [c.name for c in CARDS.columns if c.is_array]
    return _json_arrays(_rules(validate(rows, CARDS)), *arrays)


@query
def flatten_odd_shapes(spark, sf_dir):
    """Values of a wrong JSON type, each named among the broken rules."""
    rows = flatten.card_rows(flatten.parse_cards(R.odd_landing(spark, sf_dir)))
    return validate(rows, CARDS).select("appid", F.array_join(F.array_sort(VIOLATIONS), ",").alias("broken"))


@query
def flatten_prices(spark, sf_dir):
    rows = flatten.price_rows(flatten.parse_cards(R.card_landing(spark, sf_dir)))
    return _rules(validate(rows, PRICES))


@query
def flatten_packages(spark, sf_dir):
    rows = flatten.package_rows(flatten.parse_cards(R.card_landing(spark, sf_dir)))
    return _rules(validate(rows, PACKAGES))


@query
def flatten_search(spark, sf_dir):
    return flatten.search_rows(R.search_landing(spark, sf_dir))


@query
def flatten_keyed(spark, sf_dir):
    return _rules(validate(flatten.keyed_rows(R.keyed_landing(spark, sf_dir), SNAPSHOTS), SNAPSHOTS))


# -- page completeness ---------------------------------------------------------------------


def _walks(landed):
    return total_count(landed).groupBy("walk").agg(F.max("total_count").alias("total_count"))


@query
def page_coverage(spark, sf_dir):
    landed = R.hour_pages(spark, sf_dir)
    return missing_pages(landed, _walks(landed), ["walk"], page_rows=100)


@query
def bounded_coverage(spark, sf_dir):
    """Walks over the first three days only."""
    landed = R.hour_pages(spark, sf_dir)
    return missing_pages(landed, _walks(landed), ["walk"], page_rows=100, max_rows=7200)


@query
def page_gaps(spark, sf_dir):
    """What did not land, as ranges of offsets."""
    landed = R.hour_pages(spark, sf_dir)
    return missing_ranges(landed, _walks(landed), ["walk"], page_rows=100, block=24)


@query
def empty_runs(spark, sf_dir):
    empty = R.day_manifest(spark, sf_dir).where("rows = 0")
    return islands(empty, ["walk"], "page", block=8)


@query
def page_truncation(spark, sf_dir):
    return truncation(
        R.day_manifest(spark, sf_dir), ["walk"], "page", "rows",
        max_pages=30, stop_after_empty=3,
    )


# -- queries that store what they load -----------------------------------------------------


@query
def fan_out_load(spark, sf_dir):
    """Card responses staged as three tables; rows that break rules set aside."""
    base = R.scratch(spark)
    staged.fan_out(R.card_landing(spark, sf_dir), f"{base}/run", quarantine=f"{base}/aside")
    out = None
    for spec, _ in staged.CARD_STREAMS:
        good = staged.read_staged(spark, spec, f"{base}/run/{spec.name}").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("appid").alias("id_sum")
        )
        part = good.select(F.lit(spec.name).alias("table_name"), "n_rows", "id_sum")
        out = part if out is None else out.unionByName(part)
    return out


@query
def gated_loads(spark, sf_dir):
    """One load per order year through the gate; a load that drifts too far is not stored."""
    warehouse, (catalog, metrics) = R.scratch_table(spark, CATALOG, METRICS)
    base = R.scratch(spark)
    orders = R.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("appid"), F.col("o_orderpriority").alias("name"),
        F.year("o_orderdate").alias("year"),
    )
    staged.stage(orders, catalog, f"{base}/orders", by=("year",))
    for part in staged.parts(spark, f"{base}/orders"):
        at = datetime(int(part.removeprefix("year=")), 12, 31, 0, 30)
        try:
            gated_load(warehouse, catalog, f"{base}/orders/{part}", at, "yearly", now=at, metrics_spec=metrics)
        except CheckError:
            continue
    stored = warehouse.read(catalog).groupBy("last_update").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    recorded = warehouse.read(metrics).select("last_update", "metrics_name", "metrics_value")
    return stored.join(recorded, "last_update", "left")


@query
def staged_portions(spark, sf_dir):
    """Events staged day by day and loaded two files at a time; what all the files hold together."""
    warehouse, (catalog,) = R.scratch_table(spark, CATALOG)
    path = f"{R.scratch(spark)}/events"
    rows = R.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("appid"), F.col("event_type").alias("name")
    )
    staged.stage(rows.repartition(5), catalog, path)
    warehouse.append_directory(catalog, path, datetime(2024, 2, 1), files_per_batch=2)
    return warehouse.read(catalog).groupBy("name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("appid").alias("id_sum")
    )


def _table_before_and_after(spark, sf_dir):
    """A package table made without its late column: drift before, and the table after the column
    was added and more rows came."""
    before = replace(PACKAGES, columns=tuple(c for c in PACKAGES.columns if c.name != "name"), added_defaults={})
    warehouse, (old,) = R.scratch_table(spark, before)
    spec = replace(PACKAGES, schema=old.schema)
    rows = R.raw_packages(spark, sf_dir).drop("row_hash", "ver", "load_month")
    cut = instant(datetime(1998, 1, 1))
    warehouse.append_payload(old, rows.where(F.col("last_update") < cut).drop("name"))
    drift = warehouse.schema_drift(spec)
    warehouse.add_column(spec, "name")
    warehouse.append_payload(spec, rows.where(F.col("last_update") >= cut))
    return drift, warehouse.read(spec)


@query
def schema_drift(spark, sf_dir):
    return _table_before_and_after(spark, sf_dir)[0]


@query
def altered_column(spark, sf_dir):
    return _table_before_and_after(spark, sf_dir)[1].groupBy("name", "load_month").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def incremental_load(spark, sf_dir):
    """Events read as a stream of files into a table of daily states."""
    warehouse, (daily,) = R.scratch_table(spark, R.SALE_LOG_MD5)
    R.use_utc(spark)
    stream = new_files(
        spark, sf_dir, "user_id bigint, event_type string, ts timestamp_ntz", "parquet",
        pathGlobFilter="events.parquet",
    ).select(
        F.col("user_id").alias("appid"), F.col("event_type").alias("name"),
        F.col("ts").cast("timestamp").alias("last_update"),
    )
    run_available(stream, append_new(daily), f"{R.scratch(spark)}/checkpoint")
    return staging_view(warehouse.read(daily), daily)


@query
def stored_failures(spark, sf_dir):
    """Table tests with their failing rows kept; the outcomes."""
    customers = R.table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    events = R.table(spark, sf_dir, "events").withColumnRenamed("ts", "last_update")
    outcomes = run_tests(
        [
            not_null_test("id_not_null", customers, "c_custkey", "error"),
            not_null_test("segment_not_null", customers, "segment"),
            freshness_test("events_fresh", events, date(2024, 2, 5), severity="error"),
        ],
        R.scratch_database(spark),
    )
    return spark.createDataFrame(
        [(o.name, o.status, o.failures) for o in outcomes],
        "test_name string, status string, failures bigint",
    )


# -- loads that break off, tables that change while they are read ---------------------------


class _Stopped(Exception):
    """A run that ends after some step."""


def _stop_after(wanted: str):
    def step(name: str) -> None:
        if name == wanted:
            raise _Stopped(name)

    return step


@query
def resumed_load(spark, sf_dir):
    """A gated load in portions that is stopped after each kind of step and run again: what is stored."""
    R.use_utc(spark)
    warehouse, base = VersionedWarehouse(spark, R.scratch(spark)), R.scratch(spark)
    rows = R.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("appid"), F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("currency"), R.cents(F.col("o_totalprice")).alias("price_final"),
    ).withColumns({"price_initial": F.col("price_final"), "discount_percent": F.lit(0)})
    staged.stage(rows.repartition(5, "appid"), PRICES, f"{base}/orders")
    at = datetime(2024, 2, 1, 0, 30)
    for stop in ("check", "portion 2", "metrics", "summaries", "record", None):
        try:
            gated_load(
                warehouse, PRICES, f"{base}/orders", at, "resumed", at, files_per_batch=2,
                step=_stop_after(stop), summaries_spec=SUMMARIES,
            )
        except _Stopped:
            continue
    stored = warehouse.read(PRICES).groupBy("name").agg(
        F.count(F.lit(1)).cast("double").alias("n_rows"), F.sum("price_final").cast("double").alias("total")
    )
    metrics = warehouse.read(METRICS).groupBy("metrics_name").agg(
        F.count(F.lit(1)).cast("double").alias("n_rows"), F.max("metrics_value").alias("total")
    )
    summaries = warehouse.read(SUMMARIES).groupBy(F.concat(F.lit("summary of "), "metrics_name").alias("name")).agg(
        F.count(F.lit(1)).cast("double").alias("n_rows"), F.sum("n").cast("double").alias("total")
    )
    return stored.unionByName(metrics.withColumnRenamed("metrics_name", "name")).unionByName(summaries)


@query
def compaction_beside_append(spark, sf_dir):
    """Months compacted while other rows are appended and readers read: what each of them sees."""
    R.use_utc(spark)
    warehouse = VersionedWarehouse(spark, R.scratch(spark))
    spec, rows = R.CATALOG_MD5, R.raw_catalog(spark, sf_dir)
    late = F.pmod("appid", F.lit(5)) == 0
    warehouse.append(spec, rows.where(~late))
    before = warehouse.read(spec)
    during = []

    def meanwhile() -> None:
        warehouse.append(spec, rows.where(late))
        during.append(warehouse.read(spec))

    warehouse.compact(spec, before_switch=meanwhile)
    after = warehouse.read(spec)
    warehouse.compact(spec)
    seen = None
    for moment, df in (("before", before), ("during", during[0]), ("after", after), ("in the end", warehouse.read(spec))):
        part = df.groupBy(F.lit(moment).alias("moment"), "load_month").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct("appid", "row_hash").alias("n_states"),
            F.min("last_update").alias("first_seen"),
        )
        seen = part if seen is None else seen.unionByName(part)
    return seen


@query
def span_medians(spark, sf_dir):
    """Medians of years from the stored summaries of their months, with the exact ones by their bounds."""
    R.use_utc(spark)
    warehouse = VersionedWarehouse(spark, R.scratch(spark))
    columns = list(R.LINEITEM_CHECK.medians)
    rows = R.table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate").cast("string"))
    loads = summarize(rows.withColumn("load", F.date_format("l_shipdate", "yyyy-MM")), columns, ["load"])
    named = loads.withColumnRenamed("load", "dag_id").withColumns({"schema_name": F.lit("raw"), "table_name": F.lit("lineitem")})
    warehouse.append_payload(SUMMARIES, named, datetime(2024, 2, 1))
    stored = warehouse.read(SUMMARIES).withColumn("year", F.substring("dag_id", 1, 4))
    around = spans(stored, ["year"])
    # quarters merged first: the same years within what a merge may add
    quarters = merged(stored.withColumn("quarter", F.expr("(substr(dag_id, 6, 2) - 1) div 3")), ["year", "quarter"])
    again = spans(quarters, ["year"]).select("year", "metrics_name", F.col("low").alias("low2"), F.col("high").alias("high2"))
    exact = exact_medians(rows, columns, ["year"], around)
    value = F.col("metrics_value")
    held = value.between(F.col("low"), F.col("high")) & value.between(F.col("low2"), F.col("high2"))
    return exact.join(around, ["year", "metrics_name"]).join(again, ["year", "metrics_name"]).select(
        "year", "metrics_name", "n", F.round(value, 6).alias("metrics_value"),
        (held & F.col("middle").between(F.col("low"), F.col("high"))).alias("held"),
    )


@query
def stateful_load(spark, sf_dir):
    """Events landing in files out of order, over runs of a stream that keeps first sightings as its state."""
    R.use_utc(spark)
    warehouse, base = VersionedWarehouse(spark, R.scratch(spark)), R.scratch(spark)
    landed = R.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("appid"), F.col("event_type").alias("name"), F.col("ts").alias("last_update")
    )
    late = F.pmod("appid", F.lit(3)) == 0
    fields = "appid bigint, name string, last_update timestamp"
    # the afternoons first, then the mornings with sightings of the same days, then everything once more
    for part in (landed.where((F.hour("last_update") >= 12) & ~late), landed.where((F.hour("last_update") < 12) | late), landed):
        part.withColumn("last_update", F.col("last_update").cast("timestamp")).repartition(3).write.mode("append").parquet(f"{base}/landing")
        stream = new_files(spark, f"{base}/landing", fields, "parquet", files_per_batch=2)
        run_stateful(stream, warehouse, R.SALE_LOG_MD5, f"{base}/checkpoint", "events")
    return staging_view(warehouse.read(R.SALE_LOG_MD5), R.SALE_LOG_MD5)


@query
def clustered_reads(spark, sf_dir):
    """Lines stored by part and by day at once; the rows of the middle part and of the middle day, and
    whether their files are at most a quarter of all."""
    path, columns = f"{R.scratch(spark)}/lines", ["l_partkey", "day"]
    lines = R.table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", "l_quantity"
    )
    clustered(lines, columns, files=64).write.parquet(path)
    stored = spark.read.parquet(path)
    ranges = file_ranges(stored, columns)
    ends = ranges.agg(*[f(f"{name}_{c}").alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]).first()
    middles = {c: ends[f"min_{c}"] + (ends[f"max_{c}"] - ends[f"min_{c}"]) // 2 for c in columns}
    seen = None
    for c, value in middles.items():
        rows = stored.where(F.col(c) == F.lit(value)).agg(
            F.lit(c).alias("probe"), F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("order_sum")
        )
        hit = F.lit(value).between(F.col(f"min_{c}"), F.col(f"max_{c}")).cast("int")
        part = rows.join(ranges.agg((F.sum(hit) * 4 <= F.count(F.lit(1))).alias("few"), F.lit(c).alias("probe")), "probe")
        seen = part if seen is None else seen.unionByName(part)
    return seen


@query
def drift_of_files(spark, sf_dir):
    """Packages of years that were written in different ways: what each month's files hold otherwise than
    declared, beside the months' rows."""
    R.use_utc(spark)
    warehouse = VersionedWarehouse(spark, R.scratch(spark))
    spec, rows = PACKAGES, R.raw_packages(spark, sf_dir).drop("row_hash").withColumn("row_hash", F.xxhash64("appid", "packageid"))
    older = replace(spec, columns=tuple(c for c in spec.columns if c.name != "name"), added_defaults={})
    year = F.year("last_update")
    warehouse.append(older, rows.where(year < 1994).drop("name"))
    warehouse.append(spec, rows.where(year.between(1994, 1995)).withColumn("packageid", F.col("packageid").cast("int")))
    warehouse.append(spec, rows.where(year == 1996).withColumn("appid", F.col("appid").cast("string")))
    warehouse.append(spec, rows.where(year > 1996))
    months = rows.groupBy("load_month").agg(F.count(F.lit(1)).alias("n_rows"))
    return months.join(stored_drift(warehouse, spec).drop("folders"), "load_month", "left")
