"""Driver tables in the roles of the library's own tables."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column as SparkColumn, DataFrame, SparkSession, functions as F, types as T

from sightlog.functions.hashing import with_audit
from sightlog.functions.scalar import instant
from sightlog.operators.quality import measure
from sightlog.plans.staging import staging_view
from sightlog.session import scratch_dir, use_utc
from sightlog.sources.landing import read_table_file
from sightlog.sources.warehouse import Warehouse
from sightlog.specs import Check, Column, TableSpec
from sightlog.tables import CARDS, CATALOG, METRICS, PACKAGES, PRICES, SALE_LOG, SNAPSHOTS, STATE_KEY

RUN_DATE = date(2024, 1, 28)
NOW = datetime(2024, 2, 4)

# md5 row hashes come out the same in the oracle's engine
CATALOG_MD5 = replace(CATALOG, hash_algorithm="md5")
SALE_LOG_MD5 = replace(SALE_LOG, hash_algorithm="md5")
CARDS_MD5 = replace(CARDS, hash_algorithm="md5")
PRICES_MD5 = replace(PRICES, hash_algorithm="md5")
PACKAGES_MD5 = replace(PACKAGES, hash_algorithm="md5")
METRICS_MD5 = replace(METRICS, hash_algorithm="md5")
SNAPSHOTS_MD5 = replace(SNAPSHOTS, hash_algorithm="md5")

# The columns of a card that the queue uses.
QUEUE_CARDS = TableSpec(
    schema="raw",
    name="queue_cards",
    columns=(
        Column("success", bool),
        Column("appid", int, ge=0),
        Column("release_date", datetime | None),
    ),
    key=STATE_KEY,
)

LINEITEM_CHECK = Check(medians=("l_quantity", "l_extendedprice", "l_discount"))
EVENT_CHECK = Check(medians=("value",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table_file(use_utc(spark), sf_dir, name)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by key, as landed responses lie in many files: making and parsing their JSON is
    then shared out, however few row groups the given table has."""
    return df.repartition(*keys)


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the oracle has them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def cents(c: SparkColumn) -> SparkColumn:
    return F.floor(c * 100 + 0.5).cast("bigint")


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared one, for queries that store what they load."""
    return scratch_dir(spark)


def scratch_database(spark: SparkSession) -> str:
    """A new database, whose files go with the session and whose name with the process."""
    name = f"run_{uuid.uuid4().hex[:12]}"
    Warehouse(spark, scratch(spark)).create_databases([name])
    atexit.register(_forget, spark, name)
    return name


def _forget(spark: SparkSession, database: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def scratch_table(spark: SparkSession, *specs: TableSpec) -> tuple[Warehouse, list[TableSpec]]:
    """Empty tables in a new database."""
    database = scratch_database(spark)
    moved = [replace(s, schema=database) for s in specs]
    warehouse = Warehouse(spark)
    warehouse.deploy(moved)
    return warehouse, moved


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("appid"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderdate").alias("last_update"),
    )
    return with_audit(orders, CATALOG_MD5)


def raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("appid"),
        F.col("event_type").alias("name"),
        F.col("ts").alias("last_update"),
    )
    return with_audit(events, SALE_LOG_MD5)


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every signup as a sighting on sale."""
    events = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "signup")
        .select(
            F.col("user_id").alias("appid"),
            F.col("event_type").alias("name"),
            F.col("ts").alias("last_update"),
        )
    )
    return with_audit(events, SALE_LOG)


def raw_queue_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase as a card; ids in steps of three, so that most entities on sale have none."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            (F.col("value") >= 20).alias("success"),
            (F.col("user_id") * 3).alias("appid"),
            F.when(k % 3 != 0, F.col("ts")).alias("release_date"),
            F.col("ts").alias("last_update"),
        )
    )
    return with_audit(events, QUEUE_CARDS)


def raw_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' lines as packages: states repeat, and sightings of one differ in the name."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("appid"),
        F.col("l_linenumber").cast("bigint").alias("packageid"),
        F.col("l_returnflag").alias("package_option_text"),
        F.floor(F.col("l_discount") * 20).cast("bigint").alias("package_price_with_discount"),
        F.col("l_linestatus").alias("name"),
        F.col("l_shipdate").alias("last_update"),
    )
    return with_audit(rows, PACKAGES_MD5)


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers as entities with few prices: a day sees each state many times."""
    step = F.floor(F.col("l_quantity") / 25).cast("bigint")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").cast("bigint").alias("appid"),
        F.col("l_linestatus").alias("name"),
        F.lit("USD").alias("currency"),
        step.alias("price_initial"),
        step.alias("price_final"),
        F.lit(None).cast("bigint").alias("discount_percent"),
        F.col("l_shipdate").alias("last_update"),
    )
    return with_audit(rows, PRICES_MD5)


def raw_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.floor(F.col("o_totalprice") / 100000).cast("bigint")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("appid"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("developer"),
        F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("publisher"),
        F.lit(None).cast("bigint").alias("score_rank"),
        step.alias("positive"),
        (step + 1).alias("negative"),
        F.lit(0).cast("bigint").alias("userscore"),
        F.concat(step.cast("string"), F.lit(" .. "), (step + 1).cast("string")).alias("owners"),
        step.cast("double").alias("price"),
        (step + 1).cast("double").alias("initialprice"),
        F.lit(0.0).alias("discount"),
        F.lit(None).cast("bigint").alias("ccu"),
        F.col("o_orderdate").alias("last_update"),
    )
    return with_audit(rows, SNAPSHOTS_MD5)


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers as cards; arrays from the words of the priority text."""
    words = F.split(F.col("o_orderpriority"), "-")
    nothing = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "orders").select(
        (F.col("o_orderstatus") != "P").alias("success"),
        F.col("o_custkey").alias("appid"),
        F.col("o_orderpriority").alias("name"),
        F.lit(None).cast("bigint").alias("required_age"),
        (F.col("o_orderstatus") == "F").alias("is_free"),
        F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("supported_languages"),
        F.lit("").alias("website"),
        F.lit("").alias("pc_requirements"),
        nothing.alias("mac_requirements"),
        nothing.alias("linux_requirements"),
        words.alias("developers"),
        F.when(F.col("o_orderstatus") == "F", words).alias("publishers"),
        F.array(F.try_element_at(words, F.lit(1)).cast("bigint")).alias("categories_id"),
        F.slice(words, 2, 1).alias("categories_description"),
        F.slice(words, 1, 1).alias("genres_id"),
        F.slice(words, 2, 1).alias("genres_description"),
        F.trunc("o_orderdate", "YEAR").cast("timestamp").alias("release_date"),
        F.col("o_orderdate").alias("last_update"),
    )
    return with_audit(rows, CARDS_MD5)


def stg_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_view(raw_catalog(spark, sf_dir), CATALOG_MD5)


def stg_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_view(raw_sales(spark, sf_dir), SALE_LOG, ["appid"])


def stg_queue_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_view(raw_queue_cards(spark, sf_dir), QUEUE_CARDS)


def daily_event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load of events per day, stamped half an hour after midnight."""
    days = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return measure(days, EVENT_CHECK, by=["day"]).select(
        F.lit("events_daily").alias("dag_id"),
        F.lit(SALE_LOG.schema).alias("schema_name"),
        F.lit(SALE_LOG.name).alias("table_name"),
        "metrics_name", "agg_type", "metrics_value",
        (F.col("day").cast("timestamp") + F.expr("INTERVAL 30 MINUTES")).alias("last_update"),
    )


def repeated_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event metrics recorded by two loads: the values of each are those of the other."""
    daily = daily_event_metrics(spark, sf_dir)
    return with_audit(daily.unionByName(daily.withColumn("dag_id", F.lit("events_again"))), METRICS_MD5)


def card_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card responses made from orders: good, failed, absent and unreadable ones.

    Finished orders leave null fields out of the JSON, open ones write them as null.
    """
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.col("o_orderdate")
    total = F.floor("o_totalprice").cast("bigint")
    released = (
        F.when(priority == "3-MEDIUM", F.lit("Coming soon"))
        .when(status == "F", F.date_format(day, "MMM d, yyyy"))
        .otherwise(F.date_format(day, "d MMMM, yyyy"))
    )
    words = F.split(priority, "-")
    data = F.struct(
        F.nullif(priority, F.lit("5-LOW")).alias("name"),
        F.when(status == "F", F.lit("18")).otherwise(F.lit(" ")).alias("required_age"),
        (status == "O").alias("is_free"),
        F.struct(F.concat(F.lit("min "), status).alias("minimum")).alias("pc_requirements"),
        words.alias("developers"),
        F.array(
            F.struct(
                F.try_element_at(words, F.lit(1)).cast("int").alias("id"),
                F.try_element_at(words, F.lit(2)).alias("description"),
            )
        ).alias("categories"),
        F.struct(released.alias("date")).alias("release_date"),
        F.when(
            F.col("o_totalprice") >= 100000,
            F.struct(
                F.when(status == "F", "USD").otherwise("").alias("currency"),
                total.alias("initial"),
                (total - 1).alias("final"),
                F.lit(10).alias("discount_percent"),
            ),
        ).alias("price_overview"),
        F.array(
            F.struct(
                F.array(
                    F.struct(
                        F.col("o_custkey").alias("packageid"),
                        F.nullif(priority, F.lit("2-HIGH")).alias("option_text"),
                        total.alias("price_in_cents_with_discount"),
                    ),
                    F.struct(
                        (F.col("o_custkey") + 1).alias("packageid"),
                        status.alias("option_text"),
                        F.lit(None).cast("bigint").alias("price_in_cents_with_discount"),
                    ),
                ).alias("subs")
            ),
            F.struct(
                F.array().cast(
                    "array<struct<packageid:bigint,option_text:string,"
                    "price_in_cents_with_discount:bigint>>"
                ).alias("subs")
            ),
        ).alias("package_groups"),
    )
    key = F.col("o_orderkey").cast("string")
    good = F.create_map(key, F.struct(F.lit(True).alias("success"), data.alias("data")))
    failed = F.create_map(key, F.struct(F.lit(False).alias("success")))
    payload = (
        F.when(status == "F", F.to_json(good, {"ignoreNullFields": "true"}))
        .when(status == "O", F.to_json(good, {"ignoreNullFields": "false"}))
        .when(priority == "1-URGENT", F.lit(None).cast("string"))
        .when(priority == "2-HIGH", F.lit("{bad"))
        .otherwise(F.to_json(failed))
    )
    return dealt(table(spark, sf_dir, "orders"), "o_orderkey").select(
        F.col("o_orderkey").alias("appid"), payload.alias("payload")
    )


#: Card responses with a value of a wrong type, and some that only look odd; one for each order.
ODD_ENTRIES = (
    '{"success": true, "data": {"name": "fine", "developers": ["a"]}}',
    '{"success": true, "data": {"name": 5}}',
    '{"success": true, "data": {"developers": "abc"}}',
    '{"success": true, "data": {"publishers": [1, "x"]}}',
    '{"success": true, "data": {"categories": {"id": 1}}}',
    '{"success": true, "data": {"categories": [{"id": 1, "description": 7}]}}',
    '{"success": true, "data": {"genres": [{"id": 3, "description": "a"}]}}',
    '{"success": true, "data": {"genres": ["a"]}}',
    '{"success": true, "data": {"price_overview": "x"}}',
    '{"success": true, "data": {"package_groups": "y"}}',
    '{"success": true, "data": {"website": {"a": 1}}}',
    '{"success": true, "data": {"supported_languages": [1, 2]}}',
    '{"success": true, "data": {"pc_requirements": []}}',
    '{"success": true, "data": {"pc_requirements": "abc"}}',
    '{"success": true, "data": {"mac_requirements": {"minimum": 1}}}',
    '{"success": true, "data": {"release_date": {"date": 2020}}}',
    '{"success": true, "data": []}',
    '{"success": true, "data": "text"}',
    '"text"',
)


def odd_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An odd card response for each order."""
    entries = F.array(*[F.lit(e) for e in ODD_ENTRIES])
    entry = F.element_at(entries, (F.col("o_orderkey") % len(ODD_ENTRIES) + 1).cast("int"))
    key = F.col("o_orderkey").cast("string")
    return dealt(table(spark, sf_dir, "orders"), "o_orderkey").select(
        F.col("o_orderkey").alias("appid"),
        F.concat(F.lit('{"'), key, F.lit('": '), entry, F.lit("}")).alias("payload"),
    )


def search_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages made from customers: an id link, and a link without one for each."""
    key = F.col("c_custkey").cast("string")
    page = F.struct(
        F.lit(2).alias("total_count"),
        F.array(
            F.struct(
                F.nullif(F.col("c_name"), F.lit("Customer#000000007")).alias("name"),
                F.concat(F.lit("https://img.example.org/apps/"), key, F.lit("/h.jpg")).alias("logo"),
            ),
            F.struct(
                F.col("c_mktsegment").alias("name"),
                F.concat(F.lit("https://img.example.org/subs/"), key, F.lit("/h.jpg")).alias("logo"),
            ),
        ).alias("items"),
    )
    return table(spark, sf_dir, "customer").select(F.to_json(page).alias("payload"))


def keyed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed pages made from customers; one market segment lands empty pages."""
    info = F.struct(
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("developer"),
        F.lit("ignored").alias("extra"),
        F.col("c_nationkey").cast("string").alias("positive"),
        F.when(F.col("c_nationkey") < 5, " ").otherwise("7").alias("ccu"),
    )
    page = F.when(
        F.col("c_mktsegment") == "BUILDING", F.lit("{}")
    ).otherwise(F.to_json(F.create_map(F.col("c_custkey").cast("string"), info)))
    return table(spark, sf_dir, "customer").select(page.alias("payload"))


def hour_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event hours as landed pages of one walk per user, 100 rows a page; each page announces the
    rows of all hours up to the last event."""
    events = table(spark, sf_dir, "events")
    hours = lambda at: F.floor(
        (F.unix_timestamp(at) - F.unix_timestamp(instant(datetime(2024, 1, 1)))) / 3600
    ).cast("bigint")
    last = events.agg(hours(F.max("ts"))).scalar()
    return events.select(
        F.col("user_id").alias("walk"), (hours("ts") * 100).alias("offset"),
        F.concat(F.lit('{"total_count": '), ((last + 1) * 100).cast("string"), F.lit("}")).alias("payload"),
    )


def day_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day: rows of a page are that day's purchases."""
    day = F.datediff(F.to_date("ts"), F.lit(date(2024, 1, 1))).cast("bigint")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("walk"), day.alias("page"))
        .agg(F.count_if(F.col("event_type") == "purchase").alias("rows"))
    )
