"""The store tables as declarations: catalog, sale log, cards, prices, packages, snapshots."""

from __future__ import annotations

from datetime import datetime

from sightlog.specs import Check, Column, TableSpec

STATE_KEY = ("appid", "row_hash")
DAILY_KEY = ("to_date(last_update)", "appid", "row_hash")

# The databases of the warehouse.
DATABASES = ("meta", "raw", "raw_dq", "staging", "dbt_dq", "core", "marts")

CATALOG = TableSpec(
    schema="raw",
    name="catalog",
    columns=(Column("appid", int, ge=0), Column("name", str)),
    key=STATE_KEY,
    check=Check(),
)

SALE_LOG = TableSpec(
    schema="raw",
    name="sale_log",
    columns=(Column("appid", int, ge=0), Column("name", str)),
    key=DAILY_KEY,
    check=Check(),
)

CARDS = TableSpec(
    schema="raw",
    name="cards",
    columns=(
        Column("success", bool),
        Column("appid", int, ge=0),
        Column("name", str | None),
        Column("required_age", int | None, ge=0, blank_to_null=True),
        Column("is_free", bool | None),
        Column("supported_languages", str | None),
        Column("website", str | None),
        Column("pc_requirements", str | None),
        Column("mac_requirements", str | None),
        Column("linux_requirements", str | None),
        Column("developers", list[str] | None),
        Column("publishers", list[str] | None),
        Column("categories_id", list[int] | None),
        Column("categories_description", list[str] | None),
        Column("genres_id", list[str] | None),
        Column("genres_description", list[str] | None),
        Column("release_date", datetime | None, blank_to_null=True),
    ),
    key=STATE_KEY,
    check=Check(),
)

PRICES = TableSpec(
    schema="raw",
    name="prices",
    columns=(
        Column("appid", int, ge=0),
        Column("name", str),
        Column("currency", str | None, blank_to_null=True),
        Column("price_initial", int | None, ge=0, blank_to_null=True),
        Column("price_final", int | None, ge=0, blank_to_null=True),
        Column("discount_percent", int | None, ge=0, blank_to_null=True),
    ),
    key=DAILY_KEY,
    check=Check(medians=("price_initial", "price_final", "discount_percent")),
)

# ``name`` joined the table after its first loads: it is no part of a state or of the view.
PACKAGES = TableSpec(
    schema="raw",
    name="packages",
    columns=(
        Column("appid", int, ge=0),
        Column("packageid", int, ge=0),
        Column("package_option_text", str | None),
        Column("package_price_with_discount", int | None, ge=0, blank_to_null=True),
        Column("name", str | None),
    ),
    key=("appid", "packageid", "row_hash"),
    hash_columns=("appid", "packageid", "package_option_text", "package_price_with_discount"),
    view_columns=("appid", "packageid", "package_option_text", "package_price_with_discount"),
    check=Check(medians=("package_price_with_discount",)),
    added_defaults={"name": ""},
)

SNAPSHOTS = TableSpec(
    schema="raw",
    name="snapshots",
    columns=(
        Column("appid", int, ge=0),
        Column("name", str),
        Column("developer", str | None),
        Column("publisher", str | None),
        Column("score_rank", int | None, ge=0, blank_to_null=True),
        Column("positive", int | None, ge=0, blank_to_null=True),
        Column("negative", int | None, ge=0, blank_to_null=True),
        Column("userscore", int | None, blank_to_null=True),
        Column("owners", str | None),
        Column("price", float | None, ge=0, blank_to_null=True),
        Column("initialprice", float | None, ge=0, blank_to_null=True),
        Column("discount", float | None, ge=0, blank_to_null=True),
        Column("ccu", int | None, ge=0, blank_to_null=True),
    ),
    key=STATE_KEY,
)

METRICS = TableSpec(
    schema="raw_dq",
    name="load_metrics",
    columns=(
        Column("dag_id", str),
        Column("schema_name", str),
        Column("table_name", str),
        Column("metrics_name", str),
        Column("agg_type", str),
        Column("metrics_value", float | None),
    ),
    key=("row_hash",),
    hash_columns=("schema_name", "table_name", "metrics_name", "agg_type", "metrics_value"),
    keep_states=False,
)

# Rank summaries of the columns whose medians are checked, a row for each load and column.
SUMMARIES = TableSpec(
    schema="raw_dq",
    name="load_summaries",
    columns=(
        Column("dag_id", str),
        Column("schema_name", str),
        Column("table_name", str),
        Column("metrics_name", str),
        Column("n", int),
        Column("slack", int),
        Column("points", list[float]),
    ),
    key=("row_hash",),
    hash_columns=("dag_id", "schema_name", "table_name", "metrics_name", "n"),
    keep_states=False,
)

RAW_TABLES = (CATALOG, SALE_LOG, CARDS, PRICES, PACKAGES, SNAPSHOTS)
ALL_TABLES = (*RAW_TABLES, METRICS)

# Columns that must not be null, per raw table and per staging view.
NOT_NULL_RAW = {
    "catalog": ("appid",),
    "sale_log": ("appid",),
    "cards": ("appid",),
    "prices": ("appid",),
    "packages": ("appid", "packageid"),
    "snapshots": ("appid",),
}
NOT_NULL_VIEWS = {"catalog": ("appid",), "sale_log": ("appid",)}
