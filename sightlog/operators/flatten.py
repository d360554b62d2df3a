"""Nested landing payloads to flat rows.

Payloads stay VARIANT until each field is read, so a value's JSON type is known: a field that is
missing takes its default, one that is explicitly null stays null, and one of a wrong type is
named among the row's violations instead of turning into text or nothing.  All values leave here
as text; ``validate`` turns them into the declared types and carries the violations on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sightlog.functions.scalar import LINK_ID_PATTERN, link_id, release_date
from sightlog.operators.validate import VIOLATIONS
from sightlog.specs import TableSpec

_ENTRY = "__entry"
_KIND = "__kind_"


def variant_text(source: Column, path: str, missing: str | None = None) -> Column:
    """Text at ``path``; ``missing`` where there is no such field, null where it is null."""
    text = F.try_variant_get(source, path, "string")
    if missing is None:
        return text
    return F.when(F.variant_get(source, path, "variant").isNull(), F.lit(missing)).otherwise(text)


def kind(value: Column) -> Column:
    """JSON type of a VARIANT as Spark names it; null where there is no value."""
    return F.schema_of_variant(value)


def broken_unless(fine: Column, label: str) -> Column:
    """The label of a broken rule, or null; a test without result counts as passed."""
    return F.when(~fine, F.lit(label))


def is_object(value: Column) -> Column:
    return kind(value).startswith("OBJECT")


def field(value: Column, name: str) -> Column:
    """A field of a VARIANT object; null where the value is no object or lacks it."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def items_of(value: Column) -> Column:
    """Elements of a VARIANT list as VARIANTs; none where the value is no list."""
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))


def field_texts(value: Column, name: str) -> Column:
    """Text of one field of each object of a VARIANT list, in order."""
    return F.transform(items_of(value), lambda v: F.try_variant_get(v, f"$.{name}", "string"))


def nested_items(groups: Column, name: str) -> Column:
    """The elements of the lists that objects of a VARIANT list hold in a field, in order."""
    return F.flatten(F.transform(items_of(groups), lambda g: items_of(field(g, name))))


def _field_text(value: Column, missing: str) -> Column:
    """Text of a VARIANT field; ``missing`` where there is none, null where it is null."""
    return F.when(value.isNull(), F.lit(missing)).otherwise(F.try_variant_get(value, "$", "string"))


def _labels(*rules: Column) -> Column:
    return F.array_compact(F.array(*rules))


_FIELDS = (
    "name", "required_age", "is_free", "supported_languages", "website", "pc_requirements",
    "mac_requirements", "linux_requirements", "developers", "publishers", "categories", "genres",
    "release_date", "price_overview", "package_groups",
)
_REQUIREMENTS = ("pc_requirements", "mac_requirements", "linux_requirements")
_INNER = {f"{c}.minimum": (c, "minimum") for c in _REQUIREMENTS} | {
    "release_date.date": ("release_date", "date"), "currency": ("price_overview", "currency"),
}
_PRICE_FIELDS = (("price_initial", "initial"), ("price_final", "final"), ("discount_percent", "discount_percent"))


def parse_cards(landing: DataFrame, key: str = "appid", payload: str = "payload") -> DataFrame:
    """One row per landed card response: card fields, ``prices`` and ``packages`` arrays, and the
    ``violations`` of shape.

    A response that is absent, unreadable or lacks the key gives one failed card; a failed
    card has no prices and no packages.  Parsing happens here once; ``card_rows``,
    ``price_rows`` and ``package_rows`` only select.
    """
    entries = F.from_json(F.col(payload), "map<string, variant>")
    entry = F.try_element_at(entries, F.col(key).cast("string"))
    carried = [c for c in landing.columns if c not in (key, payload)]
    opened = landing.select(F.col(key).alias("appid"), *carried, entry.alias(_ENTRY))
    # each value and its JSON type are read once, level by level, into columns of their own
    opened = _with_reads(opened, {"response": F.col(_ENTRY), "success": field(F.col(_ENTRY), "success"),
                                  "data": field(F.col(_ENTRY), "data")})
    opened = _with_reads(opened, {name: field(_read("data").value, name) for name in _FIELDS})
    opened = _with_reads(opened, {inner: field(_read(outer).value, name) for inner, (outer, name) in _INNER.items()})

    of = _read
    success = _field_text(of("success").value, "false")
    name = of("name").only_text("")
    name_rule = of("name").text_rule("name:type")
    overview, groups = of("price_overview"), of("package_groups")
    price = F.struct(
        of("currency").only_text("").alias("currency"),
        *[_field_text_or_null(field(overview.value, f)).alias(c) for c, f in _PRICE_FIELDS],
        _labels(name_rule, of("currency").text_rule("currency:type"),
                overview.object_rule("price_overview:type")).alias(VIOLATIONS),
    )
    shapes = _labels(
        of("response").object_rule("response:type"),
        of("data").object_rule("data:type"),
        name_rule,
        *[of(c).text_rule(f"{c}:type") for c in ("supported_languages", "website")],
        *[of(c).object_rule(f"{c}:type") for c in _REQUIREMENTS],
        *[of(f"{c}.minimum").text_rule(f"{c}:type") for c in _REQUIREMENTS],
        *[broken_unless(of(c).is_void | of(c).is_list, f"{c}:type") for c in ("developers", "publishers")],
        *[broken_unless(of(c).is_blank | of(c).is_objects, f"{c}:type") for c in ("categories", "genres")],
        of("release_date").object_rule("release_date:type"),
        broken_unless(of("release_date.date").is_blank | of("release_date.date").is_text, "release_date:type"),
        overview.object_rule("price_overview:type"),
        broken_unless(_groups_fine(groups), "package_groups:type"),
    )
    succeeded = success.isin("true", "1")
    return opened.select(
        success.alias("success"),
        "appid",
        name.alias("name"),
        _field_text_or_null(of("required_age").value).alias("required_age"),
        _field_text_or_null(of("is_free").value).alias("is_free"),
        of("supported_languages").only_text("").alias("supported_languages"),
        of("website").only_text("").alias("website"),
        *[of(f"{c}.minimum").only_text("").alias(c) for c in _REQUIREMENTS],
        of("developers").texts().alias("developers"),
        of("publishers").texts().alias("publishers"),
        field_texts(of("categories").value, "id").alias("categories_id"),
        of("categories").texts("description").alias("categories_description"),
        of("genres").texts("id").alias("genres_id"),
        of("genres").texts("description").alias("genres_description"),
        release_date(F.try_variant_get(of("release_date.date").value, "$", "string")).alias("release_date"),
        F.when(succeeded, F.array(price)).alias("prices"),
        F.when(succeeded, _packages(groups, name_rule)).alias("packages"),
        F.array_distinct(shapes).alias(VIOLATIONS),
        *carried,
    )


def _with_reads(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``df`` with each value and the value's JSON type."""
    read = df.select("*", *[v.alias(_ENTRY + n) for n, v in values.items()])
    return read.select("*", *[kind(_column(_ENTRY + n)).alias(_KIND + n) for n in values])


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class _Read:
    """A VARIANT value and its JSON type."""

    value: Column
    kind: Column

    @property
    def is_void(self) -> Column:
        return self.value.isNull() | (self.kind == "VOID")

    @property
    def is_list(self) -> Column:
        return self.kind.startswith("ARRAY")

    @property
    def is_text(self) -> Column:
        return self.kind == "STRING"

    @property
    def is_objects(self) -> Column:
        """A list of objects only."""
        return self.kind.startswith("ARRAY<OBJECT")

    @property
    def is_blank(self) -> Column:
        """A value that stands for nothing where an object or a list is wanted: no field, null, an
        empty text, list or object, zero, false."""
        text = F.try_variant_get(self.value, "$", "string")
        return (
            F.when(self.value.isNull() | self.kind.isin("VOID", "OBJECT<>"), F.lit(True))
            .when(self.kind == "ARRAY<VOID>", F.size(items_of(self.value)) == 0)
            .when(self.is_list | self.kind.startswith("OBJECT"), F.lit(False))
            .otherwise(text.isin("", "0", "0.0", "false"))
        )

    def text_rule(self, label: str) -> Column:
        return broken_unless(self.is_void | self.is_text, label)

    def object_rule(self, label: str) -> Column:
        return broken_unless(self.is_blank | self.kind.startswith("OBJECT"), label)

    def only_text(self, missing: str) -> Column:
        """Text; ``missing`` where there is no field, null where it is null or of another type."""
        return F.when(self.value.isNull(), F.lit(missing)).when(self.is_text, F.try_variant_get(self.value, "$", "string"))

    def texts(self, name: str | None = None) -> Column:
        """Texts of a list, or of a field of a list's objects; elements of other types are null,
        which no declared list allows."""
        of = lambda v: v if name is None else field(v, name)
        path = "$" if name is None else f"$.{name}"
        plain = self.kind == "ARRAY<STRING>" if name is None else self.kind.rlike(f"^ARRAY<OBJECT<[^<>]*\\b{name}: STRING[,>]")
        quick = F.transform(items_of(self.value), lambda v: F.try_variant_get(v, path, "string"))
        each = F.transform(items_of(self.value), lambda v: F.when(kind(of(v)) == "STRING", F.try_variant_get(v, path, "string")))
        return F.when(plain, quick).otherwise(each)


def _read(name: str) -> _Read:
    return _Read(_column(_ENTRY + name), _column(_KIND + name))


def _groups_fine(groups: _Read) -> Column:
    """Lists of objects that hold lists of anything; told from the type alone where it is plain."""
    inner = F.forall(
        items_of(groups.value),
        lambda g: F.coalesce(kind(field(g, "subs")).startswith("ARRAY") | kind(field(g, "subs")).isin("VOID"), F.lit(True)),
    )
    told = groups.kind.rlike("^ARRAY<OBJECT<[^<>]*subs: ARRAY<")
    return F.when(groups.is_blank | told, F.lit(True)).otherwise(groups.is_objects & inner)


def _packages(groups: _Read, name_rule: Column) -> Column:
    """A package for each object of the groups' lists."""
    # no other type than text among all options: no need to look at each
    plain = ~groups.kind.rlike("option_text: (?!STRING|VOID)") & groups.kind.rlike("subs: ARRAY<OBJECT<")

    def package(sub: Column) -> Column:
        option = field(sub, "option_text")
        text = F.try_variant_get(option, "$", "string")
        wrong = F.when(plain, F.lit(False)).otherwise(~kind(option).isin("STRING", "VOID"))
        wrong = F.coalesce(wrong, F.lit(False))
        odd = F.when(plain, F.lit(False)).otherwise(F.coalesce(~is_object(sub), F.lit(False)))
        return F.struct(
            _field_text_or_null(field(sub, "packageid")).alias("packageid"),
            F.when(option.isNull(), F.lit("")).when(~wrong, text).alias("option_text"),
            _field_text_or_null(field(sub, "price_in_cents_with_discount")).alias("price"),
            _labels(name_rule, F.when(wrong, F.lit("package_option_text:type")),
                    F.when(odd, F.lit("package_groups:type"))).alias(VIOLATIONS),
        )

    return F.transform(nested_items(groups.value, "subs"), package)


def _field_text_or_null(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def card_rows(parsed: DataFrame) -> DataFrame:
    """A card for every response, failed ones included."""
    return parsed.drop("prices", "packages")


def _exploded(parsed: DataFrame, array: str) -> DataFrame:
    # The outer form plus a test on the element: for a plain explode Spark adds a test on the
    # array, moves it below the projection and so parses the JSON twice.
    return parsed.select("appid", "name", F.explode_outer(array).alias("e")).where("e IS NOT NULL")


def price_rows(parsed: DataFrame) -> DataFrame:
    """A price row for every successful response; free entities have null prices."""
    return _exploded(parsed, "prices").select("appid", "name", "e.*")


def package_rows(parsed: DataFrame) -> DataFrame:
    """A row per package of a successful response; none without packages."""
    return _exploded(parsed, "packages").select(
        "appid",
        F.col("e.packageid").alias("packageid"),
        F.col("e.option_text").alias("package_option_text"),
        F.col("e.price").alias("package_price_with_discount"),
        "name",
        f"e.{VIOLATIONS}",
    )


def search_items(
    landing: DataFrame, payload: str = "payload", pattern: str = LINK_ID_PATTERN
) -> DataFrame:
    """Every item of landed search pages; ``appid`` is null where the link holds no id."""
    page = F.from_json(F.col(payload), "items array<struct<name:string,logo:string>>")
    return (
        landing.select(F.explode(page["items"]).alias("item"))
        .select(
            link_id(F.col("item.logo"), pattern).alias("appid"),
            F.coalesce(F.col("item.name"), F.lit("")).alias("name"),
        )
    )


def search_rows(landing: DataFrame, **kwargs: str) -> DataFrame:
    """Items with an id; ``search_items`` where appid is null are the dropped ones."""
    return search_items(landing, **kwargs).where(F.col("appid").isNotNull())


def keyed_rows(landing: DataFrame, spec: TableSpec, payload: str = "payload") -> DataFrame:
    """Rows of pages shaped ``{id: {field: value}}``; an empty page gives none.

    Fields the spec does not declare are dropped.
    """
    fields = ",".join(f"{c}:string" for c in spec.payload)
    pages = F.from_json(F.col(payload), f"map<string,struct<{fields}>>")
    opened = landing.select(F.explode(pages).alias("id", "info"))
    return opened.select(
        F.coalesce(F.col("info.appid"), F.col("id")).alias("appid"),
        *[F.col(f"info.{c}").alias(c) for c in spec.payload if c != "appid"],
    )
