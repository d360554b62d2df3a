"""Stored files against declarations: verdicts, months, widened reads."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from sightlog.sources.drift import stored_drift, verdict, widens
from sightlog.sources.versions import VersionedWarehouse
from sightlog.tables import PACKAGES

D = T.DecimalType


@pytest.mark.parametrize("stored, wanted, fine", [
    (T.IntegerType(), T.LongType(), True), (T.LongType(), T.IntegerType(), False), (T.LongType(), T.DoubleType(), False),
    (T.IntegerType(), T.DoubleType(), True), (T.FloatType(), T.DoubleType(), True), (T.DateType(), T.TimestampNTZType(), True),
    (D(10, 2), D(12, 2), True), (D(10, 2), D(12, 4), True), (D(10, 2), D(10, 3), False), (T.StringType(), T.LongType(), False),
    (T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), True), (T.ByteType(), T.ShortType(), True),
])
def test_widening(stored, wanted, fine):
    assert widens(stored, wanted) is fine


def test_verdicts():
    assert verdict(None, T.LongType()) == "missing" and verdict(T.LongType(), None) == "extra"
    assert verdict(T.LongType(), T.LongType()) == "same" and verdict(T.StringType(), T.LongType()) == "conflict"


def rows(spark, day, **columns):
    base = {"appid": F.lit(1), "packageid": F.lit(2).cast("bigint"), "package_option_text": F.lit("o"),
            "package_price_with_discount": F.lit(3).cast("bigint"), "name": F.lit("n"), "row_hash": F.lit(9).cast("bigint"),
            "last_update": F.lit(day), "ver": F.lit(-1).cast("bigint"), "load_month": F.lit(date(day.year, day.month, 1))}
    base["appid"] = base["appid"].cast("bigint")
    return spark.range(2).select(*[c.alias(n) for n, c in (base | columns).items() if c is not None])


def test_each_month_is_judged_by_its_files(spark, tmp_path):
    wh = VersionedWarehouse(spark, str(tmp_path))
    assert stored_drift(wh, PACKAGES).collect() == []
    no_name = replace(PACKAGES, columns=tuple(c for c in PACKAGES.columns if c.name != "name"), added_defaults={})
    wh.append(no_name, rows(spark, datetime(2025, 1, 5), name=None))
    wh.append(PACKAGES, rows(spark, datetime(2025, 2, 5), packageid=F.lit(2)))
    wh.append(PACKAGES, rows(spark, datetime(2025, 2, 6), packageid=F.lit(4)))
    wh.append(PACKAGES, rows(spark, datetime(2025, 3, 5)))
    found = {tuple(r) for r in stored_drift(wh, PACKAGES).collect()}
    assert found == {
        (date(2025, 1, 1), "name", None, "string", "missing", 1),
        (date(2025, 2, 1), "packageid", "int", "bigint", "widened", 2),
    }
    read = {(r["load_month"].month, r["packageid"], r["name"]) for r in wh.read(PACKAGES).collect()}
    assert read == {(1, 2, None), (2, 2, "n"), (2, 4, "n"), (3, 2, "n")}
    assert {r["verdict"] for r in stored_drift(wh, no_name).collect()} == {"extra", "widened"}
    wh.compact(PACKAGES)
    assert {r["column_name"] for r in stored_drift(wh, PACKAGES).collect()} == set()


def test_a_conflict_is_named(spark, tmp_path):
    wh = VersionedWarehouse(spark, str(tmp_path))
    wh.append(PACKAGES, rows(spark, datetime(2025, 1, 5), packageid=F.lit("x")))
    assert [tuple(r)[1:5] for r in stored_drift(wh, PACKAGES).collect()] == [("packageid", "string", "bigint", "conflict")]
