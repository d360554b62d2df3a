from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sightlog.functions.hashing import load_time, row_hash, with_audit
from sightlog.tables import CARDS, CATALOG, PACKAGES

NOW = datetime(2025, 11, 3, 0, 30, 5)


def hashes(df, columns, algorithm):
    keyed = df.select("id", row_hash(df, columns, algorithm).alias("h")).collect()
    return {r["id"]: r["h"] for r in keyed}


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5"])
def test_hash_separates_states(rows, algorithm):
    df = rows(
        [
            (1, None, "a", True, ["a", "b"]), (2, "a", None, True, ["a", "b"]),
            (3, "", "a", True, ["a", "b"]), (4, "aa", "", True, ["a", "b"]),
            (5, "", "aa", True, ["a", "b"]), (6, None, "a", False, ["a", "b"]),
            (7, None, "a", None, ["a", "b"]), (8, None, "a", True, ["a, b"]),
            (9, None, "a", True, []), (10, None, "a", True, ["a", None]),
        ],
        "id int, x string, y string, f boolean, arr array<string>",
    )
    got = hashes(df, ["x", "y", "f", "arr"], algorithm)
    assert len(set(got.values())) == len(got)


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5"])
def test_equal_states_hash_equal(rows, algorithm):
    df = rows(
        [(1, None, None), (2, "\\N", None), (3, None, [])],
        "id int, x string, arr array<string>",
    )
    got = hashes(df, ["x", "arr"], algorithm)
    # the null marker as text collides with null by design; a null array is an empty one
    assert got[1] == got[2] == got[3]


def test_unknown_algorithm(rows):
    df = rows([(1, "a")], "id int, x string")
    with pytest.raises(ValueError):
        row_hash(df, ["x"], "nope")


def test_audit_columns(rows):
    got = with_audit(rows([("n", 7, "extra")], "name string, appid long, other string"), CATALOG, NOW)
    assert got.columns == ["appid", "name", "row_hash", "last_update", "ver", "load_month"]
    row = got.first()
    assert row["last_update"] == NOW and row["load_month"] == date(2025, 11, 1)
    assert row["ver"] == -int((NOW - datetime(1970, 1, 1)).total_seconds() * 1000)


def test_version_floors_to_milliseconds(rows):
    at = datetime(2024, 1, 1, 0, 0, 0, 999_999)
    df = rows([(1, "a", at)], "appid long, name string, last_update timestamp")
    base = int((datetime(2024, 1, 1) - datetime(1970, 1, 1)).total_seconds() * 1000)
    assert with_audit(df, CATALOG).first()["ver"] == -(base + 999)


def test_earlier_sighting_has_higher_version(rows):
    df = rows(
        [(1, "a", datetime(2024, 1, 1)), (2, "a", datetime(2024, 1, 2))],
        "appid long, name string, last_update timestamp",
    )
    ver = {r["appid"]: r["ver"] for r in with_audit(df, CATALOG).collect()}
    assert ver[1] > ver[2]


def test_late_column_is_no_part_of_a_state(rows):
    df = rows(
        [(1, 2, "t", 5, "old"), (1, 2, "t", 5, "new"), (1, 2, "t", 5, None)],
        "appid long, packageid long, package_option_text string, "
        "package_price_with_discount long, name string",
    )
    assert with_audit(df, PACKAGES, NOW).select("row_hash").distinct().count() == 1


def test_null_arrays_are_stored_empty(spark):
    empty = spark.createDataFrame([], CARDS.struct()).select(
        *[F.col(c.name) for c in CARDS.columns]
    )
    one = spark.range(1).select(
        *[F.lit(None).cast(c.spark_type).alias(c.name) for c in CARDS.columns]
    )
    row = with_audit(empty.unionByName(one), CARDS, NOW).first()
    for c in CARDS.columns:
        assert row[c.name] == ([] if c.is_array else None)


def test_load_time_is_whole_seconds(spark):
    stamp = spark.range(1).select(load_time().alias("t")).first()["t"]
    assert stamp.microsecond == 0
