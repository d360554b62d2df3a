from datetime import datetime

import pytest

from sightlog.operators.validate import (
    VIOLATIONS,
    validate,
    violation_counts,
)
from sightlog.specs import Column, TableSpec


def spec(*columns):
    return TableSpec(schema="raw", name="t", columns=columns, key=(columns[0].name,))


@pytest.mark.parametrize(
    "annotation, text, expected",
    [
        (int, "18", 18), (int, " 18 ", 18), (int, "18.0", 18), (int, "+5", 5), (int, "-3", -3),
        (int, "1_000", 1000), (int, "18+", None), (int, "17.5", None), (int, "", None),
        (int, "1__0", None), (int, "99999999999999999999", None), (int, "true", None),
        (float, "1.5", 1.5), (float, "1.5d", None), (float, "2f", None), (float, "inf", float("inf")),
        (float, "x", None), (float, "1e3", 1000.0),
        (bool, "true", True), (bool, "ON", True), (bool, "0", False), (bool, "off", False),
        (bool, "maybe", None),
        (datetime, "2024-01-02 03:04:05", datetime(2024, 1, 2, 3, 4, 5)), (datetime, "soon", None),
        (str, " x ", " x "),
    ],
)
def test_text(rows, annotation, text, expected):
    s = spec(Column("c", annotation))
    row = validate(rows([(text,)], "c string"), s).first()
    assert row["c"] == expected
    assert row[VIOLATIONS] == ([] if expected is not None else ["c:type"])


@pytest.mark.parametrize("value, broken", [(17.0, []), (17.5, ["c:type"]), (None, ["c:required"])])
def test_whole_doubles(rows, value, broken):
    assert validate(rows([(value,)], "c double"), spec(Column("c", int))).first()[VIOLATIONS] == broken


def test_lists(rows):
    s = spec(Column("c", list[int] | None))
    df = rows([(["1", "2"],), (["x"],), ([None],), (None,), ([],)], "c array<string>")
    got = sorted((repr(r["c"]), tuple(r[VIOLATIONS])) for r in validate(df, s).collect())
    assert got == sorted(
        [("[1, 2]", ()), ("[None]", ("c:type",)), ("[None]", ("c:type",)), ("None", ()), ("[]", ())]
    )


def test_rules(rows):
    s = spec(Column("a", int, ge=0), Column("b", int | None, ge=0, blank_to_null=True), Column("c", str))
    df = rows([("-1", " ", "x", 9), (None, "-2", None, 9), ("0", None, "", 9)],
              "a string, b string, c string, extra int")
    checked = validate(df, s)
    assert checked.columns == ["a", "b", "c", VIOLATIONS]
    assert sorted(tuple(r[VIOLATIONS]) for r in checked.collect()) == [
        (), ("a:ge",), ("a:required", "b:ge", "c:required")]
    counts = {r["rule"]: r["rows"] for r in violation_counts(checked).collect()}
    assert counts == {"a:ge": 1, "a:required": 1, "b:ge": 1, "c:required": 1}

def test_absent_columns(rows):
    s = spec(Column("a", int), Column("b", str | None))
    assert validate(rows([(1,)], "a long"), s).first()["b"] is None
    assert validate(rows([("x",)], "b string"), s).first()[VIOLATIONS] == ["a:required"]


def test_rules_from_parsing_count_along(rows):
    s = spec(Column("a", str), Column("b", int | None))
    df = rows([(None, "1", ["a:type"]), ("x", "y", None)], "a string, b string, violations array<string>")
    assert sorted(tuple(r[VIOLATIONS]) for r in validate(df, s).collect()) == [("a:type",), ("b:type",)]
