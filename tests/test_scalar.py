import time
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sightlog.functions import scalar as S


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Nov 3, 2025", datetime(2025, 11, 3)), ("3 Nov, 2025", datetime(2025, 11, 3)),
        ("3 November, 2025", datetime(2025, 11, 3)), ("November 3, 2025", datetime(2025, 11, 3)),
        ("May 5, 2024", datetime(2024, 5, 5)), ("05 may, 2024", datetime(2024, 5, 5)),
        ("Coming soon", None), ("Q3 2026", None), ("31 Feb, 2024", None), ("", None),
        (" ", None), (None, None), ("2025-11-03", None), ("Nov 3, 25", None),
        ("Nov 3, 2025 ", None), ("soon, very soon", None),
    ],
)
def test_release_date(rows, text, expected):
    assert rows([(text,)], "t string").select(S.release_date(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    "text, expected",
    [("", None), ("  ", None), ("\t\n", None), (" 　", None), (" a ", " a "), (None, None)],
)
def test_blank_to_null(rows, text, expected):
    assert rows([(text,)], "t string").select(S.blank_to_null(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize(
    "link, expected",
    [
        ("https://x/apps/730/h.jpg", 730), ("https://x/subs/1/h.jpg", None), ("", None),
        (None, None), ("/apps/12", None), ("/apps/0/", 0), ("/apps/1/apps/2/", 1),
    ],
)
def test_link_id(rows, link, expected):
    assert rows([(link,)], "t string").select(S.link_id(F.col("t"))).first()[0] == expected


def test_week_starts_on_sunday(spark):
    days = {date(2024, 1, 28): date(2024, 1, 28), date(2024, 1, 27): date(2024, 1, 21),
            date(2024, 1, 29): date(2024, 1, 28)}
    for day, start in days.items():
        assert one(spark, S.week_start(F.lit(day))) == start


@pytest.mark.parametrize(
    "new, old, expected",
    [(120.0, 100.0, 0.2), (100.0, 150.0, 0.5), (0.0, 5.0, None), (5.0, 0.0, None),
     (None, 5.0, None), (5.0, None, None), (-2.0, 3.0, 2.5), (4.0, 4.0, 0.0)],
)
def test_relative_drift(rows, new, old, expected):
    got = rows([(new, old)], "n double, o double").select(S.relative_drift(F.col("n"), F.col("o"))).first()[0]
    assert got == (None if expected is None else pytest.approx(expected))


def test_dates_and_stamps(spark):
    assert one(spark, S.days_apart(F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 4)))) == 3
    assert one(spark, S.run_stamp(F.lit(datetime(2024, 1, 2, 3, 4, 5, 678901)).cast("timestamp"))) == "2024-01-02 03:04:05.678"
    assert S.run_date_or_default(None) == date(2026, 1, 1)
    assert S.run_date_or_default(date(2024, 2, 2)) == date(2024, 2, 2)


def test_moments_do_not_depend_on_the_local_zone(spark, monkeypatch):
    zoned = datetime(2024, 1, 2, 3, tzinfo=timezone(timedelta(hours=2)))
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        got = [
            one(spark, F.date_format(S.instant(m), "yyyy-MM-dd HH"))
            for m in (datetime(2024, 1, 2, 3), zoned)
        ]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert got == ["2024-01-02 03", "2024-01-02 01"]


@pytest.mark.parametrize("text", ["Jan  5, 2024", "Jan 5,  2024", "5  January, 2024"])
def test_runs_of_blanks_in_dates(rows, text):
    got = rows([(text,)], "t string").select(S.release_date(F.col("t"))).first()[0]
    assert got is not None and got.date() == date(2024, 1, 5)
