from datetime import datetime
from typing import Optional, Union

import pytest
from pyspark.sql import types as T

from sightlog import tables
from sightlog.specs import Check, Column, SpecError, TableSpec


def spec(**kw):
    base = dict(schema="raw", name="t", columns=(Column("appid", int, ge=0),), key=("appid",))
    return TableSpec(**{**base, **kw})


@pytest.mark.parametrize(
    "annotation, expected",
    [
        (int, T.LongType()), (float, T.DoubleType()), (str, T.StringType()),
        (bool, T.BooleanType()), (datetime, T.TimestampType()),
        (list[str], T.ArrayType(T.StringType())), (list[int], T.ArrayType(T.LongType())),
        (list[float], T.ArrayType(T.DoubleType())),
        (int | None, T.LongType()), (Optional[str], T.StringType()),
        (None | float, T.DoubleType()), (list[str] | None, T.ArrayType(T.StringType())),
    ],
)
def test_types(annotation, expected):
    assert Column("c", annotation).spark_type == expected


@pytest.mark.parametrize(
    "annotation", [dict, bytes, list[bool], int | str, Union[int, str, None], tuple[int, int]]
)
def test_unsupported_types(annotation):
    with pytest.raises(SpecError):
        Column("c", annotation)


def test_required_and_optional():
    s = spec(columns=(Column("a", int), Column("b", int | None)))
    assert [f.nullable for f in s.struct()] == [False, True]


@pytest.mark.parametrize("field, value", [("schema", ""), ("name", ""), ("key", ()), ("columns", ())])
def test_empty_declarations(field, value):
    with pytest.raises(SpecError):
        spec(**{field: value})


def test_bad_references():
    with pytest.raises(SpecError):
        spec(hash_columns=("nope",))
    with pytest.raises(SpecError):
        spec(check=Check(medians=("nope",)))
    with pytest.raises(SpecError):
        spec(columns=(Column("a", int), Column("a", int)))


def test_ddl():
    ddl = tables.PACKAGES.ddl()
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS raw.packages (")
    for part in ("`packageid` BIGINT", "`row_hash` BIGINT", "`last_update` TIMESTAMP",
                 "`ver` BIGINT", "USING parquet", "PARTITIONED BY (load_month)"):
        assert part in ddl
    assert "`categories_id` ARRAY<BIGINT>" in tables.CARDS.ddl()


def test_store_tables():
    assert len(tables.RAW_TABLES) == 6
    assert len(tables.CARDS.columns) == 17 and len(tables.SNAPSHOTS.columns) == 13
    assert sum(c.is_array for c in tables.CARDS.columns) == 6
    assert sum(map(len, tables.NOT_NULL_RAW.values())) == 7
    assert sum(map(len, tables.NOT_NULL_VIEWS.values())) == 2
    assert tables.SALE_LOG.key[0] == tables.PRICES.key[0] == "to_date(last_update)"
    assert tables.PRICES.check.medians == ("price_initial", "price_final", "discount_percent")
