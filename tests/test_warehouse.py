import json
import os
import uuid
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sightlog.operators.quality import CheckError
from sightlog.operators.validate import ValidationError
from sightlog.plans import staging
from sightlog.plans.load import gated_load
from sightlog.sources import landing, staged
from sightlog.sources.staged import StageError
from sightlog.sources.warehouse import Warehouse, schema_name
from sightlog.specs import SpecError
from sightlog.tables import CARDS, CATALOG, DATABASES, METRICS, PACKAGES, PRICES, RAW_TABLES

AT = datetime(2025, 11, 3, 0, 30)


@pytest.fixture()
def db():
    """A declaration moved to a database of its own per test."""
    name = f"t{uuid.uuid4().hex[:8]}"
    return lambda spec: replace(spec, schema=name)


@pytest.fixture()
def wh(spark):
    return Warehouse(spark)


def catalog_rows(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.col("id").alias("appid"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name")
    )


def test_databases_and_deploy(wh, db):
    wh.create_databases(DATABASES)
    specs = [db(s) for s in (*RAW_TABLES, METRICS)]
    wh.deploy(specs)
    wh.deploy(specs)
    for s in specs:
        table = wh.spark.table(s.full_name)
        assert table.columns == [f.name for f in s.stored_struct()]
        assert wh.schema_drift(s).count() == 0


def test_append_by_name_read_and_export(wh, db, spark, tmp_path):
    spec = db(CATALOG)
    wh.deploy([spec])
    wh.append_payload(spec, catalog_rows(spark, 3).select("name", "appid"), AT)
    wh.append_payload(spec, catalog_rows(spark, 2), datetime(2025, 12, 1))
    wh.export(f"SELECT appid, name FROM {spec.full_name}", str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["appid", "name"] and sorted(r["appid"] for r in got.collect()) == [0, 0, 1, 1, 2]
    assert wh.read(spec, since=date(2025, 12, 1)).count() == 2
    assert wh.read(spec, until=date(2025, 11, 30)).count() == 3
    plan = wh.read(spec, since=date(2025, 12, 1))._jdf.queryExecution().executedPlan().toString()
    assert "load_month" in plan.split("PartitionFilters")[1].split("]")[0]


def test_drop(wh, db):
    spec = db(CATALOG)
    wh.deploy([spec])
    wh.drop(spec)
    wh.drop(spec)
    assert not wh.spark.catalog.tableExists(spec.full_name)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        wh.drop(spec, if_exists=False)


def test_execute(wh, db):
    spec = db(CATALOG)
    wh.deploy([spec])
    wh.execute(f"ALTER TABLE {spec.full_name} ADD COLUMNS (extra DOUBLE)")
    drift = [tuple(r) for r in wh.schema_drift(spec).collect()]
    assert drift == [("extra", None, "double")]


def test_add_column_reads_default(wh, db, spark):
    spec = db(PACKAGES)
    before = replace(
        spec, columns=tuple(c for c in spec.columns if c.name != "name"), added_defaults={}
    )
    wh.deploy([before])
    old = spark.range(1).selectExpr("id AS appid", "2L AS packageid", "'t' AS package_option_text",
                                    "5L AS package_price_with_discount")
    wh.append_payload(before, old, AT)
    assert [tuple(r) for r in wh.schema_drift(spec).collect()] == [("name", "string", None)]
    wh.add_column(spec, "name")
    assert wh.schema_drift(spec).count() == 0
    wh.append_payload(spec, old.withColumn("name", F.lit("n")), AT)
    got = wh.read(spec).collect()
    assert {r["name"] for r in got} == {"", "n"} and len({r["row_hash"] for r in got}) == 1


def test_directory_guards(wh, db, spark, tmp_path, caplog):
    spec = db(CATALOG)
    wh.deploy([spec])
    with pytest.raises(StageError):
        wh.append_directory(spec, str(tmp_path), files_per_batch=0)
    with pytest.raises(StageError):
        wh.append_directory(spec, str(tmp_path / "nope"))
    (tmp_path / "file").write_text("x")
    with pytest.raises(StageError):
        wh.append_directory(spec, str(tmp_path / "file"))
    (tmp_path / "empty").mkdir()
    assert wh.append_directory(spec, str(tmp_path / "empty")) == 0
    assert "nothing staged" in caplog.text and wh.read(spec).count() == 0


@pytest.mark.parametrize("batch, appends", [(None, 1), (2, 2), (5, 1)])
def test_directory_append(wh, db, spark, tmp_path, batch, appends):
    spec = db(CATALOG)
    wh.deploy([spec])
    path = str(tmp_path / "run")
    catalog_rows(spark, 30).repartition(3).write.parquet(path)
    assert wh.append_directory(spec, path, AT, batch) == appends
    assert wh.read(spec).count() == 30


def test_compact_table(wh, db, spark):
    spec = db(CATALOG)
    wh.deploy([spec])
    for day in (datetime(2025, 11, 3), datetime(2025, 11, 4), datetime(2025, 12, 1)):
        wh.append_payload(spec, catalog_rows(spark, 5), day)
    view = sorted(map(tuple, staging.staging_view(wh.read(spec), spec).collect()))
    wh.compact(spec, [date(2025, 11, 1)])
    assert wh.read(spec).count() == 10
    assert wh.read(spec, until=date(2025, 11, 30)).agg(F.max("last_update")).first()[0] == datetime(2025, 11, 3)
    wh.compact(spec)
    assert wh.read(spec).count() == 10
    assert sorted(map(tuple, staging.staging_view(wh.read(spec), spec).collect())) == view


def test_views_are_recomputed(wh, db, spark):
    spec = db(CATALOG)
    wh.deploy([spec])
    staging.register(staging.staging_views(wh, [spec]))
    assert staging.resolve(spark, "stg_catalog").count() == 0
    wh.append_payload(spec, catalog_rows(spark, 2), AT)
    assert staging.resolve(spark, "stg_catalog").count() == 2
    mine = spark.range(1)
    assert staging.resolve(spark, "stg_catalog", {"stg_catalog": mine}) is mine


def test_schema_name():
    assert schema_name(" staging ", "analytics") == "staging"
    assert schema_name(None, "analytics") == "analytics"


# -- staging and loads ---------------------------------------------------------------------


def test_stage_validates(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    rows = spark.createDataFrame([("1", "a", "x")], "appid string, name string, extra string")
    staged.stage(rows, CATALOG, good)
    assert tuple(staged.read_staged(spark, CATALOG, good).first()) == (1, "a")
    broken = rows.unionByName(spark.createDataFrame([("-1", None, "x")], rows.schema))
    with pytest.raises(ValidationError) as e:
        staged.stage(broken, CATALOG, bad)
    assert e.value.counts == {"appid:ge": 1, "name:required": 1}
    assert os.listdir(tmp_path) == ["good"]
    staged.stage(broken, CATALOG, bad, quarantine=str(tmp_path / "aside"))
    assert staged.read_staged(spark, CATALOG, bad).count() == 1
    assert spark.read.parquet(str(tmp_path / "aside")).first()["violations"] == ["appid:ge", "name:required"]


def test_fan_out(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    responses = [
        (1, {"1": {"success": True, "data": {"name": "A", "package_groups": [{"subs": [{"packageid": 3}, {"packageid": 4}]}]}}}),
        (2, {"2": {"success": False}}),
    ]
    (land / "part.json").write_text(
        "\n".join(json.dumps({"appid": i, "payload": json.dumps(p)}) for i, p in responses))
    run = str(tmp_path / "run")
    dirs = staged.fan_out(landing.read_landing(spark, str(land)), run)
    assert sorted(os.listdir(run)) == ["cards", "packages", "prices"]
    counts = {s.name: staged.read_staged(spark, s, dirs[s.name]).count() for s in (CARDS, PRICES, PACKAGES)}
    assert counts == {"cards": 2, "prices": 1, "packages": 2}


def test_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n"items": []}')
    got = landing.read_payload_files(spark, str(tmp_path)).collect()
    assert len(got) == 1 and json.loads(got[0]["payload"]) == {"items": []}


class Loads:
    def __init__(self, wh, spec, metrics, tmp_path):
        self.wh, self.spec, self.metrics, self.base, self.n = wh, spec, metrics, tmp_path, 0
        wh.deploy([spec, metrics])

    def stage(self, rows):
        self.n += 1
        path = str(self.base / f"run{self.n}")
        staged.stage(rows, self.spec, path)
        return path

    def load(self, path, day, **kw):
        at = datetime(2025, 11, day, 0, 30)
        gated_load(self.wh, self.spec, path, at, "daily", now=at, metrics_spec=self.metrics, **kw)

    def counts(self):
        return self.wh.read(self.spec).count(), self.wh.read(self.metrics).count()


@pytest.fixture()
def loads(wh, db, tmp_path):
    return lambda spec: Loads(wh, db(spec), db(METRICS), tmp_path)


def test_gated_load(loads, spark, caplog):
    catalog = loads(CATALOG)
    first = catalog.stage(catalog_rows(spark, 100))
    catalog.load(first, 1)
    assert catalog.counts() == (100, 1) and not os.path.exists(first)
    # past the error threshold: nothing is stored, the stage stays, and stays failed
    big = catalog.stage(catalog_rows(spark, 160))
    for day in (2, 3):
        with pytest.raises(CheckError):
            catalog.load(big, day)
        assert catalog.counts() == (100, 1) and os.path.exists(big)
    # past the warning threshold: loaded, with a warning
    catalog.load(catalog.stage(catalog_rows(spark, 130)), 4)
    assert catalog.counts() == (230, 2) and "moved by 30 %" in caplog.text
    catalog.load(big, 5)
    assert catalog.counts() == (390, 3)


def test_load_twice_equals_load_once(loads, spark):
    catalog = loads(CATALOG)
    for _ in range(2):
        catalog.load(catalog.stage(catalog_rows(spark, 50)), 1, skip_known=True)
    assert catalog.counts()[0] == 50


def test_load_medians_and_empty_directory(loads, spark, tmp_path):
    prices = loads(PRICES)
    rows = spark.range(10).selectExpr("id AS appid", "'n' AS name", "'' AS currency", "id * 10 AS price_initial",
                                      "id AS price_final", "NULL AS discount_percent")
    prices.load(prices.stage(rows), 1)
    got = {r["metrics_name"]: r["metrics_value"] for r in prices.wh.read(prices.metrics).collect()}
    assert got == {"row_count": 10.0, "price_initial": 45.0, "price_final": 4.5, "discount_percent": None}
    assert prices.wh.read(prices.spec).where("currency IS NOT NULL").count() == 0
    empty = tmp_path / "none"
    empty.mkdir()
    prices.load(str(empty), 2)
    assert prices.counts() == (10, 4)


def test_unchecked_load(loads, spark):
    unchecked = loads(replace(CATALOG, check=None))
    unchecked.load(unchecked.stage(catalog_rows(spark, 5)), 1)
    unchecked.load(unchecked.stage(catalog_rows(spark, 500)), 2)
    assert unchecked.counts() == (505, 0)


def test_views_outlive_the_session(wh, db, spark):
    specs = [db(CATALOG), db(PACKAGES)]
    wh.deploy(specs)
    for day in (datetime(2025, 11, 3), datetime(2025, 11, 4)):
        wh.append_payload(specs[0], catalog_rows(spark, 5), day)
    schema = specs[0].schema
    wh.create_views(specs, schema)
    other = spark.newSession()
    got = other.table(f"{schema}.stg_{CATALOG.name}")
    want = staging.staging_view(wh.read(specs[0]), specs[0])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert other.table(f"{schema}.stg_{PACKAGES.name}").count() == 0


def test_a_plain_log_keeps_equal_rows(wh, db, spark):
    spec = db(METRICS)
    wh.deploy([spec])
    row = spark.createDataFrame(
        [("a", "raw", "t", "row_count", "count", 5.0)],
        "dag_id string, schema_name string, table_name string, metrics_name string, agg_type string, metrics_value double",
    )
    for load in (row, row.selectExpr("'b' AS dag_id", *row.columns[1:])):
        wh.append_payload(spec, load, AT, skip_known=True)
    wh.compact(spec)
    assert wh.read(spec).count() == 2
    with pytest.raises(SpecError):
        staging.staging_view(wh.read(spec), spec)


def test_repeatable_append_reads_the_months_of_the_batch(wh, db, spark):
    from sightlog.functions.hashing import with_audit
    from sightlog.operators.compaction import unseen

    spec = db(CATALOG)
    wh.deploy([spec])
    for month in (10, 11, 12):
        wh.append_payload(spec, catalog_rows(spark, 3), datetime(2025, month, 1))
    batch = with_audit(catalog_rows(spark, 4), spec, datetime(2025, 11, 2))
    new = unseen(batch, wh.read(spec), spec)
    assert [r["appid"] for r in new.collect()] == [3]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert any("load_month" in part.split("]")[0] for part in plan.split("PartitionFilters")[1:])


def staged_rows(rows, *ids):
    return rows([(i, "n") for i in ids], "appid long, name string")


def test_a_crash_before_publishing_leaves_nothing_to_load(rows, spark, tmp_path, monkeypatch):
    path = str(tmp_path / "run")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(staged, "move", crash)
        with pytest.raises(RuntimeError):
            staged.stage(staged_rows(rows, 1, 2), CATALOG, path)
    assert not staged.exists(spark, path)
    staged.stage(staged_rows(rows, 3), CATALOG, path)
    assert [r["appid"] for r in staged.read_staged(spark, CATALOG, path).collect()] == [3]
    assert not staged.exists(spark, f"{path}__writing")


def test_a_rerun_replaces_the_quarantine(rows, spark, tmp_path):
    path, aside = str(tmp_path / "run"), str(tmp_path / "aside")
    for _ in range(2):
        staged.stage(staged_rows(rows, 1, -2), CATALOG, path, aside)
    assert spark.read.parquet(aside).count() == 1 and staged.read_staged(spark, CATALOG, path).count() == 1
    staged.stage(staged_rows(rows, -1), CATALOG, path, aside)
    assert staged.read_staged(spark, CATALOG, path).count() == 0 and not staged.has_rows_staged(spark, path)
    staged.stage(staged_rows(rows, 1), CATALOG, path, aside)
    assert not staged.exists(spark, aside)


def test_staging_by_a_column(rows, spark, tmp_path):
    df = rows([(1, "a", 7), (2, "b", 8), (3, "c", 8)], "appid long, name string, day int")
    staged.stage(df, CATALOG, str(tmp_path / "run"), by=("day",))
    assert staged.parts(spark, str(tmp_path / "run")) == ["day=7", "day=8"]
    assert staged.read_staged(spark, CATALOG, str(tmp_path / "run" / "day=8")).count() == 2
