"""Tables as versions: loads stored once, compaction beside other work, snapshots, conflicts."""

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sightlog.operators.quality import CheckError, previous_metrics
from sightlog.plans.load import gated_load
from sightlog.sources import staged
from sightlog.sources.staged import StageError
from sightlog.sources.versions import ConflictError, Part, Version, VersionedWarehouse, VersionLog
from sightlog.specs import Check
from sightlog.streaming.incremental import new_files, run_stateful
from sightlog.tables import CATALOG, METRICS, PRICES, SALE_LOG, SUMMARIES

AT = datetime(2025, 11, 3, 0, 30)


class Stopped(Exception):
    pass


def catalog_rows(spark, n, start=0):
    return spark.range(start, start + n).select(
        F.col("id").alias("appid"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name")
    )


@pytest.fixture()
def wh(spark, tmp_path):
    return VersionedWarehouse(spark, str(tmp_path / "tables"))


def stop_at(n: int):
    """Ends the run after its step number ``n``."""
    seen = []

    def step(name: str) -> None:
        seen.append(name)
        if len(seen) == n:
            raise Stopped(name)

    return step


@pytest.mark.parametrize("files", [None, 1, 2])
@pytest.mark.parametrize("stop", range(1, 8))
def test_a_load_stopped_anywhere_is_stored_once(wh, spark, tmp_path, files, stop):
    path = str(tmp_path / "run")
    staged.stage(catalog_rows(spark, 9).repartition(3), CATALOG, path)
    try:
        gated_load(wh, CATALOG, path, AT, "daily", AT, files, step=stop_at(stop))
    except Stopped:
        gated_load(wh, CATALOG, path, AT, "daily", AT, files)
    assert sorted(r["appid"] for r in wh.read(CATALOG).collect()) == list(range(9))
    assert wh.read(METRICS).count() == 1
    assert previous_metrics(wh.read(METRICS), CATALOG, CATALOG.check, AT, "daily").count() == 1
    assert not staged.exists(spark, path)
    assert len(wh.log(CATALOG).read().done) == 1  # one record of the whole load
    gated_load(wh, CATALOG, path, AT, "daily", AT, files)  # of a directory that is gone
    assert wh.read(CATALOG).count() == 9


def test_a_portion_that_fails_is_named_and_the_load_goes_on_there(wh, spark, tmp_path, monkeypatch):
    path = str(tmp_path / "run")
    staged.stage(catalog_rows(spark, 9).repartition(3), CATALOG, path)
    write, calls = VersionLog.write, []

    def broken(self, df):
        calls.append(self.path)
        if len(calls) == 2:
            raise OSError("disk full")
        return write(self, df)

    monkeypatch.setattr(VersionLog, "write", broken)
    with pytest.raises(OSError) as failed:
        wh.append_directory(CATALOG, path, AT, 1, key="k")
    assert "portion 2 of 3" in failed.value.__notes__[0]
    stored = wh.read(CATALOG).count()
    with pytest.raises(StageError, match="another size"):
        wh.append_directory(CATALOG, path, AT, 2, key="k")
    assert 0 < stored < 9 and wh.append_directory(CATALOG, path, AT, 1, key="k") == 3
    assert wh.read(CATALOG).count() == 9 and len(calls) == 4


def test_a_refused_load_stores_nothing_and_is_refused_again(wh, spark, tmp_path):
    def load(n, at):
        path = str(tmp_path / f"run-{n}")
        staged.stage(catalog_rows(spark, n), CATALOG, path)
        gated_load(wh, CATALOG, path, at, "daily", at)

    load(10, AT)
    for _ in range(2):
        with pytest.raises(CheckError):
            load(100, AT.replace(day=4))
        assert staged.exists(spark, str(tmp_path / "run-100"))
    assert wh.read(CATALOG).count() == 10 and wh.read(METRICS).count() == 1


def test_summaries_are_kept_once_a_load(wh, spark, tmp_path):
    rows = spark.range(1000).selectExpr("id AS appid", "'x' AS name", "'EUR' AS currency", "id AS price_initial", "id AS price_final", "NULL AS discount_percent")
    path = str(tmp_path / "run")
    staged.stage(rows, PRICES, path)
    with pytest.raises(Stopped):
        gated_load(wh, PRICES, path, AT, "daily", AT, step=lambda n: (_ for _ in ()).throw(Stopped()) if n == "summaries" else None, summaries_spec=SUMMARIES)
    gated_load(wh, PRICES, path, AT, "daily", AT, summaries_spec=SUMMARIES)
    found = {r["metrics_name"]: r["n"] for r in wh.read(SUMMARIES).collect()}
    assert found == {"price_initial": 1000, "price_final": 1000} and wh.read(SUMMARIES).count() == 2


def test_readers_keep_their_version_and_appends_survive_compaction(wh, spark):
    wh.append_payload(CATALOG, catalog_rows(spark, 5), datetime(2025, 11, 1))
    wh.append_payload(CATALOG, catalog_rows(spark, 5), datetime(2025, 11, 2))
    before = wh.read(CATALOG)
    wh.compact(CATALOG, before_switch=lambda: wh.append_payload(CATALOG, catalog_rows(spark, 2, 100), datetime(2025, 11, 3)))
    assert before.count() == 10
    after = wh.read(CATALOG)
    assert sorted(r["appid"] for r in after.collect()) == [0, 1, 2, 3, 4, 100, 101]
    assert {r["last_update"] for r in after.where("appid < 100").collect()} == {datetime(2025, 11, 1)}
    assert wh.read(CATALOG, version=2).count() == 10
    assert wh.vacuum(CATALOG, keep=1) == 2
    assert wh.read(CATALOG).count() == 7 and wh.log(CATALOG).numbers() == [4]


def test_two_compactions_of_the_same_months_conflict(wh, spark):
    wh.append_payload(CATALOG, catalog_rows(spark, 5), AT)
    wh.append_payload(CATALOG, catalog_rows(spark, 5), AT)
    with pytest.raises(ConflictError):
        wh.compact(CATALOG, before_switch=lambda: wh.compact(CATALOG))
    assert wh.read(CATALOG).count() == 5
    wh.append_payload(CATALOG, catalog_rows(spark, 5), datetime(2025, 12, 1))
    wh.compact(CATALOG, [date(2025, 12, 1)], before_switch=lambda: wh.compact(CATALOG, [date(2025, 11, 1)]))
    assert wh.read(CATALOG).count() == 10


def test_months_are_pruned_by_the_version(wh, spark):
    for month in (9, 10, 11):
        wh.append_payload(CATALOG, catalog_rows(spark, 2), datetime(2025, month, 15))
    df = wh.read(CATALOG, since=date(2025, 10, 2), until=date(2025, 10, 30))
    assert df.count() == 2 and all("part_month=2025-10-01" in f for f in df.inputFiles())
    assert wh.read(CATALOG, since=date(2026, 1, 1)).count() == 0


def test_numbers_are_taken_once(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path / "t"))
    assert log.read() == Version(0) and log.numbers() == []
    assert log._publish(Version(1, done=frozenset({"a"}))) and not log._publish(Version(1, done=frozenset({"b"})))
    assert log.read().done == {"a"}
    # a writer that finds its number taken makes its change on the version that took it
    raced = []

    def change(now: Version) -> Version:
        if not raced:
            raced.append(now.number)
            assert log._publish(Version(2, done=now.done | {"other"}))
        return replace(now, done=now.done | {"mine"})

    assert log.commit(change).number == 3 and log.read().done == {"a", "other", "mine"}
    assert Version.parse(log.read().text()) == log.read()


def test_writers_side_by_side(wh, spark):
    def add(i: int) -> None:
        wh.append_payload(CATALOG, catalog_rows(spark, 1, i), AT, key=f"k{i % 4}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(8)))
    assert wh.read(CATALOG).count() == 4 and wh.log(CATALOG).read().done == {"k0", "k1", "k2", "k3"}


def test_an_empty_table_reads_as_no_rows(wh, spark):
    assert wh.read(SALE_LOG).count() == 0 and wh.read(SALE_LOG).columns == SALE_LOG.stored_struct().names
    wh.compact(SALE_LOG)
    assert wh.log(SALE_LOG).numbers() == []
    assert wh.log(SALE_LOG).frame([], SALE_LOG.stored_struct()).count() == 0 and sorted([Part("b", "x"), Part("a", "y")])[0].month == "a"


def test_stream_state_knows_what_was_seen(wh, spark, tmp_path):
    """Late files, repeated files, a restart and a replayed batch: earliest sightings by day."""
    rng = random.Random(3)
    rows = [(rng.randrange(20), f"n{rng.randrange(2)}", datetime(2025, 11, 1 + rng.randrange(3), rng.randrange(24))) for _ in range(300)]
    landing, spec = str(tmp_path / "landing"), SALE_LOG
    fields = "appid bigint, name string, last_update timestamp"
    for begin in (200, 100, 0, 150):  # out of order, and some again
        spark.createDataFrame(rows[begin : begin + 100], fields).repartition(2).write.mode("append").parquet(landing)
        run_stateful(new_files(spark, landing, fields, "parquet", files_per_batch=1), wh, spec, str(tmp_path / "cp"), "s")
    stored = wh.read(spec)
    first = {}
    for a, n, t in rows:
        first[a, n, t.date()] = min(t, first.get((a, n, t.date()), t))
    found = stored.groupBy("appid", "name", F.to_date("last_update").alias("d")).agg(F.min("last_update").alias("t")).collect()
    assert {(r["appid"], r["name"], r["d"]): r["t"] for r in found} == first
    n = stored.count()
    assert n < len(rows)
    batch = stored.limit(3)
    wh.append(spec, batch, key="s/0")  # a batch that was stored before
    assert wh.read(spec).count() == n


def test_check_is_needed_for_summaries(wh, spark, tmp_path):
    path = str(tmp_path / "run")
    staged.stage(catalog_rows(spark, 3), CATALOG, path)
    gated_load(wh, CATALOG, path, AT, "x", AT, check=Check(), summaries_spec=SUMMARIES)
    assert wh.read(SUMMARIES).count() == 0 and wh.read(CATALOG).count() == 3
