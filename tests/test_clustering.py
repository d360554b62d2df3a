"""Clustering on several columns: keys, ranges, files left out, skew and odd values."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sightlog.operators.clustering import cluster_key, clustered, file_ranges, range_bounds
from sightlog.sources.versions import VersionedWarehouse
from sightlog.sources.warehouse import Warehouse
from sightlog.tables import CATALOG


def interleaved(numbers, bits):
    """Plain version: the highest bit of every number, then the next of every number, and so on."""
    key = 0
    for bit in reversed(range(bits)):
        for n in numbers:
            key = key * 2 + (n >> bit & 1)
    return key


def test_keys_are_those_of_a_plain_version(spark):
    rng = random.Random(3)
    data = [(rng.randrange(500), rng.gauss(0, 1), rng.choice("abcdefgh") * rng.randrange(9)) for _ in range(3000)]
    df = spark.createDataFrame(data, "a bigint, b double, c string").repartition(5)
    bounds = range_bounds(df, ["a", "b", "c"], bits=4)
    as_number = lambda s: int.from_bytes(s.encode()[:7].ljust(7, b"\0"), "big")
    for r in df.withColumn("key", cluster_key(df, bounds, bits=4)).collect():
        numbers = [
            sum(v >= b for b in bounds[c]) for c, v in (("a", r["a"]), ("b", r["b"]), ("c", as_number(r["c"])))
        ]
        assert r["key"] == interleaved(numbers, 4)


def test_a_filter_on_either_column_leaves_most_files_out(spark, tmp_path):
    rng = random.Random(5)
    data = [(rng.randrange(100_000), date.fromordinal(738_000 + rng.randrange(1000)), i) for i in range(20_000)]
    df = spark.createDataFrame(data, "id bigint, day date, n bigint").repartition(4)
    clustered(df, ["id", "day"], files=64).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    ranges = file_ranges(stored, ["id", "day"]).collect()
    assert len(ranges) == 64
    assert sum(r["min_id"] <= 5000 <= r["max_id"] for r in ranges) <= 16
    assert sum(r["min_day"] <= date.fromordinal(738_500) <= r["max_day"] for r in ranges) <= 16
    assert sorted(map(tuple, stored.collect())) == sorted(data)


def test_one_hot_value_is_not_one_file(spark):
    df = spark.range(8000).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b"), "id")
    dealt = clustered(df, ["a", "b"], files=12)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 8000 / 4


def test_nulls_empty_frames_and_all_types(spark):
    fields = "a bigint, s string, d date, t timestamp, x decimal(9,2), f double, b boolean"
    rows = [(None,) * 7, (1, "", date(2024, 1, 1), datetime(2024, 1, 1), None, float("nan"), True),
            (-5, "é" * 50, date(1960, 1, 1), datetime(1960, 1, 1), 3, float("-inf"), False)] * 2
    df = spark.createDataFrame(rows, fields.replace("decimal(9,2)", "int")).withColumn("x", F.col("x").cast("decimal(9,2)"))
    for columns in (["a", "s"], ["d", "t", "x"], ["f", "b"]):
        assert clustered(df, columns).count() == 6
        assert clustered(df.limit(0), columns).count() == 0
        assert clustered(df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]), columns).count() == 6


def test_what_cannot_be_clustered_by_is_refused(spark):
    df = spark.range(3).select(F.array("id").alias("list"), "id")
    with pytest.raises(TypeError, match="list"):
        clustered(df, ["list"])
    with pytest.raises(ValueError, match="bigint"):
        cluster_key(df, {"id": [1]}, bits=64)


@pytest.mark.parametrize("kind", ["catalog", "versions"])
def test_compaction_may_cluster(spark, tmp_path, kind):
    from dataclasses import replace

    spec = replace(CATALOG, schema=f"clustered_{kind}")
    wh = VersionedWarehouse(spark, str(tmp_path)) if kind == "versions" else Warehouse(spark, str(tmp_path))
    wh.deploy([spec])
    rows = spark.range(600).select(F.pmod("id", F.lit(200)).alias("appid"), F.concat(F.lit("n"), F.pmod("id", F.lit(200))).alias("name"))
    for day in (1, 2):
        wh.append_payload(spec, rows, datetime(2025, 11, day))
    wh.compact(spec, cluster_by=["appid", "name"])
    kept = wh.read(spec).collect()
    assert sorted(r["appid"] for r in kept) == list(range(200))
    assert {r["last_update"] for r in kept} == {datetime(2025, 11, 1)}
