import json
import uuid
from dataclasses import replace
from datetime import datetime

import pytest

from sightlog.functions.hashing import with_audit
from sightlog.plans.staging import staging_view
from sightlog.sources.landing import read_landing
from sightlog.sources.warehouse import Warehouse
from sightlog.streaming.incremental import append_new, new_files, run_available
from sightlog.tables import CATALOG, SALE_LOG

SCHEMA = "appid long, name string, last_update timestamp"


@pytest.mark.parametrize("declared", [CATALOG, SALE_LOG], ids=["states", "daily"])
def test_stream_loads_what_batch_loads(spark, tmp_path, declared):
    spec = replace(declared, schema=f"s{uuid.uuid4().hex[:8]}")
    wh = Warehouse(spark)
    wh.deploy([spec])
    land, checkpoint = tmp_path / "land", str(tmp_path / "checkpoint")
    land.mkdir()

    def put(name, entries):
        (land / name).write_text("\n".join(
            json.dumps({"appid": i, "name": n, "last_update": t.isoformat()}) for i, n, t in entries))

    def run():
        stream = new_files(spark, str(land), SCHEMA, files_per_batch=1)
        run_available(stream, append_new(spec), checkpoint)

    put("a.json", [(1, "a", datetime(2025, 1, 30, 1)), (1, "a", datetime(2025, 1, 30, 5)), (2, "b", datetime(2025, 1, 31))])
    put("b.json", [(1, "a", datetime(2025, 2, 2)), (2, "c", datetime(2025, 2, 2))])
    run()
    after = wh.read(spec).count()
    run()
    assert wh.read(spec).count() == after
    put("c.json", [(2, "c", datetime(2025, 2, 2)), (3, "d", datetime(2025, 2, 3))])
    run()
    batch = with_audit(read_landing(spark, str(land), SCHEMA), spec)
    streamed = sorted(map(tuple, staging_view(wh.read(spec), spec).collect()))
    assert streamed == sorted(map(tuple, staging_view(batch, spec).collect()))


def test_replayed_batch_adds_nothing(spark):
    spec = replace(CATALOG, schema=f"s{uuid.uuid4().hex[:8]}")
    wh = Warehouse(spark)
    wh.deploy([spec])
    batch = spark.createDataFrame([(1, "a", datetime(2025, 1, 1))], SCHEMA)
    load = append_new(spec)
    load(batch, 0)
    load(batch, 0)
    assert wh.read(spec).count() == 1


def test_files_per_batch_guard(spark, tmp_path):
    with pytest.raises(ValueError):
        new_files(spark, str(tmp_path), SCHEMA, files_per_batch=0)
