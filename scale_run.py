"""Larger generated observation log with one hot entity: shows that operators scale out.

Usage: python scale_run.py ROWS [operator ...].  A third of all rows belong to entity 1, so a
plan that gathers an entity in one task shows up as one task running far longer than the rest.
"""

from __future__ import annotations

import json
import sys
import time
from datetime import date, datetime

from pyspark.sql import functions as F

from sightlog.functions.hashing import with_audit
from sightlog.operators.compaction import compact, unseen
from sightlog.operators.quality import measure
from sightlog.operators.ranks import split_batches
from sightlog.plans import queue as Q
from sightlog.plans.staging import staging_view
from sightlog.session import build_session
from sightlog.specs import Check, Column, TableSpec
from sightlog.tables import CATALOG, SALE_LOG, STATE_KEY

CARD = TableSpec(
    schema="raw", name="cards",
    columns=(Column("appid", int), Column("success", bool), Column("release_date", datetime | None)),
    key=STATE_KEY,
)


def observations(spark, n: int, seed: int, entities: int):
    h = F.abs(F.xxhash64("id", F.lit(seed)))
    return spark.range(n).select(
        F.when(h % 3 == 0, 1).otherwise(h % entities).cast("bigint").alias("appid"),
        F.concat(F.lit("state "), F.shiftright(h, 20) % 4).alias("name"),
        (h % 100_000 / 7).alias("price"),
        F.timestamp_seconds(F.lit(1_767_225_600) + F.shiftright(h, 12) % (60 * 86_400)).alias("last_update"),
    )


def main() -> None:
    n = int(sys.argv[1])
    wanted = sys.argv[2:]
    spark = build_session(
        "scale", "local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "20g", "spark.sql.shuffle.partitions": "64"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    entities = max(n // 20, 10)
    log = observations(spark, n, 1, entities)
    daily = with_audit(log, SALE_LOG)
    states = with_audit(log, CATALOG)
    cards = with_audit(
        observations(spark, n // 4, 2, entities).select(
            "appid", (F.col("price") > 3000).alias("success"),
            F.when(F.col("price") > 6000, F.col("last_update").cast("date").cast("timestamp")).alias("release_date"),
            "last_update"),
        CARD,
    )
    run_date = date(2026, 2, 22)
    jobs = {
        "staging": lambda: staging_view(states, CATALOG),
        "staging_daily": lambda: staging_view(daily, SALE_LOG),
        "latest_two": lambda: Q.latest_sales(staging_view(daily, SALE_LOG, ["appid"])),
        "compact": lambda: compact(daily, SALE_LOG),
        "unseen": lambda: unseen(daily.where("last_update > '2026-02-01'"), daily.where("last_update <= '2026-02-05'"), SALE_LOG),
        "metrics": lambda: measure(log, Check(medians=("price", "appid"))),
        "batches": lambda: split_batches(log, "appid", 500),
        "queue": lambda: Q.fetch_queue(
            staging_view(states, CATALOG), staging_view(daily, SALE_LOG, ["appid"]),
            staging_view(cards, CARD), run_date, datetime(2026, 4, 1)),
    }
    out = {}
    for name, job in jobs.items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - started, 1)
        print(name, out[name], flush=True)
    print(json.dumps({"rows": n, "seconds": out}))


if __name__ == "__main__":
    main()
