"""The gated load: check, append, record, clean up."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from sightlog.functions.scalar import instant
from sightlog.operators.quality import (
    collect_metrics,
    compare_metrics,
    previous_metrics,
    require_stable,
)
from sightlog.operators.summaries import summarize
from sightlog.sources import staged
from sightlog.sources.warehouse import Warehouse
from sightlog.specs import Check, TableSpec
from sightlog.tables import METRICS

logger = logging.getLogger(__name__)

#: Says that a load is gated by the check its table declares.
TABLE_CHECK = "table"


def check_load(
    warehouse: Warehouse, rows: DataFrame, spec: TableSpec, check: Check, at: datetime, load: str,
    metrics_spec: TableSpec = METRICS,
) -> DataFrame:
    """Metrics of a load that stays within its thresholds; raises CheckError otherwise.

    Only the metric rows, one per declared metric, come to the driver.
    """
    spark = warehouse.spark
    measured = collect_metrics(rows, spec, check, at, load).drop("last_update").collect()
    metrics = spark.createDataFrame(
        measured,
        "dag_id string, schema_name string, table_name string, metrics_name string, "
        "agg_type string, metrics_value double",
    ).withColumn("last_update", instant(at))
    previous = previous_metrics(warehouse.read(metrics_spec), spec, check, at, load)
    compared = compare_metrics(metrics, previous, check).collect()
    for row in compared:
        if row["status"] == "warn":
            logger.warning(
                "%s of %s moved by %.0f %% since the load before",
                row["metrics_name"], spec.full_name, 100 * row["drift"],
            )
    require_stable(compared, spec)
    return metrics


def gated_load(
    warehouse: Warehouse,
    spec: TableSpec,
    staged_dir: str,
    at: datetime,
    load: str,
    now: datetime | None = None,
    files_per_batch: int | None = None,
    skip_known: bool = False,
    metrics_spec: TableSpec = METRICS,
    check: Check | None | str = TABLE_CHECK,
    step: Callable[[str], None] | None = None,
    summaries_spec: TableSpec | None = None,
) -> None:
    """Load a staged directory into its table.

    In a warehouse that records loads, a load is stored once: its portions and its metrics are recorded
    as they are stored, by load, run time and directory, and a load that broke off at any point goes on
    there when it is run again.  The directory names the run, so it must not be staged anew in between.
    ``step`` is told of each step that is done.  ``summaries_spec`` keeps a rank summary of each median.

    The table's check gates the load unless ``check`` gives another, or None for none: a full
    crawl is not held to what daily slices of the same table are.

    The drift check comes first, so a load that fails it leaves tables and metrics as they
    were and its staged files in place.  The directory goes only after data and metrics are
    stored.  ``at`` stamps the metrics (the run), ``now`` the rows (the load).
    """
    spark = warehouse.spark
    tell = step or (lambda name: None)
    key = f"{load}@{at.isoformat()}:{staged_dir}"
    if warehouse.is_done(spec, key):
        staged.remove(spark, staged_dir)
        return
    wanted = spec.check if check == TABLE_CHECK else check
    gated = bool(wanted) and staged.has_rows_staged(spark, staged_dir)
    recorded = f"{key}:{spec.full_name}"
    metrics = None
    if gated and not warehouse.is_done(metrics_spec, recorded):  # metrics that are stored were passed
        rows = staged.read_staged(spark, spec, staged_dir)
        metrics = check_load(warehouse, rows, spec, wanted, at, load, metrics_spec)
        tell("check")
    warehouse.append_directory(spec, staged_dir, now, files_per_batch, skip_known, key, step)
    if metrics is not None:
        warehouse.append_payload(metrics_spec, metrics, key=recorded)
        tell("metrics")
    if summaries_spec is not None and gated and wanted.medians:
        named = {"dag_id": load, "schema_name": spec.schema, "table_name": spec.name}
        found = summarize(staged.read_staged(spark, spec, staged_dir), wanted.medians)
        stamped = found.withColumns({c: F.lit(v) for c, v in named.items()} | {"last_update": instant(at)})
        warehouse.append_payload(summaries_spec, stamped, key=recorded)
        tell("summaries")
    warehouse.finish(spec, key)
    tell("record")
    staged.remove(spark, staged_dir)
