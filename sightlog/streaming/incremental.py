"""Incremental loads: new landing files since the last run, through the same batch load."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sightlog.functions.hashing import version, with_audit
from sightlog.operators.compaction import unseen
from sightlog.sources.landing import LANDING_SCHEMA
from sightlog.sources.versions import VersionedWarehouse
from sightlog.sources.warehouse import Warehouse
from sightlog.specs import TableSpec


def new_files(
    spark: SparkSession, path: str, schema: str = LANDING_SCHEMA, fmt: str = "json",
    files_per_batch: int | None = None, **options: str,
) -> DataFrame:
    """Stream over the files of a landing folder."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch is not None:
        if files_per_batch < 1:
            raise ValueError(f"files_per_batch must be at least 1, got {files_per_batch}")
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(
    stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Load everything that has landed, then stop; the checkpoint remembers what was read."""
    query = (
        stream.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .start()
    )
    query.awaitTermination()
    return query


def append_new(spec: TableSpec) -> Callable[[DataFrame, int], None]:
    """Micro-batch loader for payload rows stamped with ``last_update``.

    A batch that is replayed after a failure finds its states already stored and adds none.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        warehouse = Warehouse(batch.sparkSession)
        rows = with_audit(batch, spec)
        warehouse.append(spec, unseen(rows, warehouse.read(spec), spec))

    return load


def first_sightings(stream: DataFrame, spec: TableSpec) -> DataFrame:
    """A stream of states as they are first seen, or seen to be older than was known.

    The earliest sighting of each key is state of the stream, so nothing is read back from the table.
    Beside it stands the time of the batch that brought it (the same in a replay): in update mode all keys
    of a batch come out, and those whose sighting is of an earlier batch are left out.  Rows are payload
    stamped with ``last_update``; late columns are part of the state here.
    """
    audited = with_audit(stream, spec)
    names = [f"__k{i}" for i in range(len(spec.key))]
    keyed = audited.select("*", F.current_timestamp().alias("__batch"), *[F.expr(k).alias(n) for k, n in zip(spec.key, names, strict=True)])
    fixed = [c for c in audited.columns if c not in ("last_update", "ver")]
    seen = F.min(F.struct("last_update", "__batch")).alias("__first")
    first = keyed.groupBy(*fixed, *names).agg(seen).where(F.col("__first.__batch") == F.current_timestamp())
    return first.withColumn("last_update", F.col("__first.last_update")).withColumn("ver", version()).select(*audited.columns)


def run_stateful(
    stream: DataFrame, warehouse: VersionedWarehouse, spec: TableSpec, checkpoint: str, name: str
) -> StreamingQuery:
    """Stores first sightings of everything that has landed, then stops.

    A batch is recorded with its rows under ``name``, so one that is replayed after a failure adds nothing.
    The table has a row for each time a key became older, which staging and compaction reduce to one.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        VersionedWarehouse(batch.sparkSession, warehouse.location).append(spec, batch, key=f"{name}/{batch_id}")

    query = (
        first_sightings(stream, spec).writeStream.outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).foreachBatch(load).start()
    )
    query.awaitTermination()
    return query
