"""Catalog tables: creation, appends, reads, compaction and schema checks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from sightlog.functions.hashing import with_audit
from sightlog.operators.clustering import clustered, range_bounds
from sightlog.operators.compaction import compact, unseen
from sightlog.session import use_utc
from sightlog.sources import staged
from sightlog.specs import TableSpec

logger = logging.getLogger(__name__)


def schema_name(custom: str | None, default: str) -> str:
    """A custom schema name is used as it is, without the default as prefix."""
    return default if custom is None else custom.strip()


class Warehouse:
    """Table operations of one session's catalog.

    ``location`` puts new databases under that folder instead of the warehouse directory.
    """

    def __init__(self, spark: SparkSession, location: str | None = None):
        self.spark = use_utc(spark)
        self.location = location

    def execute(self, statement: str) -> None:
        self.spark.sql(statement)

    def export(self, query: str, path: str) -> None:
        """Result of a query as Parquet, written by the executors."""
        self.spark.sql(query).write.mode("overwrite").parquet(path)

    def create_databases(self, names: Sequence[str]) -> None:
        for name in names:
            where = f" LOCATION '{self.location}/{name}'" if self.location else ""
            self.execute(f"CREATE DATABASE IF NOT EXISTS {name}{where}")

    def deploy(self, specs: Sequence[TableSpec]) -> None:
        """Create the table of every declaration that has none yet."""
        for spec in specs:
            self.create_databases([spec.schema])
            self.execute(spec.ddl())

    def drop(self, spec: TableSpec, if_exists: bool = True) -> None:
        self.execute(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{spec.full_name}")

    def read(
        self, spec: TableSpec, since: date | None = None, until: date | None = None
    ) -> DataFrame:
        """Table rows; a date range also prunes the month partitions.

        The file list is refreshed first: another session, such as that of a stream, may
        have appended since this one last looked.
        """
        self.spark.catalog.refreshTable(spec.full_name)
        df = self.spark.table(spec.full_name)
        if since is not None:
            df = df.where(
                (F.col("load_month") >= F.trunc(F.lit(since), "MM"))
                & (F.to_date("last_update") >= F.lit(since))
            )
        if until is not None:
            df = df.where(
                (F.col("load_month") <= F.trunc(F.lit(until), "MM"))
                & (F.to_date("last_update") <= F.lit(until))
            )
        return df

    def is_done(self, spec: TableSpec, key: str) -> bool:
        """Whether a load of this key is stored; catalog tables keep no such records."""
        return False

    def done_below(self, spec: TableSpec, key: str) -> set[str]:
        """Keys of the portions of a load that are stored."""
        return set()

    def finish(self, spec: TableSpec, key: str) -> None:
        """Record that all portions of a load are stored."""

    def append(self, spec: TableSpec, df: DataFrame, key: str | None = None) -> None:
        """Append rows, matched by column name.  Catalog tables do not record ``key``.

        Rows are balanced into files per month by size (a month is never one task) and
        sorted by key inside each file, so key filters skip row groups.
        """
        target = self.spark.table(spec.full_name)
        sort_keys = [F.expr(k) for k in spec.key]
        (
            df.select(*target.columns)
            .hint("rebalance", "load_month")
            .sortWithinPartitions("load_month", *sort_keys)
            .write.mode("append")
            .insertInto(spec.full_name)
        )

    def append_payload(
        self, spec: TableSpec, df: DataFrame, now: datetime | None = None,
        skip_known: bool = False, key: str | None = None,
    ) -> None:
        """Audit and append payload rows; ``skip_known`` leaves out states already stored.

        Where the table records keys, nothing happens if ``key`` is stored.

        Rows without a ``last_update`` get one load time, fixed here, so the table needs to
        be searched in one month only; stamped rows are searched for in the months they span.
        """
        if key is not None and self.is_done(spec, key):
            return
        stamped = "last_update" in df.columns
        if not stamped and now is None:
            now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        rows = with_audit(df, spec, now)
        if skip_known:
            months = None if stamped else [date(now.year, now.month, 1)]
            rows = unseen(rows, self.read(spec), spec, months)
        self.append(spec, rows, key)

    def append_directory(
        self, spec: TableSpec, path: str, now: datetime | None = None,
        files_per_batch: int | None = None, skip_known: bool = False, key: str | None = None,
        step: Callable[[str], None] | None = None,
    ) -> int:
        """Append a staged directory, whole or by portions; returns the number of portions.

        With ``key`` each portion is recorded as it is stored, and one that is stored is not loaded
        again: a load that broke off goes on where it stopped.  A portion that fails is named.
        ``step`` is told of each portion that is stored.
        """
        todo = staged.portions(self.spark, path, files_per_batch)
        keys = [None if key is None else f"{key}/{files_per_batch or 'all'}/{i}" for i in range(len(todo))]
        if key is not None and self.done_below(spec, key) - set(keys):
            raise staged.StageError(f"{path}: was begun with portions of another size, not {files_per_batch}")
        for i, portion in enumerate(todo):
            rows = staged.read_staged(self.spark, spec, portion)
            try:
                self.append_payload(spec, rows, now, skip_known, keys[i])
            except Exception as e:
                e.add_note(f"portion {i + 1} of {len(todo)} of {path} was not stored in {spec.full_name}")
                raise
            if step is not None:
                step(f"portion {i + 1}")
        if not todo:
            logger.warning("%s: nothing staged for %s", path, spec.full_name)
        return len(todo)

    def create_views(self, specs: Sequence[TableSpec], schema: str | None = "staging") -> None:
        """A staging view for each table, kept in the catalog for later sessions.

        Without ``schema`` a view stands beside its table.
        """
        for spec in specs:
            where = schema_name(schema, spec.schema)
            self.create_databases([where])
            self.execute(f"CREATE OR REPLACE VIEW {where}.stg_{spec.name} AS {view_sql(spec)}")

    def compact(
        self, spec: TableSpec, months: Sequence[date] | None = None, cluster_by: Sequence[str] = ()
    ) -> None:
        """Rewrite month partitions with one row per key, clustered by key or by ``cluster_by``.

        Range partitioning on (month, key) gives balanced files that cover narrow key
        ranges; with ``cluster_by`` files cover narrow ranges of each of those columns.  Only
        the partitions written are replaced.  A plain log stays as it is.
        """
        if not spec.keep_states:
            return
        df = self.read(spec)
        columns = df.columns
        if months is not None:
            df = df.where(F.col("load_month").isin(list(months)))
        (
            laid_out(df, spec, cluster_by)
            .select(*columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .insertInto(spec.full_name)
        )

    def add_column(self, spec: TableSpec, name: str) -> None:
        """Add a declared column to a table made without it; old rows read its default."""
        declared = spec.column(name).spark_type.simpleString()
        default = spec.added_defaults.get(name)
        clause = "" if default is None else f" DEFAULT {_literal(default)}"
        self.execute(f"ALTER TABLE {spec.full_name} ADD COLUMNS (`{name}` {declared}{clause})")

    def schema_drift(self, spec: TableSpec) -> DataFrame:
        """Differences between declaration and table: (column_name, expected, actual)."""
        actual = {
            f.name: f.dataType.simpleString()
            for f in self.spark.table(spec.full_name).schema.fields
        }
        expected = {f.name: f.dataType.simpleString() for f in spec.stored_struct()}
        rows = [
            (name, expected.get(name), actual.get(name))
            for name in [*expected, *(n for n in actual if n not in expected)]
            if expected.get(name) != actual.get(name)
        ]
        return self.spark.createDataFrame(
            rows, "column_name string, expected string, actual string"
        )


def laid_out(df: DataFrame, spec: TableSpec, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Compacted rows dealt and sorted as they are to be written."""
    if cluster_by:
        return clustered(compact(df, spec), cluster_by, ["load_month"], bounds=range_bounds(df, cluster_by))
    order = ["load_month", *[F.expr(k) for k in spec.key]]
    return compact(df, spec).repartitionByRange(*order).sortWithinPartitions(*order)


def view_sql(spec: TableSpec) -> str:
    """SQL of a table's staging view: one row per key, with its first sighting."""
    keys = ", ".join(spec.key)
    columns = ", ".join(f"`{c}`" for c in (*spec.view_columns, "row_hash"))
    if set(spec.view_columns) <= set(spec.hash_columns):
        return (
            f"SELECT {columns}, min(last_update) AS last_update FROM {spec.full_name} "
            f"GROUP BY {columns}, {keys}"
        )
    loose = ", ".join(c for c in spec.view_columns if c not in spec.hash_columns)
    return (
        f"SELECT {columns}, last_update FROM {spec.full_name} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY last_update, {loose}) = 1"
    )


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return str(value)
