"""What the stored files hold against what a table declares.

A folder of a versioned table was written by one job, so one Parquet footer tells the types of all its
months.  Footers are read by small jobs side by side, as many as the table has folders; compaction leaves
few.  No rows are read.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, types as T

from sightlog.sources.versions import VersionedWarehouse
from sightlog.specs import TableSpec

# Types in the order in which a Parquet reader may take one for a later one.
_WIDENING = (("tinyint", "smallint", "int", "bigint"), ("tinyint", "smallint", "int", "double"), ("float", "double"),
             ("date", "timestamp_ntz"))
_AT_ONCE = 8


def widens(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether values stored as one type are read as another one without loss."""
    if stored == wanted:
        return True
    if isinstance(stored, T.DecimalType) and isinstance(wanted, T.DecimalType):
        before = wanted.precision - wanted.scale >= stored.precision - stored.scale
        return before and wanted.scale >= stored.scale
    if isinstance(stored, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return widens(stored.elementType, wanted.elementType)
    names = stored.simpleString(), wanted.simpleString()
    return any(set(names) <= set(chain) and chain.index(names[0]) < chain.index(names[1]) for chain in _WIDENING)


def verdict(stored: T.DataType | None, declared: T.DataType | None) -> str:
    """``same``; ``widened`` and ``missing`` are read whole; ``extra`` is left out; ``conflict`` cannot be read."""
    if stored is None:
        return "missing"
    if declared is None:
        return "extra"
    return "same" if stored == declared else "widened" if widens(stored, declared) else "conflict"


def _plain(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: T.ArrayType(f.dataType.elementType) if isinstance(f.dataType, T.ArrayType) else f.dataType for f in schema}


def _footer(spark: SparkSession, path: str) -> dict[str, T.DataType]:
    return _plain(spark.read.parquet(path).schema)


def stored_drift(warehouse: VersionedWarehouse, spec: TableSpec, version: int | None = None) -> DataFrame:
    """Columns of each month's folders that are not stored as declared, with the verdict on them.

    One row for each month, column and stored type: (load_month, column_name, stored, declared, verdict,
    folders).  A table without folders, or one stored as declared throughout, gives none.
    """
    spark, log = warehouse.spark, warehouse.log(spec)
    parts = log.read(version).parts
    by_write: dict[str, list] = {}
    for part in sorted(parts):
        by_write.setdefault(part.path.rsplit("/", 1)[0], []).append(part)
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        found = list(pool.map(lambda ps: _footer(spark, f"{log.path}/{ps[0].path}"), by_write.values()))
    declared = _plain(spec.stored_struct())
    counts: dict[tuple, int] = {}
    for stored, members in zip(found, by_write.values(), strict=True):
        for name in {**declared, **stored}:
            kinds = stored.get(name), declared.get(name)
            said = verdict(*kinds)
            if said == "same":
                continue
            for part in members:
                row = (part.month, name, *[k and k.simpleString() for k in kinds], said)
                counts[row] = counts.get(row, 0) + 1
    rows = [(*row, n) for row, n in counts.items()]
    fields = "load_month string, column_name string, stored string, declared string, verdict string, folders bigint"
    return spark.createDataFrame(rows, fields).selectExpr("CAST(load_month AS DATE) AS load_month", "* EXCEPT (load_month)")
