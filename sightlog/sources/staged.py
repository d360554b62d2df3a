"""Staged loads: typed Parquet directories per run, removed once a load is stored."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sightlog.operators import flatten
from sightlog.operators.validate import VIOLATIONS, ValidationError, validate, violation_counts
from sightlog.specs import TableSpec
from sightlog.tables import CARDS, PACKAGES, PRICES

logger = logging.getLogger(__name__)

_GOOD = "row_good"


class StageError(ValueError):
    """A staged directory or a parameter that cannot be loaded."""


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _files(spark: SparkSession, path: str) -> Iterator[str]:
    """Parquet files of a directory, one at a time; anything but a directory is an error."""
    fs, folder = _path(spark, path)
    if not fs.exists(folder) or not fs.getFileStatus(folder).isDirectory():
        raise StageError(f"not a directory: {path}")
    listing = fs.listStatusIterator(folder)
    while listing.hasNext():
        found = listing.next()
        if found.isFile() and found.getPath().getName().endswith(".parquet"):
            yield found.getPath().toString()


def has_rows_staged(spark: SparkSession, path: str) -> bool:
    """Whether a directory holds a Parquet file; looks no further than the first."""
    return next(_files(spark, path), None) is not None


def portions(spark: SparkSession, path: str, files: int | None = None) -> list[str | list[str]]:
    """What to load one after another: the directory, or its files by ``files`` at a time.

    Names are listed only if they are asked for.
    """
    if files is None:
        return [path] if has_rows_staged(spark, path) else []
    if files < 1:
        raise StageError(f"a portion needs at least one file, not {files}")
    ordered = sorted(_files(spark, path))
    return [ordered[i:i + files] for i in range(0, len(ordered), files)]


def parts(spark: SparkSession, path: str) -> list[str]:
    """Sub-directories of a directory that was staged by a column, in name order."""
    fs, folder = _path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _path(spark, path)
    return fs.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _path(spark, path)
    if fs.exists(folder) and not fs.delete(folder, True):
        raise StageError(f"could not remove {path}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a directory in the place of another."""
    remove(spark, target)
    fs, to = _path(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(_path(spark, source)[1], to):
        raise StageError(f"could not move {source} to {target}")


def stage(
    df: DataFrame, spec: TableSpec, path: str, quarantine: str | None = None,
    by: tuple[str, ...] = (),
) -> None:
    """Validate rows and write the typed payload to ``path``.

    Rows are checked and written once, apart by whether they break a rule, under a name that no
    load looks at; the good ones are put in place last, so a directory that is there is whole.
    A broken rule stops the load; with ``quarantine`` the rows at fault replace what an earlier
    run put there.  ``by`` makes a sub-directory for each value of these columns.
    """
    spark, writing = df.sparkSession, f"{path}__writing"
    remove(spark, writing)
    validated = validate(df, spec, keep=by)
    flagged = validated.withColumn(_GOOD, F.size(VIOLATIONS) == 0)
    flagged.write.partitionBy(_GOOD, *by).parquet(writing)
    good, broken = f"{writing}/{_GOOD}=true", f"{writing}/{_GOOD}=false"
    if exists(spark, broken):
        found = violation_counts(spark.read.schema(validated.schema).parquet(broken)).collect()
        counts = {r["rule"]: r["rows"] for r in found}
        if quarantine is None:
            remove(spark, writing)
            raise ValidationError(spec.full_name, counts)
        logger.warning("%s: rows quarantined by rule: %s", spec.full_name, counts)
        move(spark, broken, quarantine)
    elif quarantine is not None:
        remove(spark, quarantine)
    if not exists(spark, good):  # no good rows: an empty directory
        fs, folder = _path(spark, good)
        fs.mkdirs(folder)
    move(spark, good, path)
    remove(spark, writing)


# Which rows of a parsed card response go to which table.
CARD_STREAMS: tuple[tuple[TableSpec, Callable[[DataFrame], DataFrame]], ...] = (
    (CARDS, flatten.card_rows),
    (PRICES, flatten.price_rows),
    (PACKAGES, flatten.package_rows),
)


def fan_out(
    landing: DataFrame,
    run_dir: str,
    streams: Sequence[tuple[TableSpec, Callable[[DataFrame], DataFrame]]] = CARD_STREAMS,
    quarantine: str | None = None,
) -> dict[str, str]:
    """Stage one landing frame as several tables; returns the directory per table.

    With ``quarantine`` rows that break rules go to a directory per table there.

    The JSON is parsed once into a Parquet copy in the run directory (not a cache, which a
    lost executor would take with it); each table then reads only its own columns of it.
    """
    spark = landing.sparkSession
    parsed_dir = f"{run_dir}/parsed"
    parsed = flatten.parse_cards(landing)
    parsed.write.mode("overwrite").parquet(parsed_dir)
    written = spark.read.schema(parsed.schema).parquet(parsed_dir)
    staged = {}
    for spec, rows in streams:
        staged[spec.name] = f"{run_dir}/{spec.name}"
        aside = f"{quarantine}/{spec.name}" if quarantine else None
        stage(rows(written), spec, staged[spec.name], aside)
    remove(spark, parsed_dir)
    return staged


def read_staged(spark: SparkSession, spec: TableSpec, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(spec.struct()).parquet(*paths)
