"""Tables as numbered versions of a list of immutable folders.

A version is one small file that names the folders of every month and the keys of the loads that are
stored.  It is written aside and renamed to its number, which fails if another writer took that number;
the change is then made again on the version found.  So rows and the record that they are stored become
visible at once, a reader keeps the version it began with, and what a compaction did not read it cannot
lose.  Nothing is ever moved or overwritten; ``vacuum`` removes what no kept version names.

The driver reads and writes version files only; their size follows months, folders and loads, not rows.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from sightlog.sources import staged
from sightlog.sources.warehouse import Warehouse, laid_out
from sightlog.specs import TableSpec

logger = logging.getLogger(__name__)

_MONTH = "part_month"
_DIGITS = 12


class ConflictError(RuntimeError):
    """Folders that a change replaces were replaced by another one meanwhile."""


@dataclass(frozen=True, order=True)
class Part:
    """An immutable folder with rows of one month, relative to the table."""

    month: str
    path: str


@dataclass(frozen=True)
class Version:
    number: int
    parts: frozenset[Part] = frozenset()
    done: frozenset[str] = frozenset()

    def text(self) -> str:
        parts = [[p.month, p.path] for p in sorted(self.parts)]
        return json.dumps({"number": self.number, "parts": parts, "done": sorted(self.done)})

    @classmethod
    def parse(cls, text: str) -> Version:
        found = json.loads(text)
        return cls(found["number"], frozenset(Part(*p) for p in found["parts"]), frozenset(found["done"]))


class VersionLog:
    """The versions of one table under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _file(self, number: int) -> str:
        return f"{self.path}/versions/{number:0{_DIGITS}d}.json"

    def numbers(self) -> list[int]:
        folder = self._hadoop.Path(f"{self.path}/versions")
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n[:_DIGITS]) for n in names if n.endswith(".json") and n[:_DIGITS].isdigit())

    def read(self, number: int | None = None) -> Version:
        """A version, the latest without ``number``; a table without any is empty."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return Version(0)
            number = numbers[-1]
        path = self._hadoop.Path(self._file(number))
        fs = path.getFileSystem(self._conf)
        stream = fs.open(path)
        try:
            return Version.parse(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, version: Version) -> bool:
        """Puts a version in place; False if its number is taken."""
        aside = self._hadoop.Path(f"{self.path}/versions/.{uuid.uuid4().hex}")
        fs = aside.getFileSystem(self._conf)
        stream = fs.create(aside, False)
        stream.write(version.text().encode())
        stream.close()
        target = self._hadoop.Path(self._file(version.number))
        option = getattr(self._hadoop, "Options$Rename")
        context = self._hadoop.FileContext.getFileContext(fs.getUri(), self._conf)
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(target), self.spark._sc._gateway.new_array(option, 0))
        except Py4JJavaError as e:
            fs.delete(aside, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def commit(self, change: Callable[[Version], Version | None]) -> Version:
        """Makes ``change`` on the latest version and publishes it; None leaves things as they are.

        ``change`` may be called again on a later version, so it must not do anything itself.
        """
        while True:
            before = self.read()
            after = change(before)
            if after is None:
                return before
            after = replace(after, number=before.number + 1)
            if self._publish(after):
                return after
            logger.info("%s: version %d was taken, trying again", self.path, after.number)

    def write(self, df: DataFrame) -> frozenset[Part]:
        """Rows with a ``load_month`` as new folders that no version names yet."""
        folder = f"data/{uuid.uuid4().hex}"
        df.withColumn(_MONTH, F.col("load_month")).write.partitionBy(_MONTH).parquet(f"{self.path}/{folder}")
        names = staged.parts(self.spark, f"{self.path}/{folder}")
        return frozenset(Part(n.removeprefix(f"{_MONTH}="), f"{folder}/{n}") for n in names if n.startswith(f"{_MONTH}="))

    def frame(self, parts: Iterable[Part], schema) -> DataFrame:
        paths = [f"{self.path}/{p.path}" for p in sorted(parts)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def vacuum(self, keep: int = 10) -> int:
        """Removes all versions but the last ``keep``, and folders none of those names; returns how many.

        For times without loads: a folder that is written but not yet published counts as left over.
        """
        numbers = self.numbers()
        kept = numbers[-keep:]
        named = {p.path.rsplit("/", 1)[0] for n in kept for p in self.read(n).parts}
        for n in numbers[:-keep]:
            staged.remove(self.spark, self._file(n))
        gone = 0
        if staged.exists(self.spark, f"{self.path}/data"):
            for name in staged.parts(self.spark, f"{self.path}/data"):
                if f"data/{name}" not in named:
                    staged.remove(self.spark, f"{self.path}/data/{name}")
                    gone += 1
        return gone


class VersionedWarehouse(Warehouse):
    """The table operations of a warehouse over version logs below ``location``.

    Loads with a key are stored once, however often they are tried; compaction runs beside loads and
    readers.
    """

    def __init__(self, spark: SparkSession, location: str):
        super().__init__(spark, location)

    def log(self, spec: TableSpec) -> VersionLog:
        return VersionLog(self.spark, f"{self.location}/{spec.schema}/{spec.name}")

    def deploy(self, specs: Sequence[TableSpec]) -> None:
        """Nothing to create: a table begins with its first version."""

    def drop(self, spec: TableSpec, if_exists: bool = True) -> None:
        staged.remove(self.spark, self.log(spec).path)

    def read(
        self, spec: TableSpec, since: date | None = None, until: date | None = None, version: int | None = None
    ) -> DataFrame:
        """Rows of the latest version, or of ``version``; only folders of the months asked for are named.

        The frame keeps its version: later appends and compactions do not change it.
        """
        log = self.log(spec)
        first = "" if since is None else since.replace(day=1).isoformat()
        last = "~" if until is None else until.isoformat()
        df = log.frame([p for p in log.read(version).parts if first <= p.month <= last], spec.stored_struct())
        day = F.to_date("last_update")
        if since is not None:
            df = df.where(day >= F.lit(since))
        if until is not None:
            df = df.where(day <= F.lit(until))
        return df

    def is_done(self, spec: TableSpec, key: str) -> bool:
        return key in self.log(spec).read().done

    def done_below(self, spec: TableSpec, key: str) -> set[str]:
        return {k for k in self.log(spec).read().done if k.startswith(f"{key}/")}

    def append(self, spec: TableSpec, df: DataFrame, key: str | None = None) -> None:
        """Append rows, and with them the record that ``key`` is stored; nothing if it is already."""
        log = self.log(spec)
        if key is not None and key in log.read().done:
            return
        columns = spec.stored_struct().names
        sort_keys = [F.expr(k) for k in spec.key]
        rows = df.select(*columns).hint("rebalance", "load_month").sortWithinPartitions("load_month", *sort_keys)
        new = log.write(rows)

        def change(now: Version) -> Version | None:
            if key is not None and key in now.done:
                return None  # another try of the load was faster
            return replace(now, parts=now.parts | new, done=now.done | ({key} if key is not None else set()))

        log.commit(change)

    def finish(self, spec: TableSpec, key: str) -> None:
        """One record of a whole load in place of those of its portions."""

        def change(now: Version) -> Version | None:
            below = {k for k in now.done if k.startswith(f"{key}/")}
            return None if key in now.done and not below else replace(now, done=now.done - below | {key})

        self.log(spec).commit(change)

    def compact(
        self, spec: TableSpec, months: Sequence[date] | None = None, cluster_by: Sequence[str] = (),
        before_switch: Callable[[], None] | None = None,
    ) -> None:
        """Months rewritten with one row per key into new folders, in place of those that were read.

        Folders appended meanwhile stay beside the new ones; if another compaction replaced one of those
        read, nothing changes and ConflictError is raised.  ``before_switch`` is called when the new
        folders are written.
        """
        if not spec.keep_states:
            return
        log = self.log(spec)
        wanted = None if months is None else {m.isoformat() for m in months}
        old = frozenset(p for p in log.read().parts if wanted is None or p.month in wanted)
        if not old:
            return
        df = log.frame(old, spec.stored_struct())
        new = log.write(laid_out(df, spec, cluster_by).select(*df.columns))
        if before_switch is not None:
            before_switch()

        def change(now: Version) -> Version:
            if not old <= now.parts:
                raise ConflictError(f"{spec.full_name}: months were compacted by another run")
            return replace(now, parts=now.parts - old | new)

        log.commit(change)

    def vacuum(self, spec: TableSpec, keep: int = 10) -> int:
        return self.log(spec).vacuum(keep)

    def create_views(self, specs: Sequence[TableSpec], schema: str | None = "staging") -> None:
        raise NotImplementedError("views of versioned tables are those of a session: see plans.staging")

    def add_column(self, spec: TableSpec, name: str) -> None:
        raise NotImplementedError("declare the column: folders without it read as null")
