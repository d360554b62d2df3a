"""Helpers the operators share: stored tables in the shared folder, Arrow batches, words."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Characters that separate words, as a Java and Python character class.
BLANKS = r"[\x20\x09-\x0D]"
NOT_BLANKS = r"[^\x20\x09-\x0D]+"

#: A-Z to a-z on UTF-8 bytes; other letters stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Letters, digits and all bytes from 0x80 on with A-Z lowered, every other byte a space.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: Items walked at a time where a walk gathers an array.
WALK = 256

#: Characters of text handled at a time inside a task.
SLICE_CHARS = 4_000_000


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach, removed when the session's JVM ends.

    It lies under spark.checkpoint.dir, or under the warehouse where that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    folder = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The frame written as a table and read back: cuts lineage, and sizes become known."""
    df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def most_frequent(counts: DataFrame, count: str, limit: int) -> DataFrame:
    """Rows of the largest counts above 0, as many as whole counts allow within ``limit``.

    The smallest count that fits comes from how many rows there are of each count, so no task and
    not the driver sees more rows than there are different counts.
    """
    n = F.col(count)
    rows = counts.where(n > 0).groupBy(n.alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0))
    least = rows.withColumn("upto", upto).where(F.col("upto") <= limit).agg(F.min("n")).scalar()
    return counts.where(n >= least)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of maximal runs without blanks."""
    parts = F.split(text, BLANKS + "+", -1)
    ends = (F.element_at(parts, 1) == "").cast("int") + (F.element_at(parts, -1) == "").cast("int")
    return F.when(text == "", 0).otherwise(F.size(parts) - ends).cast("bigint")


def folded_words(text: bytes | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, with A-Z lowered."""
    return text.translate(FOLDED).split() if text else []


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where ``use`` refers to it in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def walked(items: Column, carry: Column, kind: str, step: Callable, context: Callable | None = None) -> Column:
    """(carry, out) of a walk over an array, where ``out`` is an array of type ``kind``.

    ``step(carry, item, context)`` gives the next carry, an array element and whether it is put out.
    Appending copies an array, so items are walked in blocks of WALK, each with an array of its own.
    ``context(carry, block)`` is computed once for each block.
    """
    none = F.array().cast(kind)

    def of_blocks(whole: Column) -> Column:
        last = F.greatest(F.ceil(F.size(whole) / F.lit(WALK)) - 1, F.lit(0)).cast("int")

        def block(acc: Column, b: Column) -> Column:
            def walk(part: Column, known: Column | None) -> Column:
                def add(a: Column, item: Column) -> Column:
                    now, element, wanted = step(a["carry"], item, known)
                    out = F.when(wanted, F.concat(a["out"], F.array(element))).otherwise(a["out"])
                    return F.struct(now.alias("carry"), out.alias("out"))

                return F.aggregate(part, F.struct(acc["carry"].alias("carry"), none.alias("out")), add)

            part = F.slice(whole, b * WALK + 1, F.lit(WALK))
            if context is None:
                done = walk(part, None)
            else:
                done = bound(part, lambda p: bound(context(acc["carry"], p), lambda known: walk(p, known)))
            return bound(
                done, lambda d: F.struct(d["carry"].alias("carry"), F.concat(acc["outs"], F.array(d["out"])).alias("outs"))
            )

        zero = F.struct(carry.alias("carry"), F.array().cast(f"array<{kind}>").alias("outs"))
        return F.aggregate(
            F.sequence(F.lit(0), last), zero, block,
            lambda acc: F.struct(acc["carry"].alias("carry"), F.flatten(acc["outs"]).alias("out")),
        )

    return bound(items, of_blocks)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of a batch with about ``limit`` characters each, one row at least, with their texts."""
    texts = batch.column(column).to_pylist()
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > limit:
            yield batch.slice(begin, i - begin), texts[begin:i]
            begin, size = i, 0
        size += len(text or "")
    if begin < len(texts):
        yield batch.slice(begin), texts[begin:]


def with_columns(
    df: DataFrame, text: str, fields: str, compute: Callable[[list], list[pa.Array]]
) -> DataFrame:
    """Adds columns computed from lists of texts; the other columns pass through unchanged.

    ``fields`` is a DDL list of the new columns, and ``compute`` gives one array for each.
    """
    from pyspark.sql.types import StructType

    schema = StructType(df.schema.fields + StructType.fromDDL(fields).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text):
                yield pa.RecordBatch.from_arrays(part.columns + compute(texts), names=schema.names)

    return df.mapInArrow(run, schema)


def packed(df: DataFrame, key: str, held_bytes: int = 64_000_000) -> DataFrame:
    """(key, blob): the rows a task has for each value of an integer ``key``, compressed together.

    For columns that would fill a shuffle as they are; ``unpacked`` gives the rows back.
    """
    names = [c for c in df.columns if c != key]

    def blob(rows: pa.Table) -> bytes:
        out, option = pa.BufferOutputStream(), pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(out, rows.schema, options=option) as writer:
            writer.write_table(rows)
        return out.getvalue().to_pybytes()

    def sent(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        groups = np.split(order, cuts)
        rows = table.select(names)
        blobs = [blob(rows.take(pa.array(g)).combine_chunks()) for g in groups]
        return pa.RecordBatch.from_arrays(
            [pa.array([int(keys[g[0]]) for g in groups], pa.int32()), pa.array(blobs, pa.binary())], names=[key, "blob"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.nbytes for b in held) >= held_bytes:
                yield sent(held)
                held = []
        if held:
            yield sent(held)

    return df.mapInArrow(run, f"`{key}` int, blob binary")


def unpacked(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows of the blobs of ``packed``."""
    for blob in table.column("blob"):
        yield from pa.ipc.open_stream(blob.as_buffer())
