"""Ranked lexical search: exact top documents for a table of query items.

The index is partitioned by term.  Terms of the items are dealt to owners, rarest first, so that early
owners hold few postings; an owner's postings lie in shards of documents, as a common term's list would
fill any one task.  The items of a block travel as one bundle: for each shard it carries a sparse
accumulator (item, document, score so far) through the owners one after another.  At each stage a
cogroup brings a shard's accumulator and its postings of that owner together, integer contributions are
added, and the result is stored.  After the last stage the best documents of each item are selected.

What cannot win any more is left behind, exactly: between stages the best partial scores over all shards
give each item a score that its last winner reaches at least, and a document whose score so far plus all
that later owners could add lies below it goes.  Where the rest cannot lift a new document to that score,
only documents already carried are looked up.

Contributions are computed once, when postings are dealt to owners, from counts over all documents.
Items come in blocks of bounded size, each with a scan of the documents; the terms of one block are what
the driver and each task hold.

Defined results: a null text, or one without terms, is no document (it counts nowhere) or an item without
rows.  Among equal scores ids ascend, null last; rows that share an id are separate documents in the order
of the stored index.  Rows of the items are separate even where they repeat; each gets its own ranks.
Only scores above 0 count.  Empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sightlog.llm.common import folded_words, scratch_folder, slices, stored

TOP = 50
#: Share of all postings of a block's terms that lie with the owners up to each one.
OWNERS = (0.01, 0.1, 0.4, 1.0)
#: Bytes of item text a block has, about.
BLOCK_BYTES = 16_000_000

_INDEX = (
    "shard bigint, doc_ids array<bigint>, lengths array<bigint>, n_docs bigint, n_terms bigint, "
    "terms array<int>, counts array<int>, docs array<int>, tfs array<int>"
)
_DEALT = (
    "owner int, shard bigint, doc_ids array<bigint>, terms array<int>, counts array<int>, docs array<int>, "
    "adds array<bigint>, tops array<bigint>"
)
_CARRIED = "shard bigint, item int, doc int, doc_id bigint, score bigint"


def _lists(values: np.ndarray, ends: list[int], kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(values, kind))


def index(docs: DataFrame, place: dict[bytes, int]) -> DataFrame:
    """Postings of the terms in ``place``, a row for each shard: a stretch of documents of one task.

    A shard also has the ids and lengths of its documents, and their count and length in all.
    """
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in slices(batch, "text"):
                split = [folded_words(t) for t in texts]
                n = np.fromiter(map(len, split), np.int64, len(split))
                number = np.fromiter(map(place.get, chain.from_iterable(split), repeat(-1)), np.int64, int(n.sum()))
                doc = np.repeat(np.arange(len(n)), n)
                # by term, then by document
                keys, tfs = np.unique((number * len(n) + doc)[number >= 0], return_counts=True)
                terms, counts = np.unique(keys // len(n), return_counts=True)
                arrays = [
                    pa.array([shard], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), part.column("doc_id")),
                    _lists(n, [len(n)], pa.int64()),
                    pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                    _lists(terms, [len(terms)], pa.int32()), _lists(counts, [len(terms)], pa.int32()),
                    _lists(keys % len(n), [len(keys)], pa.int32()), _lists(tfs, [len(keys)], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _INDEX.split(", ")])
                shard += 1

    return docs.mapInArrow(run, _INDEX)


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def owners(df: np.ndarray, shares: tuple[float, ...] = OWNERS) -> np.ndarray:
    """Owner of each term: the rarest first, the common ones with the last."""
    order = np.argsort(df, kind="stable")
    upto = np.cumsum(df[order])
    owner = np.empty(len(df), np.int64)
    owner[order] = np.searchsorted(np.array(shares[:-1]) * max(int(upto[-1]), 1), upto, side="left")
    return owner


def dealt(shards: DataFrame, weight: np.ndarray, owner: np.ndarray, n_owners: int, n_docs: int, n_terms: int) -> DataFrame:
    """Postings of each owner in each shard, with the contribution in place of the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                def values(name: str) -> np.ndarray:
                    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)

                terms, counts, docs, tfs = values("terms"), values("counts"), values("docs"), values("tfs").astype(np.int64)
                m = 50 + (50 * values("lengths").astype(np.int64) * n_docs) // max(n_terms, 1)
                adds = np.repeat(weight[terms], counts) * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[docs]))
                starts = np.cumsum(counts) - counts
                tops = np.maximum.reduceat(adds, starts) if len(adds) else adds
                by_term, by_posting = owner[terms], np.repeat(owner[terms], counts)
                ids = batch.column("doc_ids")[row].values
                for o in range(n_owners):
                    mine, posted = by_term == o, by_posting == o
                    n, p = int(mine.sum()), int(posted.sum())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([o], pa.int32()), batch.column("shard").slice(row, 1),
                            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                            _lists(terms[mine], [n], pa.int32()), _lists(counts[mine], [n], pa.int32()),
                            _lists(docs[posted], [p], pa.int32()), _lists(adds[posted], [p], pa.int64()),
                            _lists(tops[mine], [n], pa.int64()),
                        ],
                        names=[c.split()[0] for c in _DEALT.split(", ")],
                    )

    return shards.mapInArrow(run, _DEALT)


def stage(
    carried: DataFrame, postings: DataFrame, here: list[np.ndarray], later: np.ndarray, least: np.ndarray, top: int
) -> DataFrame:
    """Accumulators after one owner.

    ``here`` are each item's terms with this owner, ``later`` the most that later owners can add, and
    ``least`` a score that the item's last winner has for certain.
    """
    spark = postings.sparkSession
    shared = spark.sparkContext.broadcast((here, later, least))

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        here, later, least = shared.value
        out: list[tuple] = []
        if not right.num_rows:
            return pa.table({c: [] for c in ("shard", "item", "doc", "doc_id", "score")}, schema=schema)
        row = right.slice(0, 1).combine_chunks()

        def values(name: str) -> np.ndarray:
            return row.column(name)[0].values.to_numpy(zero_copy_only=False)

        terms, counts, docs, adds, tops = (values(c) for c in ("terms", "counts", "docs", "adds", "tops"))
        ids = row.column("doc_ids")[0].values
        starts = np.cumsum(counts) - counts
        came = [left.column(c).to_numpy() for c in ("item", "doc", "score")]
        order = np.argsort(came[0], kind="stable")
        came = [c[order] for c in came]
        begin = np.searchsorted(came[0], np.arange(len(here) + 1))
        for item, wanted in enumerate(here):
            known = slice(begin[item], begin[item + 1])
            at = np.searchsorted(terms, wanted)
            at = at[np.isin(wanted, terms)]
            if not len(at) and begin[item] == begin[item + 1]:
                continue
            score = np.zeros(len(ids), np.int64)
            score[came[1][known]] = came[2][known]
            before = score > 0
            for t in at:
                mine = slice(starts[t], starts[t] + counts[t])
                score[docs[mine]] += adds[mine]
            new_worth = tops[at].sum() + later[item] >= least[item]
            kept = np.flatnonzero(score if new_worth else score * before)
            bound = least[item]
            if len(kept) > top:  # the best of the shard alone also bound what can win
                bound = max(bound, np.partition(score[kept], -top)[-top])
            kept = kept[score[kept] + later[item] >= bound]
            if len(kept):
                out.append((np.full(len(kept), item, np.int32), kept.astype(np.int32), score[kept]))
        item, doc, score = (np.concatenate([np.zeros(0, k), *[o[i] for o in out]]) for i, k in enumerate((np.int32, np.int32, np.int64)))
        shard = np.full(len(item), row.column("shard")[0].as_py(), np.int64)
        return pa.table([pa.array(shard), pa.array(item), pa.array(doc), ids.take(pa.array(doc)), pa.array(score)], schema=schema)

    schema = pa.schema([("shard", pa.int64()), ("item", pa.int32()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])
    return carried.groupBy("shard").cogroup(postings.groupBy("shard")).applyInArrow(add, _CARRIED)


def _best(carried: DataFrame, top: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "shard", "doc"]
    return carried.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)


def _block(docs: DataFrame, rows: list, top: int, shares: tuple[float, ...], folder: str) -> DataFrame | None:
    """(item, rank, doc_id, score) for the items of a block, numbered as in ``rows``."""
    spark = docs.sparkSession
    split = [folded_words(bytes(r["text"]) if r["text"] is not None else None) for r in rows]
    place = {t: i for i, t in enumerate(sorted(set(chain.from_iterable(split))))}
    items = [np.array(sorted({place[t] for t in s}), np.int64) for s in split]
    shards = stored(index(docs, place), folder, "index")
    total = shards.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = total["n"] or 0, total["l"] or 0
    if not n_docs or not place:
        return None
    each = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("e"))
    df = np.zeros(len(place), np.int64)
    for r in each.groupBy("e.terms").agg(F.sum("e.counts").alias("df")).collect():  # a number for each term of the block
        df[r["terms"]] = r["df"]
    weight, owner = term_weights(df, n_docs), owners(df, shares)
    spread = dealt(shards, weight, owner, len(shares), n_docs, n_terms)
    spread.write.partitionBy("owner").option("compression", "zstd").parquet(f"{folder}/owners")
    postings = spark.read.schema(_DEALT).parquet(f"{folder}/owners")
    most = np.zeros(len(place), np.int64)
    tops = postings.select(F.explode(F.arrays_zip("terms", "tops")).alias("e")).groupBy("e.terms").agg(F.max("e.tops").alias("top"))
    for r in tops.collect():
        most[r["terms"]] = r["top"]
    carried = spark.createDataFrame([], _CARRIED)
    least = np.ones(len(items), np.int64)
    for o in range(len(shares)):
        here = [i[owner[i] == o] for i in items]
        later = np.array([most[i[owner[i] > o]].sum() for i in items], np.int64)
        mine = postings.where(F.col("owner") == o).drop("owner")
        carried = stored(stage(carried, mine, here, later, least, top), folder, f"carried-{o}")
        if o + 1 < len(shares):
            full = _best(carried, top).where(F.col("rank") == top)  # a row for each item at most
            for r in full.select("item", "score").collect():
                least[r["item"]] = max(least[r["item"]], r["score"])
    return _best(carried, top).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, shares: tuple[float, ...] = OWNERS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item.

    ``docs`` has doc_id and text, ``items`` item_id and text.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    asked = items.select("item_id", F.col("text").cast("binary").alias("text")).withColumn("row", F.monotonically_increasing_id())
    asked = stored(asked, folder, "items")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // block_bytes + 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    found = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for b in range(blocks):
        rows = asked.where(F.col("block") == b).orderBy("row").select("row", "text").collect()  # about block_bytes
        best = _block(docs, rows, top, shares, f"{folder}/block-{b}")
        if best is not None:
            numbers = spark.createDataFrame([(i, r["row"]) for i, r in enumerate(rows)], "item int, row bigint")
            named = best.join(numbers, "item").join(asked.select("row", "item_id"), "row")
            found = found.unionByName(stored(named.select("item_id", "rank", "doc_id", "score"), f"{folder}/block-{b}", "best"))
    return found
