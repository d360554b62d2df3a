"""Importance resampling of documents towards a target text, by hashed word and pair features.

Features are the words of a text and its pairs of neighbouring words; each falls in a bucket by its
CRC-32.  A bucket's gain is the log ratio of its share in the target to its share in the corpus, a
document's weight the mean gain of its features, and the documents with the highest weights plus
Gumbel noise, fixed by their id, are drawn without replacement.

Most features are a few words and pairs.  One pass over all documents finds these frequent ones
(counters of fixed size in each task, merged by a shuffle); broadcast are the CRC state of each
frequent word, also after the space that follows it in a pair, and the bucket of each frequent pair.
Every other feature takes its CRC directly, a pair's going on from the state of its first word.  The
head only saves work: buckets, totals and weights are exact whatever it holds.  The bucket numbers of
each document are stored, so that totals and weights read them instead of hashing texts again.

Defined results: a null text, or one without words, has no features and weight 0; it is scored like
any other and, having fewer than ``min_words`` words, never drawn.  A null doc_id is hashed as an empty
text and ordered after all ids.  Rows are judged one by one, so repeated rows are drawn separately, in
an order among equals that is fixed by the stored table.  Extra columns are ignored.  Empty documents
give no rows; an empty target lowers the gain of buckets that the corpus fills.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sightlog.llm.common import folded_words, most_frequent, scratch_folder, slices, stored

BUCKETS = 10_000
SEED = 7
#: Percentage of the long enough documents that is drawn, and what is long enough.
DRAWN = 25
MIN_WORDS = 20

#: Most words and pairs that are broadcast, and the longest word among them in bytes: 6 MB in all.
HEAD_WORDS = 1 << 14
HEAD_PAIRS = 1 << 16
HEAD_BYTES = 64
#: Characters counted at a time before a task's counters are cut back.
TALLY_CHARS = 1_000_000


def _cut_back(counts: Counter, size: int) -> Counter:
    """Counters of at most ``size`` keys: the count of the largest key left out is taken off all.

    A key loses at most a share 1 / size of everything counted, so frequent ones are never lost.
    """
    if len(counts) <= size:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    floor = int(np.partition(values, -size - 1)[-size - 1])
    return Counter({k: n - floor for k, n in counts.items() if n > floor})


def frequent(docs: DataFrame, folder: str, n_words: int = HEAD_WORDS, n_pairs: int = HEAD_PAIRS) -> tuple[list[bytes], list[tuple]]:
    """The most frequent words and pairs of words of all documents, each at most so many."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Counter(), Counter()
        for batch in batches:
            for _, texts in slices(batch, "text", TALLY_CHARS):
                for text in texts:
                    found = folded_words(text)
                    words.update(found)
                    pairs.update(zip(found, found[1:]))
                if len(words) > 8 * n_words:
                    words = _cut_back(words, 2 * n_words)
                if len(pairs) > 4 * n_pairs:
                    pairs = _cut_back(pairs, n_pairs)
        rows = [(w, None, n) for w, n in _cut_back(words, 2 * n_words).items() if len(w) <= HEAD_BYTES]
        rows += [(a, b, n) for (a, b), n in _cut_back(pairs, n_pairs).items() if max(len(a), len(b)) <= HEAD_BYTES]
        if rows:
            first, second, count = zip(*rows)
            arrays = [pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(count, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["first", "second", "n"])

    parts = docs.mapInArrow(tally, "first binary, second binary, n bigint")
    counted = stored(parts.groupBy("first", "second").agg(F.sum("n").alias("n")), folder, "tally")
    alone = F.col("second").isNull()
    tops = most_frequent(counted.where(alone), "n", n_words).unionByName(most_frequent(counted.where(~alone), "n", n_pairs))
    rows = tops.select("first", "second").collect()  # both limits are parameters
    return [bytes(r[0]) for r in rows if r[1] is None], [(bytes(a), bytes(b)) for a, b in rows if b is not None]


def head_of(words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> dict:
    """CRC states of frequent words and buckets of frequent pairs, as plain arrays for the tasks."""
    place = {w: i for i, w in enumerate(words)}
    known = sorted((place[a] << 32 | place[b], a + b" " + b) for a, b in pairs if a in place and b in place)
    return {
        "place": place,
        "state": np.array([zlib.crc32(w) for w in words], np.int64),
        "spaced": np.array([zlib.crc32(w + b" ") for w in words], np.int64),
        "pair": np.array([k for k, _ in known], np.int64),
        "pair_bucket": np.array([zlib.crc32(f) % buckets for _, f in known], np.int64),
    }


def bucket_numbers(head: dict, buckets: int, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, text by text, and the number of features of each text."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = list(chain.from_iterable(texts))
    place = np.fromiter(map(head["place"].get, flat, repeat(-1)), np.int64, len(flat))
    in_head = place >= 0
    state, spaced = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    state[in_head], spaced[in_head] = head["state"][place[in_head]], head["spaced"][place[in_head]]
    tail = np.flatnonzero(~in_head)
    direct = [zlib.crc32(flat[i]) for i in tail.tolist()]
    state[tail] = direct
    spaced[tail] = [zlib.crc32(b" ", s) for s in direct]

    known = head["pair"]
    ends = np.zeros(len(flat), bool)
    ends[np.cumsum(n)[n > 0] - 1] = True
    left = np.flatnonzero(~ends)
    key = np.where(in_head[left] & in_head[left + 1], place[left] << 32 | place[left + 1], -1)
    at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
    met = known[at] == key if len(known) else np.zeros(len(left), bool)
    pair = np.empty(len(left), np.int64)
    pair[met] = head["pair_bucket"][at[met]]
    rest = np.flatnonzero(~met)
    pair[rest] = [
        zlib.crc32(flat[i + 1], s) % buckets for i, s in zip(left[rest].tolist(), spaced[left[rest]].tolist())
    ]

    size = np.maximum(2 * n - 1, 0)
    starts = np.cumsum(size) - size - 2 * (np.cumsum(n) - n)
    to = np.repeat(starts, n) + 2 * np.arange(len(flat))
    out = np.empty(int(size.sum()), np.uint16)
    out[to] = state % buckets
    out[to[left] + 1] = pair
    return out, size


def hashed(docs: DataFrame, head: dict, buckets: int, keep: tuple[str, ...]) -> DataFrame:
    """(keep..., n_words, n_features, buckets): the bucket numbers of each text, two bytes each."""
    kept = docs.select(*keep).schema
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        for batch in batches:
            for part, texts in slices(batch, "text"):
                split = [folded_words(t) for t in texts]
                numbers, size = bucket_numbers(head, buckets, split)
                ends = np.zeros(len(size) + 1, np.int32)
                np.cumsum(2 * size, out=ends[1:])
                blobs = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(numbers)])
                n_words = pa.array(np.fromiter(map(len, split), np.int64, len(split)))
                arrays = [part.column(c) for c in keep] + [n_words, pa.array(size), blobs]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_words", "n_features", "buckets"])

    return docs.mapInArrow(run, f"{fields}n_words bigint, n_features bigint, buckets binary")


def _numbers(column: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint16), *[np.frombuffer(b, np.uint16) for b in column.to_pylist()]])


def totals(features: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n): how many features of all texts fall in each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            n += np.bincount(_numbers(batch.column("buckets")), minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["bucket", "n"])

    parts = features.select("buckets").mapInArrow(count, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket, from the totals of both sides: one number a bucket comes to the driver."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("double")
    both = every.join(corpus.select("bucket", "n"), "bucket", "left").select("bucket", n.alias("s"))
    both = both.join(target.select("bucket", "n"), "bucket", "left").select("bucket", "s", n.alias("t"))
    sums = both.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    ratio = (F.col("t") + 1) * F.lit(sums["S"] + buckets) / ((F.col("s") + 1) * F.lit(sums["T"] + buckets))
    rows = both.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    out[[r["bucket"] for r in rows]] = [r["gain"] for r in rows]
    return out


def weighted(features: DataFrame, gain: np.ndarray, keep: tuple[str, ...]) -> DataFrame:
    """(keep..., weight): floored mean gain of each document's features, 0 without any."""
    fields = ", ".join(f"`{c}` {features.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("n_features").to_numpy()
            upto = np.concatenate([[0], np.cumsum(gain[_numbers(batch.column("buckets"))])])
            ends = np.cumsum(size)
            weight = np.where(size > 0, (upto[ends] - upto[ends - size]) // np.maximum(size, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(weight)], names=[*keep, "weight"])

    return features.mapInArrow(run, f"{fields}, weight bigint")


def gumbel(key: Column, seed: int) -> Column:
    """Noise of a row, in thousandths, fixed by its key and the seed."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def placed(df: DataFrame, order: list[Column], folder: str) -> DataFrame:
    """``df`` with ``place``, the 0-based position of each row in ``order``, which must tell rows apart.

    Rows are sorted by ranges and written; places are counted within a range and moved on by the
    sizes of the ranges before it, so only one number a range meets in one task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    written = stored(ranged, folder, "ranged").withColumn("__range", F.shiftright("__at", 33))
    sizes = written.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, 0))
    starts = sizes.select("__range", (upto - F.col("n")).alias("__start"))
    place = F.col("__start") + F.col("__at").bitwiseAND((1 << 33) - 1)
    return written.join(starts, "__range").select(*df.columns, place.alias("place"))


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, drawn: int = DRAWN, min_words: int = MIN_WORDS,
    seed: int = SEED, head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): ``drawn`` % of the long enough documents have a rank.

    ``docs`` has doc_id and text, ``target`` a text; ``buckets`` is at most 65,536.
    """
    folder = scratch_folder(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    head = head_of(*frequent(docs.select("text"), folder, head_words, head_pairs), buckets)
    hashes = hashed(docs, head, buckets, ("doc_id",)).withColumn("row", F.monotonically_increasing_id())
    features = stored(hashes, folder, "features")
    wanted = hashed(target.select(F.col("text").cast("binary").alias("text")), head, buckets, ())
    gain = gains(totals(features, buckets), totals(wanted, buckets), buckets)
    weights = weighted(features, gain, ("row", "doc_id", "n_words", "n_features"))
    scored = weights.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    long_enough = F.col("n_words") >= min_words
    order = [long_enough.desc(), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = placed(scored, order, folder)
    n_long = features.agg(F.count_if(long_enough).alias("n")).select(F.expr(f"({drawn} * n) div 100")).scalar()
    rank = F.when(long_enough & (F.col("place") < n_long), F.col("place") + 1)
    return ranked.select("doc_id", "n_features", "weight", "score", rank.cast("bigint").alias("rank"))
