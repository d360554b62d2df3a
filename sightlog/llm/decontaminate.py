"""Benchmark decontamination with an FM-index per shard of training text.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item is one window).  The
words of a shard become numbers; words outside the benchmark's vocabulary separate, as no window
can reach across them, and stretches too short for any window are left out.  Over the rest a
Burrows-Wheeler transform is kept as a wavelet matrix.  All windows are searched backwards at
once, occurrences are located by walking to sampled suffix positions, and covered words are
merged into spans.

Stretches are cut into overlapping pieces of PIECE words, so that sorting suffixes never takes
more than log2(PIECE) doublings, also where long texts repeat.

The benchmark is read in blocks of bounded size; texts pass through one step per block, without
any shuffle.

Defined results: null or empty text has no words; an item without words is no window; repeated
rows are each judged; items that share a window are all named; null item ids are left out of the
names, but their windows hit.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from sightlog.llm.common import slices

WINDOW = 10
PIECE = 64
SAMPLED = 8
#: Characters of benchmark text searched for at a time.
BLOCK_CHARS = 32_000_000

#: Letters A-Z to a-z; digits, a-z and bytes of other characters stay; the rest are blanks.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(rb"[^ ]+")

HITS = "struct<n_words:bigint,spans:array<struct<start:int,end:int>>,items:array<string>>"


def word_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@dataclass
class Phrases:
    """Windows of a block of items: by length, a matrix of word numbers (from 1) and item lists."""

    words: dict[bytes, int]
    windows: list[tuple[int, np.ndarray, list[list[str]]]]

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]]) -> "Phrases":
        words: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = {}
        for item, text in items:
            ids = [words.setdefault(w, len(words) + 1) for w in word_bytes(text).split()]
            for i in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                found.setdefault(tuple(ids[i : i + WINDOW]), set()).add(item)
        by_length: dict[int, list] = {}
        for window, owners in sorted(found.items()):
            by_length.setdefault(len(window), []).append((window, sorted(x for x in owners if x is not None)))
        return cls(
            words,
            [(n, np.array([w for w, _ in rows], np.int64), [o for _, o in rows]) for n, rows in sorted(by_length.items())],
        )


class FMIndex:
    """Full-text index of a sequence of numbers; 0 separates, and the sequence ends with it."""

    def __init__(self, text: np.ndarray, alphabet: int):
        n = len(text)
        breaks = text == 0
        rank = np.where(breaks, np.cumsum(breaks) - 1, text + int(breaks.sum()))
        order, width = np.argsort(rank, kind="stable"), 1
        while True:
            beyond = np.zeros(n, np.int64)
            beyond[:-width] = rank[width:] + 1
            key = rank * (int(rank.max()) + 2) + beyond
            order = np.argsort(key, kind="stable")
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, np.diff(key[order]) > 0])
            width *= 2
            if rank[order[-1]] == n - 1 or width >= n:
                break
        last = text[order - 1]
        self.first = np.searchsorted(np.sort(text), np.arange(alphabet + 2))
        kept = (order % SAMPLED == 0) | (last == 0)  # a walk never crosses a separator
        self.is_sample, self.sample_rank = kept, np.cumsum(np.r_[0, kept])
        self.samples = order[kept]
        self.levels: list[tuple[int, np.ndarray, int]] = []  # bit, ones before each place, zeros
        rest = last
        for bit in reversed(range(max(1, int(alphabet).bit_length()))):
            ones = (rest >> bit) & 1
            self.levels.append((bit, np.r_[0, np.cumsum(ones)], int(n - ones.sum())))
            rest = np.concatenate([rest[ones == 0], rest[ones == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place of the transform."""
        begin = np.zeros(len(symbol), np.int64)
        for bit, ones, zeros in self.levels:
            up = (symbol >> bit) & 1 == 1
            begin = np.where(up, zeros + ones[begin], begin - ones[begin])
            place = np.where(up, zeros + ones[place], place - ones[place])
        return place - begin

    def step(self, row: np.ndarray) -> np.ndarray:
        """The row whose suffix starts one symbol earlier."""
        symbol, begin, place = np.zeros_like(row), np.zeros_like(row), row
        for bit, ones, zeros in self.levels:
            up = ones[place + 1] > ones[place]
            symbol += up.astype(np.int64) << bit
            begin = np.where(up, zeros + ones[begin], begin - ones[begin])
            place = np.where(up, zeros + ones[place], place - ones[place])
        return self.first[symbol] + place - begin

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``windows``, place in the text) of every occurrence."""
        which = np.arange(len(windows))
        low, high = self.first[windows[:, -1]], self.first[windows[:, -1] + 1]
        for k in reversed(range(windows.shape[1] - 1)):
            left = low < high
            which, low, high = which[left], low[left], high[left]
            symbol = windows[which, k]
            low, high = self.first[symbol] + self.rank(symbol, low), self.first[symbol] + self.rank(symbol, high)
        size = np.maximum(high - low, 0)
        row, which = ranges(low, size), np.repeat(which, size)
        place, steps, todo = np.zeros(len(row), np.int64), 0, np.arange(len(row))
        while len(todo):
            done = self.is_sample[row[todo]]
            hit = todo[done]
            place[hit] = self.samples[self.sample_rank[row[hit]]] + steps
            todo, steps = todo[~done], steps + 1
            row[todo] = self.step(row[todo])
        return which, place


def stretches(ids: np.ndarray, least: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence to index, cut into pieces that end with a separator, and its places in ids."""
    inside = ids > 0
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= least
    begin, end = begin[long], end[long]
    stride = PIECE - overlap
    pieces = np.maximum(1, -(-(end - begin - overlap) // stride))
    nth = ranges(np.zeros(len(pieces), np.int64), pieces)
    start = np.repeat(begin, pieces) + nth * stride
    size = np.minimum(np.repeat(end, pieces) - start, PIECE)
    at = ranges(start, size + 1)
    text = ids[np.minimum(at, len(ids) - 1)].astype(np.int64)
    text[np.cumsum(size + 1) - 1] = 0
    return text, at


def find(phrases: Phrases, texts: list) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """For each text: number of words, merged spans of hit words, names of the items found."""
    get, ids, counts = phrases.words.get, array("i"), []
    for text in texts:
        words = word_bytes(text).split()
        counts.append(len(words))
        ids.extend(map(get, words, repeat(0)))
        ids.append(0)
    results: list[tuple[int, list[tuple[int, int]], set[str]]] = [(n, [], set()) for n in counts]
    if not phrases.windows:
        return results
    flat = np.frombuffer(ids, np.int32)
    text, at = stretches(flat, phrases.windows[0][0], phrases.windows[-1][0] - 1)
    if not len(text):
        return results
    starts = np.r_[0, np.cumsum(np.array(counts) + 1)]
    index = FMIndex(text, len(phrases.words))
    covered = np.zeros(len(flat) + 1, np.int64)
    for length, windows, owners in phrases.windows:
        which, place = index.search(windows)
        place = at[place]
        np.add.at(covered, place, 1)
        np.add.at(covered, place + length, -1)
        doc = np.searchsorted(starts, place, side="right") - 1
        for d, w in np.unique(np.stack([doc, which], axis=1), axis=0).tolist():
            results[d][2].update(owners[w])
    hit = np.cumsum(covered[:-1]) > 0
    edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
    for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
        d = int(np.searchsorted(starts, begin, side="right")) - 1
        results[d][1].append((begin - int(starts[d]), end - int(starts[d])))
    return results


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def hits(docs: DataFrame, benchmark: DataFrame, column: str = "hits") -> DataFrame:
    """``docs`` with the words of ``text`` that occur in ``benchmark`` (item_id, text).

    The new column holds the number of words, the merged spans of hit words (word numbers, end
    exclusive) and the sorted ids of the items found.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    out = docs.withColumn(column, F.lit(None).cast(HITS))
    for i in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i).collect()
        phrases = spark.sparkContext.broadcast(Phrases.of([tuple(r) for r in block]))
        out = _pass(out, column, phrases)
    return out


def _pass(docs: DataFrame, column: str, phrases) -> DataFrame:
    schema = docs.schema
    place = schema.names.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field(place).type
            for part, texts in slices(batch, "text"):
                rows = []
                for (n, spans, items), old in zip(find(phrases.value, texts), part.column(place).to_pylist()):
                    if old:
                        spans = merged(spans + [(s["start"], s["end"]) for s in old["spans"]])
                        items = items | set(old["items"])
                    rows.append(
                        {"n_words": n, "spans": [{"start": a, "end": b} for a, b in spans], "items": sorted(items)}
                    )
                columns = list(part.columns)
                columns[place] = pa.array(rows, kind)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    words = [m.span() for m in WORD.finditer(data.translate(WORD_BYTES))]
    kept, at = [], 0
    for begin, end in spans:
        kept.append(data[at : words[begin][0]])
        at = words[end - 1][1]
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


def removed(docs: DataFrame, column: str = "hits") -> DataFrame:
    """``docs`` of ``hits`` with the hit spans cut out of ``text``."""
    schema: StructType = docs.schema
    place, text = schema.names.index(column), schema.names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                found = [x["spans"] for x in part.column(place).to_pylist()]
                columns = list(part.columns)
                columns[text] = pa.array(
                    [cut(t, [(s["start"], s["end"]) for s in spans]) if spans else t for t, spans in zip(texts, found)],
                    columns[text].type,
                )
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def digest(items: list[str]) -> str:
    """The hash of item names that the query returns, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
