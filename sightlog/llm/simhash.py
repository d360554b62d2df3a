"""SimHash near-duplicates through an inverted index over byte positions.

A text's 64-bit fingerprint has a bit set when over half of its 3-word shingles' hashes have it.
Two fingerprints that differ in at most 3 bits share at least 5 of their 8 bytes at the same
positions.  Lists by single bytes would hold 1/256 of all fingerprints each, so a posting list is
kept for each choice of 5 positions: the guaranteed matches put both of a linked pair in at
least one common list.  Such a list leaves 3 bytes free: it has at most 2^24 distinct
fingerprints, however many documents there are, and it is worked through in time linear in its
length.  Pairs that reach the minimum number of shared bytes are verified bit by bit, and a list
gives the edges of a spanning forest, not all its pairs.

Copies are folded into one fingerprint before the index, so groups of copies cost nothing.

Defined results: null or blank text has fingerprint 0 and is linked like any other; repeated
rows each get a row; null ids never name a component (it is null only if all its ids are).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sightlog.llm.common import LOWER, scratch_folder, stored, with_columns
from sightlog.llm.components import components

SEED = 42
MAX_BITS = 3
SHARED_BYTES = 8 - MAX_BITS
SHINGLES_AT_ONCE = 1 << 16

#: Masks of the posting lists, and the bit offsets of the bytes each leaves free.
LISTS = [
    (sum(0xFF << 8 * p for p in kept), [8 * p for p in range(8) if p not in kept])
    for kept in combinations(range(8), SHARED_BYTES)
]

#: Sets of at most 3 of 24 bits, to look up neighbours in long lists.
NEAR = np.array(
    [sum(1 << b for b in bits) for n in range(1, MAX_BITS + 1) for bits in combinations(range(24), n)], np.int64
)
#: Lists from this length on look neighbours up instead of comparing.
LONG = 4096
#: Lists up to this length are compared together.
SHORT = 32


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) < 3:
        return h(b" ".join(words), SEED)
    set_bits, n = np.zeros(64, np.int64), len(words) - 2
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = words[at : at + SHINGLES_AT_ONCE + 2]
        hashes = np.array([h(b"%b %b %b" % x, SEED) for x in zip(part, part[1:], part[2:])], ">u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, column: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a long."""

    def compute(texts: list) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))]

    return with_columns(docs, "text", f"`{column}` bigint", compute)


def forest(f: np.ndarray, free: list[int]) -> list[tuple[int, int]]:
    """Edges that connect what is linked within one posting list of distinct fingerprints."""
    edges: list[tuple[int, int]] = []
    if len(f) >= LONG:
        low = sum(((f >> np.uint64(s)) & np.uint64(0xFF)).astype(np.int64) << 8 * i for i, s in enumerate(free))
        at = np.full(1 << 24, -1, np.int32)
        at[low] = np.arange(len(f))
        for root in range(len(f)):
            if at[low[root]] < 0:
                continue
            at[low[root]] = -1
            todo = [root]
            while todo:
                node = todo.pop()
                near = low[node] ^ NEAR
                found = at[near]
                near, found = near[found >= 0], found[found >= 0]
                at[near] = -1
                edges += [(node, int(x)) for x in found]
                todo += found.tolist()
        return edges
    rest, todo = np.arange(len(f)), []
    while len(rest) or todo:
        if not todo:
            todo, rest = [int(rest[0])], rest[1:]
        node = todo.pop()
        linked = np.bitwise_count(f[rest] ^ f[node]) <= MAX_BITS
        found = rest[linked].tolist()
        edges += [(node, x) for x in found]
        todo, rest = todo + found, rest[~linked]
    return edges


def links(kind: np.ndarray, key: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges within complete lists; rows are sorted by list."""
    new = np.r_[True, (kind[1:] != kind[:-1]) | (key[1:] != key[:-1])]
    begin = np.flatnonzero(new)
    size = np.diff(np.r_[begin, len(f)])
    group = np.cumsum(new) - 1
    left, right = [], []
    short = size[group] <= SHORT
    for shift in range(1, min(SHORT, int(size.max()))):
        a = np.flatnonzero((group[shift:] == group[:-shift]) & short[:-shift])
        differ = f[a] ^ f[a + shift]
        shared = sum((differ >> np.uint64(8 * p)) & np.uint64(0xFF) == 0 for p in range(8))
        a = a[shared >= SHARED_BYTES] if len(a) else a
        a = a[np.bitwise_count(f[a] ^ f[a + shift]) <= MAX_BITS]
        left.append(f[a])
        right.append(f[a + shift])
    for g in np.flatnonzero(size > SHORT):
        own = f[begin[g] : begin[g] + size[g]]
        edges = np.array(forest(own, LISTS[kind[begin[g]]][1]), np.int64).reshape(-1, 2)
        left.append(own[edges[:, 0]])
        right.append(own[edges[:, 1]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def scan_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from rows sorted by list; a list that goes on in the next batch waits for it."""
    held = [np.zeros(0, np.int64)] * 3

    def edges(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(columns[0]) > 1:
            a, b = links(columns[0], columns[1], columns[2].view(np.uint64))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    waiting: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        if not len(columns[0]):
            continue
        same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
        whole = bool(same.all())
        if whole and waiting and (waiting[-1][0][-1], waiting[-1][1][-1]) == (columns[0][0], columns[1][0]):
            waiting.append(columns)
            continue
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not whole else 0
        held = [np.concatenate(x) for x in zip(*waiting, [c[:cut] for c in columns])]
        yield from edges(held)
        waiting = [[c[cut:] for c in columns]]
    if waiting:
        yield from edges([np.concatenate(x) for x in zip(*waiting)])


def index_links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints of ``prints`` (fp)."""
    lists = F.array(
        *[F.struct(F.lit(i).alias("kind"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, (m, _) in enumerate(LISTS)]
    )
    postings = prints.select(F.explode(lists).alias("l"), "fp").select("l.kind", "l.key", "fp")
    return (
        postings.repartition("kind", "key")
        .sortWithinPartitions("kind", "key")
        .mapInArrow(scan_lists, "a bigint, b bigint")
    )


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def groups(own: DataFrame, folder: str) -> DataFrame:
    """fp, root and component_id of each distinct fingerprint of ``own`` (doc_id, fp)."""
    prints = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), folder, "distinct")
    edges = stored(index_links(prints.select("fp")).distinct(), folder, "edges")
    member = components(edges, folder)
    placed = prints.join(member, prints.fp == member.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp (long) and component_id of each row of ``docs`` (doc_id, text)."""
    folder = scratch_folder(docs.sparkSession)
    own = stored(fingerprints(docs.select("doc_id", "text")).select("doc_id", "fp"), folder, "prints")
    return own.join(groups(own, folder), "fp").select("doc_id", "fp", "component_id")
