"""Quality rules by distribution divergence.

Each language has a reference: how its characters spread over CLASSES, and how its words spread
over its common words.  Both are counted over all documents of the language.  A document is
compared with its language's reference by Jensen-Shannon distance, and rejected where it lies too
far off; short documents are not judged by a histogram they cannot fill.

Common words are found in two steps, so that no table of all words is shuffled: parts of the
corpus name the words that make up at least 1 / RARE of a part, the CANDIDATES of each language
named most are counted over everything, and the COMMON most frequent of them are kept.

Every language has its own reference.  Languages are dealt by hash into blocks of about
MAX_LANGUAGES, and each block is counted and judged in a pass of its own, which bounds what a
task holds.  Documents without language are a group for the characters; their words, which may
be of any language, are not judged.

Defined results: null text is empty, has 0 words and fails; repeated rows are each judged;
languages without a reference (none of their documents has a word) reject nothing by distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from sightlog.llm.common import slices
from sightlog.llm.hashing import Words, mixed

CLASSES = ("small", "capital", "other letter", "digit", "blank", "line", "point", "sign")
RARE = 2000
CANDIDATES = 200
COMMON = 50
MAX_LANGUAGES = 256

# Fixed values of the contract.
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words
SYMBOLS = b"#*$%&|<>"

#: Largest distances, and what a text needs for each to be judged.
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.50
MIN_CHARS_JUDGED = 300
MIN_WORDS_JUDGED = 100

CONTINUED = len(CLASSES)  # later bytes of a character, not counted


def _class_of(b: int) -> int:
    c = chr(b)
    if b >= 0xC0:
        return 2
    if b >= 0x80:
        return CONTINUED
    if c.islower():
        return 0
    if c.isupper():
        return 1
    if c.isdigit():
        return 3
    if c == "\n":
        return 5
    if c in " \t\r\x0b\x0c":
        return 4
    return 6 if c in ".,;:!?'\"()-" else 7


CLASS_OF = np.array([_class_of(b) for b in range(256)], np.uint8)

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "class_distance double, word_distance double, base_failed boolean, kept boolean"
)


@dataclass
class Reference:
    classes: np.ndarray  # counts by class
    names: np.ndarray  # hashes of common words, sorted
    counts: np.ndarray  # their counts, and last the count of all other words


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of p from q; rows are counts."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    q = (q / max(q.sum(), 1))[None, :]
    m = (p + q) / 2

    def bits(a: np.ndarray) -> np.ndarray:
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    return np.sqrt(np.maximum((bits(p) + bits(np.broadcast_to(q, p.shape))) / 2, 0))


def repeated_words(words: Words) -> np.ndarray:
    """By text, the words in 3-word windows found twice or more in it."""
    n = len(words.names)
    at = np.flatnonzero(words.place + 3 <= words.count[words.doc])
    if not len(at):
        return np.zeros(len(words.count), np.int64)
    key = mixed(mixed(words.names[at] ^ mixed(words.doc[at].astype(np.uint64) + np.uint64(1))) + words.names[at + 1])
    key = mixed(key) + words.names[at + 2]
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    hit = np.zeros(n + 2, bool)
    for shift in range(3):
        hit[at[again] + shift] = True
    return np.bincount(words.doc[hit[:n]], minlength=len(words.count))


def class_counts(words: Words) -> np.ndarray:
    """Characters by text and class."""
    sizes = np.array([len(d) for d in words.data])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    kind = CLASS_OF[np.frombuffer(b"".join(words.data), np.uint8)].astype(np.int64)
    wide = len(CLASSES) + 1
    return np.bincount(doc * wide + kind, minlength=len(sizes) * wide).reshape(-1, wide)[:, : len(CLASSES)]


def duplicate_lines(data: bytes) -> int:
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\r\x0b\x0c")] if b"\n" in data else []
    return len(lines) - len(set(lines))


def _blocks(docs: DataFrame) -> list[DataFrame]:
    """``docs`` in parts that have about MAX_LANGUAGES languages each, and all rows of those."""
    blocks = -(-docs.select("lang").distinct().count() // MAX_LANGUAGES)
    if blocks <= 1:
        return [docs]
    block = F.pmod(F.xxhash64("lang"), F.lit(blocks))
    return [docs.where(block == b) for b in range(blocks)]


def _by_language(part: pa.RecordBatch) -> list[tuple[str | None, np.ndarray]]:
    """(language, numbers of its rows) for the languages of a batch."""
    rows: dict = {}
    for i, lang in enumerate(part.column("lang").to_pylist()):
        rows.setdefault(lang, []).append(i)
    return [(lang, np.array(i)) for lang, i in rows.items()]


def _candidate_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in slices(batch, "text"):
            words = Words(texts)
            for lang, rows in _by_language(part):
                own = words.names[np.isin(words.doc, rows)]
                names, counts = np.unique(own, return_counts=True)
                heavy = counts * RARE >= len(own)
                if heavy.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * int(heavy.sum()), pa.string()), pa.array(names[heavy].view(np.int64)), pa.array(counts[heavy])],
                        names=["lang", "name", "n"],
                    )


def _count_rows(candidates):
    """Counts of classes (kind 0), of candidates (1) and of all words (2), a row per task each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, int] = {}

        def add(lang, kind: int, keys: np.ndarray, counts: np.ndarray) -> None:
            for k, c in zip(keys.tolist(), counts.tolist()):
                totals[lang, kind, k] = totals.get((lang, kind, k), 0) + c

        for batch in batches:
            for part, texts in slices(batch, "text"):
                words = Words(texts)
                classes = class_counts(words)
                for lang, rows in _by_language(part):
                    own = words.names[np.isin(words.doc, rows)]
                    known = candidates.value.get(lang, np.zeros(0, np.uint64))
                    counts = np.bincount(_position(known, own), minlength=len(known) + 1)
                    add(lang, 0, np.arange(len(CLASSES)), classes[rows].sum(axis=0))
                    add(lang, 1, known.view(np.int64), counts[:-1])
                    add(lang, 2, np.zeros(1, np.int64), np.array([len(own)]))
        if totals:
            columns = list(zip(*[(*k, n) for k, n in totals.items()]))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "kind", "key", "n"])

    return run


def _position(known: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Where each name stands in the sorted known ones; their number for others."""
    if not len(known):
        return np.zeros(len(names), np.int64)
    at = np.minimum(np.searchsorted(known, names), len(known) - 1)
    return np.where(known[at] == names, at, len(known))


def references(docs: DataFrame) -> dict:
    """The reference of each language, from all of ``docs`` (text, lang)."""
    spark = docs.sparkSession
    named = docs.select("lang", "text").mapInArrow(_candidate_rows, "lang string, name bigint, n bigint")
    ranked = named.groupBy("lang", "name").agg(F.sum("n").alias("n"))
    candidates: dict = {}
    for row in _top(ranked, CANDIDATES):
        candidates.setdefault(row.lang, []).append(row.name)
    known = {g: np.sort(np.array(n, np.int64).view(np.uint64)) for g, n in candidates.items()}
    counted = (
        docs.select("lang", "text")
        .mapInArrow(_count_rows(spark.sparkContext.broadcast(known)), "lang string, kind int, key bigint, n bigint")
        .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
        .collect()  # at most CANDIDATES and the classes for each group
    )
    found, groups = {}, {}
    for r in counted:
        groups.setdefault(r.lang, []).append(r)
    for group, own in groups.items():
        classes = np.zeros(len(CLASSES))
        for r in own:
            if r.kind == 0:
                classes[r.key] = r.n
        words = sorted(((r.n, r.key) for r in own if r.kind == 1), reverse=True)[:COMMON]
        total = sum(r.n for r in own if r.kind == 2)
        names = np.array([k for _, k in words], np.int64).view(np.uint64)
        order = np.argsort(names)
        counts = np.array([n for n, _ in words], float)[order]
        if total:
            found[group] = Reference(classes, names[order], np.r_[counts, total - counts.sum()])
    return found


def _top(ranked: DataFrame, n: int) -> list:
    order = W.partitionBy("lang").orderBy(F.desc("n"), "name")
    return ranked.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n).collect()


def judge(docs: DataFrame, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """doc_id and FIELDS for each row of ``docs`` (doc_id, text, lang)."""
    parts = [_judged(part, max_class, max_word) for part in _blocks(docs)] or [_judged(docs, max_class, max_word)]
    while len(parts) > 1:
        parts = [a.unionAll(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) // 2 * 2 :]
    return parts[0]


def _judged(docs: DataFrame, max_class: float, max_word: float) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(references(docs))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FIELDS}"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                words = Words(texts)
                n, repeated, classes = words.count, repeated_words(words), class_counts(words)
                blanks, chars = classes[:, [4, 5]].sum(axis=1), classes.sum(axis=1)
                symbols = [len(d) - len(d.translate(None, SYMBOLS)) for d in words.data]
                lines = [duplicate_lines(d) for d in words.data]
                by_class, by_word = np.zeros(len(texts)), np.zeros(len(texts))
                for lang, rows in _by_language(part):
                    ref = held.value.get(lang)
                    if ref is None:
                        continue
                    by_class[rows] = distance(classes[rows].astype(float), ref.classes)
                    if lang is None:
                        continue
                    wide = len(ref.counts)
                    at = np.isin(words.doc, rows)
                    counts = np.bincount(
                        words.doc[at] * wide + _position(ref.names, words.names[at]), minlength=len(texts) * wide
                    ).reshape(-1, wide)[rows]
                    by_word[rows] = distance(counts.astype(float), ref.counts)
                failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n)
                far = (by_class > max_class) & (chars >= MIN_CHARS_JUDGED)
                far |= (by_word > max_word) & (n >= MIN_WORDS_JUDGED)
                columns = [n, chars - blanks, symbols, lines, repeated, by_class, by_word, failed, ~failed & ~far]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c) for c in columns]], names=names)

    return docs.select("doc_id", "text", "lang").mapInArrow(run, schema)
