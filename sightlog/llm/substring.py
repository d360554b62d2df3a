"""Exact removal of repeated passages by recompression.

Words are named by hashes of their bytes.  A first round names runs of one word, further rounds
name pairs: a pair is put together where a bit of the left name is 0 and a bit of the right name
is 1, which depends on the two names alone.  Names are hashes of what they stand for, so all
tasks give equal substrings equal names in their interior without asking each other.  For each
symbol the stretch of words that fixes it is kept along with it: wherever that stretch occurs,
the same symbol stands.

1. Symbols of the last round are counted over the corpus.  A window of WINDOW words that holds
   the stretch of a symbol found once only cannot repeat.
2. The other windows, those in stretches that share their symbols with others and the few
   without a whole symbol, are verified one by one: 96-bit names of their words are brought
   together, and all but the first (smallest doc_id, then place) lose.
3. Words that a losing window covers are removed.

Symbols and windows travel packed, a row per task and bucket, and once per task however often
they occur in it, so a passage that a third of all documents have is one entry per task.  Texts
are shuffled once; both joins use the same exchange.

A document is known by its id and a part: 0 where the id says enough, and a hash of the text for
rows without id and for ids that stand on different texts.  Both order documents and deal them
into buckets.

Defined results: null text has no words; texts with fewer than WINDOW words lose none; rows
without id come behind all others, and among themselves, like rows that share an id, in the order
of their hashes; repeated rows with one id (or none) and one text are the same document, so
neither is earlier and both keep their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from sightlog.llm.common import scratch_folder, slices, stored, text_or_empty
from sightlog.llm.hashing import Words, mixed, stretch_names

WINDOW = 20
ROUNDS = 4
#: Characters of text by bucket.
BUCKET_CHARS = 8_000_000
#: Entries a task gathers before it sends them.
HELD = 4_000_000

#: Multipliers of the names of windows, and factors that keep names of runs and pairs apart.
WINDOW_BASES = (0xD1342543DE82EF95, 0x2545F4914F6CDD1D)
RUN, PAIR = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB

#: Primes of the XXH64 specification.
XX = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)

NO_ID = np.iinfo(np.int64).max

class Symbols:
    """Symbols of the last round: name, place of the first word, and the stretch that fixes it."""

    def __init__(self, words: Words, rounds: int = ROUNDS):
        name, doc = words.names, words.doc
        n = len(name)
        at = np.arange(n)
        # a run ends where the word or the text changes; its neighbours fix that it does
        new = np.r_[True, (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])][:n]
        begin = at[new]
        size = np.diff(np.r_[begin, n])
        name = np.where(size > 1, mixed(name[begin] ^ (size.astype(np.uint64) * np.uint64(RUN))), name[begin])
        doc = doc[begin]
        low, high = begin - 1, begin + size + 1
        for nth in range(rounds):
            bit = (name >> np.uint64(nth)) & np.uint64(1) == 1
            same = doc[1:] == doc[:-1]
            joins = np.r_[~bit[:-1] & bit[1:] & same, False][: len(name)]  # with the next one
            joined = np.r_[False, joins[:-1]][: len(name)]  # with the one before
            # an unjoined symbol is fixed by the neighbour that it might have joined
            before, after = bit & ~joined, ~bit & ~joins
            low, high = (
                np.minimum(low, np.where(before, np.r_[low[:1], low[:-1]], np.where(after, np.r_[low[1:], low[-1:]], low))),
                np.maximum(high, np.where(before, np.r_[high[:1], high[:-1]], np.where(after, np.r_[high[1:], high[-1:]], high))),
            )
            # beyond the text nothing is known: such a stretch stays outside
            low = np.where(before & ~np.r_[False, same][: len(name)], words.first[doc] - 1, low)
            high = np.where(after & ~np.r_[same, False][: len(name)], words.first[doc] + words.count[doc] + 1, high)
            left = np.flatnonzero(joins)
            name = name.copy()
            name[left] = mixed(name[left] * np.uint64(PAIR) + name[left + 1])
            low[left] = np.minimum(low[left], low[left + 1])
            high[left] = np.maximum(high[left], high[left + 1])
            keep = ~joined
            name, doc, begin, low, high = name[keep], doc[keep], begin[keep], low[keep], high[keep]
        inside = (low >= words.first[doc]) & (high <= words.first[doc] + words.count[doc]) & (high - low <= WINDOW)
        self.name, self.doc, self.begin = name[inside], doc[inside], begin[inside]
        self.low, self.high = low[inside], high[inside]


def candidates(words: Words, symbols: Symbols, repeated: np.ndarray) -> np.ndarray:
    """Places in the sequence where a window starts that may repeat."""
    n = len(words.names)
    fits = words.place + WINDOW <= words.count[words.doc]
    once = ~repeated
    held = np.zeros(n + 1, np.int64)
    np.add.at(held, np.maximum(symbols.high[once] - WINDOW, 0), 1)
    np.add.at(held, symbols.low[once] + 1, -1)
    return np.flatnonzero(fits & (np.cumsum(held[:-1]) == 0))


def window_names(words: Words, at: np.ndarray) -> list[np.ndarray]:
    long, short = (mixed(stretch_names(words.names, at, at + WINDOW, base)) for base in WINDOW_BASES)
    return [long, (short >> np.uint64(32)).astype(np.uint32)]


def bucket_of(doc: np.ndarray, buckets: int) -> np.ndarray:
    """pmod(xxhash64(doc), buckets), as Spark computes it; ``doc`` is id ^ part."""
    p1, p2, p3, p4 = map(np.uint64, XX[:4])
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    h = np.uint64(XX[4] + 42 + 8) ^ (turn(doc.view(np.uint64) * p2, 31) * p1)
    h = turn(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return ((h ^ (h >> np.uint64(32))).view(np.int64) % buckets).astype(np.int32)


def bytes_of(x: np.ndarray) -> bytes:
    """The numbers, compressed byte position by byte position."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T
    return zstandard.compress(planes.tobytes(), 1)


def numbers(column, kind) -> np.ndarray:
    """All numbers of a column of ``bytes_of``."""
    size = np.dtype(kind).itemsize
    parts = [
        np.ascontiguousarray(np.frombuffer(zstandard.decompress(b), np.uint8).reshape(size, -1).T).view(kind).ravel()
        for b in column.to_pylist()
    ]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def packed(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[list]:
    """The bucket and each column's numbers in bytes, for each bucket that has entries."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist() if len(bucket) else []
    for begin, end in zip(cuts, [*cuts[1:], len(bucket)]):
        yield [int(bucket[begin]), *[bytes_of(c[begin:end]) for c in columns]]


def firsts(
    keys: list[np.ndarray], doc: np.ndarray, sub: np.ndarray, place: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by key, document and place, and in that order: whether a key begins, and whether an
    entry lies behind the key's first document and place."""
    order = np.lexsort((place, sub, doc, *keys[::-1]))
    doc, sub, place = doc[order], sub[order], place[order]
    new = np.zeros(len(order), bool)
    for key in keys:
        key = key[order]
        new |= np.r_[True, key[1:] != key[:-1]][: len(order)]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (doc != doc[head]) | (sub != sub[head]) | (place != place[head])
    return order, new, later


#: Entries of a bucket that ask (with keys) or already have an answer (without), and answers.
ENTRIES = "bucket int, asks boolean, long binary, short binary, docs binary, subs binary, places binary"
ANSWERS = "owner int, docs binary, subs binary, places binary"


class Gathered:
    """What a task has found; an entry that occurs often goes out once.

    With ``short`` there is a second key.  With ``later`` entries behind a key's first one are
    answered, else all entries of a key that occurs again.
    """

    def __init__(self, buckets: int, short: bool, later: bool):
        self.buckets, self.short, self.later = buckets, short, later
        self.parts: list[list[np.ndarray]] = []
        self.held = 0

    def add(self, keys: list[np.ndarray], doc: np.ndarray, sub: np.ndarray, place: np.ndarray):
        self.parts.append([*keys, doc.astype(np.int64), sub.astype(np.int64), place.astype(np.int32)])
        self.held += len(place)

    def sent(self) -> Iterator[list]:
        """Rows of ENTRIES."""
        if not self.held:
            return
        *keys, doc, sub, place = [np.concatenate(c) for c in zip(*self.parts)]
        self.parts, self.held = [], 0
        order, new, answered = judged(keys, doc, sub, place, self.later)
        known = order[answered]
        known = known[np.lexsort((place[known], sub[known], doc[known]))]
        owner = bucket_of(doc[known] ^ sub[known], self.buckets)
        for bucket, *blobs in packed(owner, [doc[known], sub[known], place[known]]):
            yield [bucket, False, b"", b"", *blobs]
        first = order[new]
        bucket = (keys[0][first] % np.uint64(self.buckets)).astype(np.int32)
        for bucket, *blobs in packed(bucket, [*[k[first] for k in keys], doc[first], sub[first], place[first]]):
            yield [bucket, True, blobs[0], blobs[1] if self.short else b"", *blobs[-3:]]


def judged(keys: list[np.ndarray], doc: np.ndarray, sub: np.ndarray, place: np.ndarray, only_later: bool):
    """``firsts``, and which entries of that order are answered."""
    order, new, later = firsts(keys, doc, sub, place)
    if not only_later and len(new):
        later = np.diff(np.r_[np.flatnonzero(new), len(new)])[np.cumsum(new) - 1] > 1
    return order, new, later


def _batches(rows: Iterator[list], names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    held: list[list] = []
    for row in rows:
        held.append(row)
        if len(held) == 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


ENTRY_NAMES = ["bucket", "asks", "long", "short", "docs", "subs", "places"]
ENTRY_KINDS = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
ANSWER_NAMES, ANSWER_KINDS = ["owner", "docs", "subs", "places"], [pa.int32(), *[pa.binary()] * 3]


def ids_of(part) -> np.ndarray:
    return part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def subs_of(part) -> np.ndarray:
    return part.column("sub").to_numpy(zero_copy_only=False).astype(np.int64)


def _symbol_entries(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[list]:
            gathered = Gathered(buckets, short=False, later=False)
            for batch in batches:
                for part, texts in slices(batch, "text"):
                    words = Words(texts)
                    s = Symbols(words)
                    gathered.add([s.name], ids_of(part)[s.doc], subs_of(part)[s.doc], words.place[s.begin])
                    if gathered.held >= HELD:
                        yield from gathered.sent()
            yield from gathered.sent()

        yield from _batches(rows(), ENTRY_NAMES, ENTRY_KINDS)

    return run


def _answer(buckets: int, short: bool, only_later: bool):
    """Answers to the entries of a bucket: which documents' places repeat (or come later)."""

    def run(table: pa.Table) -> pa.Table:
        asks = pa.array(table.column("asks").to_numpy(zero_copy_only=False))
        asking, known = table.filter(asks), table.filter(pc.invert(asks))
        keys = [numbers(asking.column("long"), np.uint64)]
        keys += [numbers(asking.column("short"), np.uint32)] if short else []
        kinds = {"docs": np.int64, "subs": np.int64, "places": np.int32}
        asked = [numbers(asking.column(c), k) for c, k in kinds.items()]
        order, _, answered = judged(keys, *asked, only_later)
        pick = order[answered]
        doc, sub, place = [np.r_[a[pick], numbers(known.column(c), k)] for a, (c, k) in zip(asked, kinds.items())]
        order = np.lexsort((place, sub, doc))
        doc, sub, place = doc[order], sub[order], place[order]
        return _table(packed(bucket_of(doc ^ sub, buckets), [doc, sub, place]), ANSWER_NAMES, ANSWER_KINDS)

    return run


class Answers:
    """Which (document, place) pairs were answered, for one bucket of documents."""

    def __init__(self, table: pa.Table):
        doc, sub = numbers(table.column("docs"), np.int64), numbers(table.column("subs"), np.int64)
        place = numbers(table.column("places"), np.int32).astype(np.int64)
        order = np.lexsort((place, sub, doc))
        doc, sub, self.places = doc[order], sub[order], place[order]
        first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1])][: len(doc)])
        bounds = zip(first.tolist(), [*first[1:].tolist(), len(doc)])
        self.bounds = dict(zip(zip(doc[first].tolist(), sub[first].tolist()), bounds))

    def of(self, doc_id: int, sub: int) -> np.ndarray:
        begin, end = self.bounds.get((doc_id, sub), (0, 0))
        return self.places[begin:end]

    def marks(self, words: Words, ids: np.ndarray, subs: np.ndarray) -> np.ndarray:
        """Whether each place of the sequence was answered."""
        marked = np.zeros(len(words.names), bool)
        for i, key in enumerate(zip(ids.tolist(), subs.tolist())):
            own = self.of(*key)
            own = own[own < words.count[i]]
            marked[words.first[i] + own] = True
        return marked


def _table(rows: Iterator[list], names: list[str], kinds: list) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _parts(docs: pa.Table) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in docs.to_batches():
        yield from slices(batch, "text")


def _window_entries(buckets: int):
    def run(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        answers = Answers(repeated)

        def rows() -> Iterator[list]:
            gathered = Gathered(buckets, short=True, later=True)
            for part, texts in _parts(docs):
                ids, subs = ids_of(part), subs_of(part)
                words = Words(texts)
                symbols = Symbols(words)
                at = candidates(words, symbols, answers.marks(words, ids, subs)[symbols.begin])
                gathered.add(window_names(words, at), ids[words.doc[at]], subs[words.doc[at]], words.place[at])
                if gathered.held >= HELD:
                    yield from gathered.sent()
            yield from gathered.sent()

        return _table(rows(), ENTRY_NAMES, ENTRY_KINDS)

    return run


KEPT_NAMES = ["doc_id", "n_words", "n_removed", "kept"]
KEPT_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string()]


def _kept(digest: bool):
    def run(docs: pa.Table, losers: pa.Table) -> pa.Table:
        answers = Answers(losers)

        def rows() -> Iterator[list]:
            for part, texts in _parts(docs):
                ids = part.column("doc_id").to_pylist()
                for doc_id, sub, text in zip(ids, subs_of(part).tolist(), texts):
                    words = (text or "").encode("utf-8", "surrogatepass").split()
                    at = answers.of(NO_ID if doc_id is None else doc_id, sub)
                    at = at[at + WINDOW <= len(words)]
                    kept, removed = words, 0
                    if len(at):
                        covered = np.zeros(len(words) + 1, np.int32)
                        np.add.at(covered, at, 1)
                        np.add.at(covered, at + WINDOW, -1)
                        stay = np.cumsum(covered[:-1]) == 0
                        kept = list(compress(words, stay.tolist()))
                        removed = len(words) - len(kept)
                    joined = b" ".join(kept)
                    yield [
                        doc_id, len(words), removed,
                        hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "surrogatepass"),
                    ]

        return _table(rows(), KEPT_NAMES, KEPT_KINDS)

    return run


def _with_sub(own: DataFrame) -> DataFrame:
    """``own`` (doc_id, text) with the part that tells apart rows without id, and rows of different
    texts that share one."""
    h = F.xxhash64("text")
    shared = own.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(h).alias("low"), F.max(h).alias("high"))
    shared = stored(
        shared.where("low != high").select(F.col("doc_id").alias("shared")), scratch_folder(own.sparkSession), "shared"
    )
    # odd without id, even with one
    half = F.shiftrightunsigned(h, 1).bitwiseAND(F.lit(~1))
    sub = F.when(F.col("doc_id").isNull(), half + 1).when(F.col("shared").isNotNull(), half).otherwise(0)
    return own.join(shared, F.col("doc_id") == F.col("shared"), "left").select("doc_id", "text", sub.cast("bigint").alias("sub"))


def removed_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept for each row of ``docs`` (doc_id, text).

    ``kept`` is the kept words joined by one space, or with ``digest`` their SHA-256 in hex.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-chars // BUCKET_CHARS))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    key = F.coalesce("doc_id", F.lit(int(NO_ID))).bitwiseXOR(F.col("sub"))
    own = _with_sub(own).withColumn("owner", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    by_owner = own.repartition("owner").groupBy("owner")

    symbols = own.mapInArrow(_symbol_entries(buckets), ENTRIES)
    repeated = symbols.groupBy("bucket").applyInArrow(_answer(buckets, short=False, only_later=False), ANSWERS)
    windows = by_owner.cogroup(repeated.groupBy("owner")).applyInArrow(_window_entries(buckets), ENTRIES)
    losers = windows.groupBy("bucket").applyInArrow(_answer(buckets, short=True, only_later=True), ANSWERS)
    return by_owner.cogroup(losers.groupBy("owner")).applyInArrow(
        _kept(digest), "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    )
