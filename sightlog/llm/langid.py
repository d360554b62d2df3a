"""Language ID by cross-parsing.

A suffix automaton per language is built from a bounded sample of labelled text.  A document is
read through each automaton: the longest match from the current place is a phrase, and the next
phrase starts behind it.  Few phrases mean that the text looks like the language.  The number of
phrases, times the logarithm of the language's sample size, estimates the cross entropy; the
language with the least wins.  Phrases are cut every BLOCK characters, so that all blocks of a
batch are read in step; each block of every text is read.

Every letter or mark of the samples is a symbol of its own, in any number of scripts.  The most
frequent ones have a column in a table of transitions; transitions by the others are few, at most
three for each sampled character, and are kept as a sorted list of (state, symbol).

Defined results: null text or a text without a letter is ``und`` with score 0.  When nothing could
be learned, every other text is ``unlearned`` with score 0.  Among equal languages the first by
code point wins, with score 0.  With one learned language the score is 1.  The score is 1 - least / second least.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sightlog.llm.common import with_columns

UNKNOWN = "und"
UNLEARNED = "unlearned"  # has letters, but there is no model
SYMBOLS = 64  # with a column; 0: letter not in any sample, 1: no letter, others and from SYMBOLS on: letters
WIDE = 21  # bits of a symbol in the list of transitions
BLOCK = 512  # characters read in step
PIECE = 64  # characters of a piece, at least
LEAST = 512  # characters of a language, at least


@dataclass
class Parser:
    """Transitions of all languages' automata in one table; state 0 has none."""

    languages: list[str]
    roots: np.ndarray  # row offsets of the automata's first states
    table: np.ndarray  # next state's row offset by row offset + symbol
    keys: np.ndarray  # row offset and symbol of the transitions without a column, sorted
    nexts: np.ndarray  # their next states' row offsets
    bits: np.ndarray  # logarithm of each sample's size
    symbols: np.ndarray  # by code point

    def beyond(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next states by symbols without a column."""
        key = state.astype(np.int64) << WIDE | symbol
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nexts[at], 0)


def learned(doc_id: Column) -> Column:
    """Rows that may be learned from; the rest are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def sample(labelled: DataFrame, model_chars: int, pieces: int) -> dict[str, list[str]]:
    """Bounded sample of each language: pieces of texts chosen by a hash of the row.

    The languages share ``model_chars`` characters; where that is less than LEAST for each, they
    have LEAST.  With little for each, pieces become fewer before they become short.  The start of a
    piece within its text is also chosen by hash.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("doc_id").alias("h")
    )
    languages = rows.select("lang").distinct().count()
    if not languages:
        return {}
    each = max(LEAST, model_chars // languages)
    pieces = max(1, min(pieces, each // PIECE))
    length = each // pieces
    first = W.partitionBy("lang").orderBy("h", "piece")
    piece = F.substr(
        F.col("text"),
        F.lit(1) + F.pmod("h", F.greatest(F.length("text") - length, F.lit(1))).cast("int"),
        F.lit(length),
    )
    chosen = (
        rows.select("lang", "h", piece.alias("piece"))
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= pieces)
    )
    found: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "n").collect():
        found.setdefault(row.lang, []).append(row.piece.lower())
    return found


def automaton(codes: list[int]) -> tuple[array, dict[int, dict[int, int]]]:
    """Suffix automaton; the row of state s starts at s * SYMBOLS, state 1 is the first.

    Transitions by symbols without a column are in the dictionaries, by state.  Symbol 0 separates
    pieces, and no transition by it is kept.
    """
    nxt = array("i", bytes(4 * SYMBOLS * 2))
    beyond: dict[int, dict[int, int]] = {}
    link, length, last = [0, 0], [0, 0], 1

    def step(state: int, c: int) -> int:
        return nxt[state * SYMBOLS + c] if c < SYMBOLS else beyond.get(state, {}).get(c, 0)

    def lead(state: int, c: int, to: int) -> None:
        if c < SYMBOLS:
            nxt[state * SYMBOLS + c] = to
        else:
            beyond.setdefault(state, {})[c] = to

    for c in codes:
        if c == 0:
            last = 1
            continue
        have = step(last, c)
        if have and length[have] == length[last] + 1:
            last = have
            continue
        if have:
            cur, p = 0, last
        else:
            cur = len(link)
            link.append(1)
            length.append(length[last] + 1)
            nxt.extend(bytes(SYMBOLS))
            p = last
            while p and not step(p, c):
                lead(p, c, cur)
                p = link[p]
        if p:
            q = step(p, c)
            if length[q] == length[p] + 1:
                target = q
            else:
                target = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                nxt.extend(nxt[q * SYMBOLS : (q + 1) * SYMBOLS])
                if q in beyond:
                    beyond[target] = dict(beyond[q])
                link[q] = target
                while p and step(p, c) == q:
                    lead(p, c, target)
                    p = link[p]
            if cur:
                link[cur] = target
            else:
                cur = target
        last = cur
    return nxt, beyond


def has_letter(text: str) -> bool:
    """Whether a character is a letter, which is the Unicode category L here and in Spark's patterns."""
    return any(map(str.isalpha, text))


def is_symbol(c: str) -> bool:
    """Whether the character is a letter or a mark on one, which tell languages apart."""
    return unicodedata.category(c)[0] in "LM"


def build(pieces: dict[str, list[str]]) -> Parser | None:
    if not pieces:
        return None
    letters = Counter(c for texts in pieces.values() for t in texts for c in t if is_symbol(c))
    symbols = np.array([0 if is_symbol(chr(cp)) else 1 for cp in range(sys.maxunicode + 1)], np.int32)
    for i, c in enumerate(sorted(letters, key=lambda c: (-letters[c], c))):
        symbols[ord(c)] = i + 2
    languages, tables, roots, bits, rows = sorted(pieces), [np.zeros(SYMBOLS, np.int32)], [], [], 1
    keys, nexts = [], []
    for language in languages:
        codes = [c for t in pieces[language] for c in [*(int(symbols[ord(x)]) for x in t), 0]]
        nxt, beyond = automaton(codes)
        own = np.array(nxt, np.int32).reshape(-1, SYMBOLS)[1:]
        roots.append(rows * SYMBOLS)
        tables.append(np.where(own > 0, (own + rows - 1) * SYMBOLS, 0).ravel().astype(np.int32))
        for state, by in beyond.items():
            keys += [(state + rows - 1) * SYMBOLS << WIDE | c for c in by]
            nexts += [(to + rows - 1) * SYMBOLS for to in by.values()]
        rows += len(own)
        bits.append(math.log2(len(codes) + 1))
    keys, nexts = np.array(keys, np.int64), np.array(nexts, np.int32)
    order = np.argsort(keys)
    return Parser(
        languages, np.array(roots, np.int32), np.concatenate(tables), keys[order], nexts[order], np.array(bits), symbols
    )


def phrases(parser: Parser, texts: list[str]) -> np.ndarray:
    """Number of phrases by language and text."""
    low = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in low], np.int64)
    symbols = parser.symbols[np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")]
    counts = np.zeros((len(parser.roots), len(texts)))
    if not len(symbols):
        return counts
    codes = np.where(symbols < SYMBOLS, symbols, 0).astype(np.uint8)
    wide = bool((symbols >= SYMBOLS).any())
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    length = np.minimum(sizes[owner] - nth * BLOCK, BLOCK)
    start = (np.cumsum(sizes) - sizes)[owner] + nth * BLOCK
    order = np.argsort(-length, kind="stable")
    owner, length, start = owner[order], length[order], start[order]
    active = np.searchsorted(-length, -np.arange(1, int(length[0]) + 1), side="right")
    firsts = parser.table[parser.roots[:, None] + np.arange(SYMBOLS)[None, :]]
    state = np.zeros((len(parser.roots), len(owner)), np.int32)
    made = np.zeros(state.shape, np.int32)
    for step, n in enumerate(active):
        at = start[:n] + step
        c = codes[at]
        new = parser.table.take(state[:, :n] + c)
        if wide:
            own = symbols[at]
            far = np.flatnonzero(own >= SYMBOLS)
            new[:, far] = parser.beyond(state[:, far], own[far])
        ended = new == 0
        made[:, :n] += ended
        begun = firsts[:, c]
        if wide:
            begun[:, far] = parser.beyond(np.broadcast_to(parser.roots[:, None], (len(begun), len(far))), own[far])
        state[:, :n] = np.where(ended, begun, new)
    for i in range(len(counts)):
        counts[i] = np.bincount(owner, weights=made[i], minlength=len(texts))
    return counts


def judge(parser: Parser | None, texts: list) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    named, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    rows = [i for i, t in enumerate(texts) if t and has_letter(t)]
    if parser is None:
        for i in rows:
            named[i] = UNLEARNED
    if parser is None or not rows:
        return named, scores
    cost = phrases(parser, [texts[i] for i in rows]) * parser.bits[:, None]
    best = cost.argmin(axis=0)
    for k, i in enumerate(rows):
        named[i] = parser.languages[best[k]]
        if len(parser.languages) == 1:
            scores[i] = 1.0
        else:
            least, second = np.partition(cost[:, k], 1)[:2]
            scores[i] = float(1 - least / second)
    return named, scores


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    model_chars: int = 131_072,
    pieces: int = 64,
    language: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language of ``text`` and its score.

    ``labelled`` (doc_id, text, lang) is what may be learned from; the larger of
    ``model_chars`` and LEAST for each language bounds the characters learned over all languages, and
    with it the broadcast: at most 2 * SYMBOLS * 4 bytes for each, and 3 * 12 for transitions without
    a column.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(build(sample(labelled, model_chars, pieces)))

    def compute(texts: list) -> list[pa.Array]:
        named, scores = judge(model.value, texts)
        return [pa.array(named, pa.string()), pa.array(scores, pa.float64())]

    return with_columns(docs, "text", f"`{language}` string, `{score}` double", compute)
