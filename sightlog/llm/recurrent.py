"""Log probability of whole documents under a gated recurrent language model trained on the corpus.

Counts of all words of the training documents fix the vocabulary: the most frequent words are symbols of
the model, in classes of about equal mass (by the root of their counts), the end of a text is one, and one
more stands for all other words.  The probability of such a word is that of the symbol times its share of
the counts of all words without a symbol, where one further unit stands for all words never seen.  So the
model gives every text a probability, and the counts behind it grow with the corpus.

Training runs in rounds.  In each, tasks go on from the weights of the round before over their part of the
round's documents (truncated backpropagation in NumPy), and their weights are averaged by the tokens they
saw, each stretch of the weights in its own group.  Only the average comes to the driver, a few hundred
kilobytes whatever the corpus is.  The rounds share all training documents among them, so that each one is
learned from, in one round; counts cover all of them as well.  Scoring reads whole documents and carries the
state from window to window.

Words that are frequent in all documents are broadcast with their counts, at most ``KNOWN`` of them; each
further word of a document meets its count in a join.  As frequent words are not among them, whether or
not they were learned from, no key of that join is hot.

Defined results: a null text is empty, with the end as its only token.  A null doc_id counts as an empty
text in the split, so it is held out.  Repeated rows are scored one by one and learned from as often as
they stand there.  Extra columns are ignored.  No documents give no rows; where none is learned from, the
base score is 0 for each token and the model is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from sightlog.llm import gru
from sightlog.llm.common import most_frequent, scratch_folder, slices, stored

#: Words that are symbols of the model, and classes they are dealt to.
HEAD = 2046
CLASSES = 48
WIDTH = 32
#: Words broadcast with their counts, none longer than so many bytes: 8 MB at most.
KNOWN = 1 << 16
KNOWN_BYTES = 64
#: Distinct words a task counts before it passes them on.
TALLY_WORDS = 400_000

#: Rounds of training, which deal all training documents among them.
ROUNDS = 4
RATE = 0.01
LANES, STEPS, PIECE = 512, 16, 512
#: Tokens for a task of a round, about.
TASK_TOKENS = 2_000_000
#: Weights averaged in one group.
STRETCH = 4096
#: Tokens scored at a time in a task, about.
SCORE_TOKENS = 4_000_000

_DELTA = 0.1


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of binary texts one after another, A-Z lowered, and the row of each."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words, row = pc.list_flatten(split), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(words), 0)  # blanks at either end leave an empty word
    return words.filter(real).view(pa.binary()), row.filter(real).to_numpy()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, m): occurrences of each word in the documents to learn from, and in all."""

    def counted(texts: pa.Array, learned: bool) -> pa.Table:
        counts = pc.value_counts(words_of(texts)[0])
        m = counts.field("counts")
        n = m if learned else pa.array(np.zeros(len(m), np.int64))
        return pa.table([counts.field("values"), n, m], names=["word", "n", "m"])

    def added(held: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(held).group_by("word").aggregate([("n", "sum"), ("m", "sum")])
        return sums.select(["word", "n_sum", "m_sum"]).rename_columns(["word", "n", "m"])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for part, _ in slices(batch, "text"):
                out = part.column("held_out")
                for rows, learned in ((pc.invert(out), True), (out, False)):
                    held.append(counted(part.column("text").filter(rows), learned))
                if sum(map(len, held)) > 2 * TALLY_WORDS:
                    held = [added(held)]
                    if len(held[0]) > TALLY_WORDS:
                        yield from held[0].to_batches()
                        held = []
        if held:
            yield from added(held).to_batches()

    parts = docs.select("text", "held_out").mapInArrow(tally, "word binary, n bigint, m bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def vocabulary(counts: DataFrame, n_docs: int, head: int, classes: int, known: int) -> dict:
    """What tasks need to number and to weigh words; bounded by ``head`` and ``known``."""
    sums = counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    total, distinct = (sums["n"] or 0) + n_docs, sums["v"] + (n_docs > 0)
    short = counts.where(F.octet_length("word") <= KNOWN_BYTES)
    top, often = most_frequent(short, "n", head).collect(), most_frequent(short, "m", known).collect()

    symbols = sorted([(n_docs, b"")] + [(r["n"], bytes(r["word"])) for r in top], key=lambda s: (-s[0], s[1]))
    n = np.array([s[0] for s in symbols], np.float64)
    mass = np.sqrt(np.maximum(n, 0.5))
    class_of = np.minimum((np.cumsum(mass) - mass) / mass.sum() * classes, classes - 1).astype(np.int64)
    class_of = np.unique(class_of, return_inverse=True)[1]
    rare = total - int(n.sum())
    rare_words = distinct - len(symbols) + (n_docs == 0)
    out = {
        "symbol": {w: i for i, (_, w) in enumerate(symbols)},  # the end is the empty word
        "class_of": np.append(class_of, class_of[-1] + 1), "counts": np.append(n, rare),
        "base_unit": total + _DELTA * (distinct + 1), "rare_unit": rare + _DELTA * (rare_words + 1), "total": total,
    }
    words = {bytes(r["word"]): r["n"] for r in chain(top, often)}
    out["known"] = {w: i for i, w in enumerate([b"", *words])}
    n = np.array([n_docs, *words.values()], np.int64)
    number = np.array([out["symbol"].get(w, len(symbols)) for w in out["known"]], np.int64)
    out["number"], out["seen"] = number, n > 0
    out["base"] = np.log10((n + _DELTA) / out["base_unit"])
    out["rest"] = np.where(number == len(symbols), np.log10((n + _DELTA) / out["rare_unit"]), 0.0)
    return out


def encoded(docs: DataFrame, vocabulary: dict) -> DataFrame:
    """Texts as symbol numbers, with what the known words add to the scores, and the other words.

    (doc_id, held_out, n_tokens, n_known, base, rest, ids, others)
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kinds = ["bigint", "boolean", "bigint", "bigint", "double", "double", "binary", "map<binary, int>"]
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "rest", "ids", "others"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        known, rare = pa.array(list(v["known"]), pa.binary()), len(v["class_of"]) - 1
        values = {k: np.append(v[k], last) for k, last in (("number", rare), ("seen", False), ("base", 0.0), ("rest", 0.0))}
        for batch in batches:
            for part, texts in slices(batch, "text"):
                words, row = words_of(part.column("text"))
                found = pc.fill_null(pc.index_in(words, known), -1).to_numpy()
                n = np.bincount(row, minlength=len(texts)) + 1
                starts = np.cumsum(n) - n
                at = np.zeros(int(n.sum()), np.int64)  # the end of each text stays, which is the first known word
                at[np.arange(len(row)) + row] = found
                sums = {k: np.add.reduceat(values[k][at].astype(np.float64), starts) for k in ("seen", "base", "rest")}
                other = np.flatnonzero(found < 0)
                coded = words.take(pa.array(other)).dictionary_encode()
                size = max(1, len(coded.dictionary))
                pair, times = np.unique(row[other] * size + coded.indices.to_numpy(), return_counts=True)
                upto = np.searchsorted(pair, size * np.arange(len(texts) + 1)).astype(np.int32)
                ends = np.append(0, 2 * np.cumsum(n)).astype(np.int32)
                ids = values["number"][at].astype(np.uint16)
                arrays = [
                    part.column("doc_id"), part.column("held_out"), pa.array(n), pa.array(sums["seen"].astype(np.int64)),
                    pa.array(sums["base"]), pa.array(sums["rest"]),
                    pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(ids)]),
                    pa.MapArray.from_arrays(pa.array(upto), coded.dictionary.take(pa.array(pair % size)), pa.array(times.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def _texts(batch: pa.RecordBatch, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with about so many tokens, as numbers, with the texts' lengths."""
    for part, blobs in slices(batch, "ids", 2 * most):
        lengths = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 2
        yield part, np.frombuffer(b"".join(blobs), np.uint16).astype(np.int64), lengths


def trained_round(texts: DataFrame, weights: dict, vocabulary: dict, rate: float, tasks: int) -> np.ndarray | None:
    """Average of the weights that tasks reach from ``weights``, by the tokens they saw."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((weights, vocabulary["class_of"], vocabulary["symbol"][b""]))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, class_of, end = shared.value
        trainer = gru.Trainer(weights, class_of, end, rate, LANES, STEPS, PIECE)
        for batch in batches:
            for _, numbers, lengths in _texts(batch, TASK_TOKENS):
                trainer.learn(numbers, lengths)
        if trainer.seen:
            vector = trainer.vector.astype(np.float64) * trainer.seen
            at = np.arange(0, len(vector), STRETCH)
            arrays = [
                pa.array(at // STRETCH, pa.int64()), pa.array(np.full(len(at), trainer.seen), pa.int64()),
                pa.array([vector[a : a + STRETCH].tobytes() for a in at], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["stretch", "tokens", "sums"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.float64) for b in table.column("sums").to_pylist())
        n = sum(table.column("tokens").to_pylist())
        return pa.table([table.column("stretch").slice(0, 1), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["stretch", "tokens", "sums"])

    fields = "stretch bigint, tokens bigint, sums binary"
    parts = texts.select("ids").coalesce(tasks).mapInArrow(train, fields)
    # first within groups of at most some hundred tasks
    groups = F.pmod(F.spark_partition_id(), F.lit(max(1, tasks // 256)))
    near = parts.groupBy("stretch", groups.alias("g")).applyInArrow(added, fields)
    rows = sorted(near.groupBy("stretch").applyInArrow(added, fields).collect(), key=lambda r: r["stretch"])
    if not rows:
        return None
    return np.concatenate([np.frombuffer(r["sums"], np.float64) / r["tokens"] for r in rows]).astype(np.float32)


def train(texts: DataFrame, vocabulary: dict, width: int, rounds: int) -> dict:
    """Weights after all rounds; ``texts`` are encoded, with the ``deal`` of each, which is its round."""
    weights = gru.start(vocabulary["class_of"], vocabulary["counts"], width)
    learned = texts.where(~F.col("held_out"))
    sizes = {r["deal"]: r["n"] for r in learned.groupBy("deal").agg(F.sum("n_tokens").alias("n")).collect()}  # rounds rows
    for r in range(rounds):
        mine = learned.where(F.col("deal") == r)
        tasks = max(1, sizes.get(r, 0) // TASK_TOKENS)
        vector = trained_round(mine, weights, vocabulary, RATE / (1 + r), tasks)
        if vector is not None:
            weights = gru.shaped(vector, weights)
    return weights


def scored(texts: DataFrame, weights: dict, vocabulary: dict) -> DataFrame:
    """(row, logp): log10 probability of the symbols of each text."""
    shared = texts.sparkSession.sparkContext.broadcast((weights, vocabulary["class_of"], vocabulary["symbol"][b""]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = gru.Scorer(*shared.value)
        for batch in batches:
            for part, numbers, lengths in _texts(batch, SCORE_TOKENS):
                logp = scorer.score(numbers, lengths) / np.log(10)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(logp)], names=["row", "logp"])

    return texts.select("row", "ids").mapInArrow(run, "row bigint, logp double")


def with_counts(each: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of ``each`` with the ``n`` of their word, null if ``counts``, a row a word, has none.

    They meet by a hash of the word, as numbers are sorted without comparing words; words that only share
    it are told apart, in a form that is no further key to sort by.
    """
    each = each.withColumn("hash", F.xxhash64("word"))
    counts = counts.select(F.xxhash64("word").alias("of_hash"), F.col("word").alias("of_word"), "n")
    same = (F.col("word") >= F.col("of_word")) & (F.col("word") <= F.col("of_word"))
    return each.join(counts, (F.col("hash") == F.col("of_hash")) & same, "left").drop("hash", "of_hash", "of_word")


def score(
    docs: DataFrame, head: int = HEAD, classes: int = CLASSES, width: int = WIDTH, known: int = KNOWN, rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of all documents.

    ``docs`` has doc_id and text.  The weights are trained on all training documents, dealt to so many ``rounds``.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    counts = stored(word_counts(docs), folder, "counts")
    n_docs = docs.agg(F.count_if(~F.col("held_out"))).first()[0]
    words = vocabulary(counts, n_docs, head, classes, known)
    deal = F.pmod(F.xxhash64("doc_id", "ids"), F.lit(rounds)).cast("int").alias("deal")
    texts = stored(encoded(docs, words).select("*", deal, F.monotonically_increasing_id().alias("row")), folder, "texts")
    weights = train(texts, words, width, rounds)
    logs = scored(texts, weights, words)

    c = F.coalesce(F.col("n"), F.lit(0))
    others = with_counts(texts.select("row", F.explode("others").alias("word", "times")), counts).groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("o_known"),
        F.sum(F.col("times") * F.log10((c + _DELTA) / F.lit(words["base_unit"]))).alias("o_base"),
        F.sum(F.col("times") * F.log10((c + _DELTA) / F.lit(words["rare_unit"]))).alias("o_rest"),
    )
    plain = texts.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rest")
    joined = plain.join(logs, "row").join(others, "row", "left")

    def also(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + also("o_known")).alias("n_known"),
        F.lit(words["total"]).cast("bigint").alias("train_tokens"), (F.col("base") + also("o_base")).alias("base_score"),
        (F.col("logp") + F.col("rest") + also("o_rest")).alias("score"),
    )
