"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model's n-grams are ORDER characters of trusted text of one language.  Their counts, the
counts of what goes on and before (continuations), the discounts of each language and order and
the interpolation weights are aggregates and joins over tables of distinct n-grams.

Documents are dealt into buckets by a hash of their id, those without id by one of their text.  A bucket names each of its n-grams once,
with its count in trusted text: these rows are both the counts of the model and the list of what
the bucket needs to know.  The probabilities of all n-grams asked for are joined to that list by
language and n-gram, and come back to the bucket, where each document's text is read through
them.  Texts are packed and compressed for the way to their buckets, once for each step.

A document is kept if its perplexity is at most the QUANTILE of its language's.  The quantile is taken over trusted documents that the model has not seen: of the trusted ones those
with crc32(doc_id) mod 4 = 2 are held out.

Defined results: null text is empty; a text without characters has perplexity null and is
rejected; a language without held-out trusted documents has no threshold, and its other
documents are kept; null language is a language; a document with several labels is trusted if
all of them say so; repeated rows are each scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sightlog.llm.common import packed, scratch_folder, slices, stored, text_or_empty, unpacked
from sightlog.llm.langid import learned

ORDER = 4
WIDE = 16  # bits of a character in an n-gram
QUANTILE = 0.99
BUCKET_CHARS = 12_000_000

GRAMS = "owner int, lang string, gram bigint, n bigint"
SCORES = "doc_id bigint, lang string, chars bigint, perplexity double"


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character of the texts, and the text each belongs to.

    Before the first character of a text stand zeros; characters beyond 16 bits are one.
    """
    sizes = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.minimum(codes, (1 << WIDE) - 1).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    found = codes.copy()
    for back in range(1, ORDER):
        before = np.r_[np.zeros(back, np.uint64), codes[:-back]][: len(codes)]
        found |= np.where(place >= back, before, np.uint64(0)) << np.uint64(WIDE * back)
    return found, doc


def _by_language(part) -> list[tuple[str | None, list[int]]]:
    rows: dict = {}
    for i, lang in enumerate(part.column("lang").to_pylist()):
        rows.setdefault(lang, []).append(i)
    return list(rows.items())


def _count(docs: pa.Table, trusted: pa.Table) -> pa.Table:
    """Rows of GRAMS of a bucket: its n-grams, and how often trusted text has them."""
    fit = set(trusted.column("id").to_pylist())
    seen: dict = {}
    for batch in unpacked(docs):
        for part, texts in slices(batch, "text"):
            ids = part.column("doc_id").to_pylist()
            for lang, rows in _by_language(part):
                for known in (True, False):
                    own = [texts[i] for i in rows if (ids[i] in fit) is known]
                    names, counts = np.unique(grams(own)[0], return_counts=True) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                    seen.setdefault(lang, []).append((names, counts if known else counts * 0))
    owner = docs.column("owner")[0].as_py() if docs.num_rows else 0
    columns: list[list] = [[], [], [], []]
    for lang, parts in seen.items():
        names, at = np.unique(np.concatenate([n for n, _ in parts]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([c for _, c in parts]), minlength=len(names)).astype(np.int64)
        columns[0].append(pa.array(np.full(len(names), owner, np.int32)))
        columns[1].append(pa.array([lang], pa.string()).take(pa.array(np.zeros(len(names), np.int64))))
        columns[2].append(pa.array(names.view(np.int64)))
        columns[3].append(pa.array(counts))
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays([pa.chunked_array(c, k) for c, k in zip(columns, kinds)], names=["owner", "lang", "gram", "n"])


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of SCORES of a bucket."""
    order = np.argsort(answers.column("gram").to_numpy().view(np.uint64), kind="stable")
    langs = np.array(answers.column("lang").to_pylist(), object)[order]
    names, bits = answers.column("gram").to_numpy().view(np.uint64)[order], answers.column("bits").to_numpy()[order]
    tables: dict = {}
    out: list[list] = [[], [], [], []]
    for batch in unpacked(docs):
        for part, texts in slices(batch, "text"):
            ids = part.column("doc_id").to_pylist()
            for lang, rows in _by_language(part):
                if lang not in tables:
                    at = np.array([x == lang for x in langs], bool)
                    tables[lang] = names[at], bits[at]
                own, cost = tables[lang]
                found, doc = grams([texts[i] for i in rows])
                sums = np.bincount(doc, weights=cost[np.searchsorted(own, found)], minlength=len(rows)) if len(found) else np.zeros(len(rows))
                for i, total in zip(rows, sums.tolist()):
                    n = len(texts[i])
                    for c, x in zip(out, (ids[i], lang, n, 2 ** (total / n) if n else None)):
                        c.append(x)
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "lang", "chars", "perplexity"])


def _discounts(counts: DataFrame) -> DataFrame:
    """d1, d2 and d3 of each language, from the numbers of n-grams counted 1 to 4 times."""
    n = [F.sum((F.col("c") == i).cast("double")) for i in range(1, 5)]
    by = counts.groupBy("lang").agg(*[x.alias(f"n{i + 1}") for i, x in enumerate(n)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        plain = i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")
        usable = (F.col(f"n{i}") > 0) & (F.col("n1") > 0)
        return F.when(usable, F.greatest(F.least(plain, F.lit(float(i))), F.lit(0.0))).otherwise(i / 2)

    return by.select("lang", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)])


def same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _level(counts: DataFrame, folder: str, order: int) -> tuple[DataFrame, DataFrame]:
    """Of one order's n-grams (lang, gram, c): (lang, gram, own share) and (lang, context, weight)."""
    d = _discounts(counts).withColumnRenamed("lang", "dl")
    cut = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    context = F.shiftrightunsigned("gram", WIDE) if order > 1 else F.lit(0).cast("bigint")
    with_cut = stored(
        counts.join(d, same("lang", "dl")).select("lang", "gram", "c", context.alias("context"), F.least(cut, F.col("c")).alias("cut")),
        folder, f"cut-{order}",
    )
    weights = with_cut.groupBy("lang", "context").agg(
        F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("weight")
    )
    w = weights.select(F.col("lang").alias("wl"), F.col("context").alias("wc"), "total")
    shares = with_cut.join(w, same("lang", "wl") & (F.col("context") == F.col("wc"))).select(
        "lang", "gram", ((F.col("c") - F.col("cut")) / F.col("total")).alias("share")
    )
    return shares, weights.select("lang", "context", "weight")


def _suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << WIDE * order) - 1)) if order < ORDER else gram


def probabilities(asked: DataFrame, counts: DataFrame, folder: str) -> DataFrame:
    """lang, gram and probability of its last character, for the distinct rows of ``asked``.

    ``counts`` (lang, gram, c) are the n-grams of ORDER characters in trusted text.
    """
    levels = [stored(counts, folder, f"count-{ORDER}")]
    for order in range(ORDER - 1, 0, -1):
        shorter = levels[0].groupBy("lang", _suffix(F.col("gram"), order).alias("gram")).agg(F.count("*").alias("c"))
        levels.insert(0, stored(shorter, folder, f"count-{order}"))
    size = levels[0].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("p")).select(F.col("lang").alias("l"), "p")
    # from one character up: a level's probability is its share and the weighted one below
    below = asked.select("lang", _suffix(F.col("gram"), 1).alias("gram")).distinct()
    below = below.join(size, same("lang", "l"), "left").select("lang", "gram", F.coalesce("p", F.lit(2.0**-WIDE)).alias("p"))
    for order in range(1, ORDER + 1):
        shares, weights = _level(levels[order - 1], folder, order)
        here = asked.select("lang", _suffix(F.col("gram"), order).alias("gram")).distinct()
        context = F.shiftrightunsigned("gram", WIDE) if order > 1 else F.lit(0).cast("bigint")
        here = here.select("lang", "gram", context.alias("context"), _suffix(F.col("gram"), max(1, order - 1)).alias("short"))
        s = shares.select(F.col("lang").alias("sl"), F.col("gram").alias("sg"), "share")
        w = weights.select(F.col("lang").alias("wl"), F.col("context").alias("wc"), "weight")
        b = below.select(F.col("lang").alias("bl"), F.col("gram").alias("bg"), F.col("p").alias("lower"))
        joined = (
            here.join(s, same("lang", "sl") & (F.col("gram") == F.col("sg")), "left")
            .join(w, same("lang", "wl") & (F.col("context") == F.col("wc")), "left")
            .join(b, same("lang", "bl") & (F.col("short") == F.col("bg")))
        )
        p = F.coalesce("share", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("lower")
        below = stored(joined.select("lang", "gram", p.alias("p")), folder, f"known-{order}")
    return below


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """SCORES of each row of ``docs`` (doc_id, text, lang); the model is fitted to the documents
    whose ids are in ``trusted`` (doc_id)."""
    folder = scratch_folder(docs.sparkSession)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = F.lit(max(1, -(-chars // BUCKET_CHARS)))
    dealt = lambda h: F.pmod(h, buckets).cast("int").alias("owner")
    by_id, no_id = F.xxhash64("doc_id"), F.xxhash64("text")
    owner = dealt(F.when(F.col("doc_id").isNull(), no_id).otherwise(by_id))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"), "lang", owner)
    by_owner = packed(own, "owner").repartition("owner").groupBy("owner")
    fit = trusted.select("doc_id").distinct().select(F.col("doc_id").cast("bigint").alias("id"), dealt(by_id))
    found = stored(by_owner.cogroup(fit.groupBy("owner")).applyInArrow(_count, GRAMS), folder, "grams")
    counts = found.where("n > 0").groupBy("lang", "gram").agg(F.sum("n").alias("c"))
    asked = stored(found.select("lang", "gram").distinct(), folder, "asked")
    known = probabilities(asked, counts, folder)
    bits = known.select(F.col("lang").alias("kl"), F.col("gram").alias("kg"), (-F.log2("p")).alias("bits"))
    answers = found.join(bits, same("lang", "kl") & (F.col("gram") == F.col("kg"))).select("owner", "lang", "gram", "bits")
    return by_owner.cogroup(answers.groupBy("owner")).applyInArrow(_score, SCORES)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """SCORES, threshold and kept for each row of ``docs``; ``labels`` (doc_id, quality, toxic)
    of quality 1 and toxic 0 are trusted."""
    folder = scratch_folder(docs.sparkSession)
    good = labels.groupBy("doc_id").agg(F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")).where("good")
    trusted = good.where(F.col("doc_id").isNotNull()).select("doc_id")
    scored = stored(perplexities(docs, trusted.where(learned(F.col("doc_id")))), folder, "scores")
    unseen = scored.join(trusted.where(~learned(F.col("doc_id"))), "doc_id", "left_semi")
    limits = unseen.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    limits = stored(limits, folder, "limits").withColumnRenamed("lang", "ll")
    return scored.join(limits, same("lang", "ll"), "left").select(
        *scored.columns, "threshold",
        (F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))).alias("kept"),
    )
