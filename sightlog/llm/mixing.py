"""Mixing sources to target weights by pivotal rounding, in DataFrame operations only.

Sources weigh 1, 2, 3, repeating in code point order (null last), and share all words by weight.
A target stops at MOST times its source's size; the excess is shared again by weight among the
others.  Every document of a source is taken floor(rate) times, and once more with the rate's
fraction as probability.

The fractions are rounded dependently: two documents exchange expected words, in a random
direction that leaves each one's expectation as it is, until one of them is taken or not.  So a
source's taken words stay what they were, whatever the draws.  Documents are dealt by hash into
blocks of about BLOCK, each block leaves one undecided document, and these form the blocks of
the next level: a tree as high as the logarithm of the documents.  The last document of a source
is rounded to the nearer side.  Draws are hashes of ids, so reruns agree.

Rows with the same id, source and size are alike, so only how many of them are taken once more is
decided: as many as the fraction of them gives in whole rows, and one row with the fraction that is
left goes into the tree.  So a source whose rows all lack an id comes as near its target as others.

Defined results: null text has size 0 and takes nothing; rows with the same id, source and size
each get a row; with no words at all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sightlog.llm.common import scratch_folder, stored, text_or_empty, word_count

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK = 64
ALIKE = 1000  # rows written out at once of those that are alike
SEED = 20_240_229


def targets(sizes: DataFrame) -> DataFrame:
    """source, place, source_size, units and target, of rows (source, size, n).

    One row per source.  In the order of size by weight the first sources are those that stop at
    MOST times their size; the rest share what is left.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.count(F.when(F.col("size") > 0, 1)).alias("units"),
    )
    order = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), F.pmod(place, F.lit(len(WEIGHTS))).cast("int") + 1)
    weighed = by_source.select("*", place.alias("place"), weight.alias("w"))
    cap = (F.col("source_size") * MOST).cast("double")
    every, by_cap = W.partitionBy(), W.orderBy(cap / F.col("w"), "place")
    before = by_cap.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(every)
    left = total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    weights_left = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = weighed.select("*", cap.alias("cap"), (left / weights_left).alias("share"))
    # the first source, in that order, that its share does not fill sets the share of the rest
    shared = level.select("*", F.min(F.when(F.col("share") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "place", "share"))).over(every).alias("first"))
    free = F.struct(F.col("cap") / F.col("w"), "place") >= F.struct(F.col("first")["col1"], F.col("first")["place"])
    target = F.when(free, F.least("cap", F.col("first")["share"] * F.col("w"))).otherwise(F.col("cap"))
    return shared.select("source", "place", "source_size", "units", target.alias("target"))


def _draw(a: Column, b: Column, level: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED + level), a, b), 11)
    return bits.cast("double") * F.lit(2.0**-53)


def fold(units: Column, level: int, kind: str) -> Column:
    """Undecided unit and decided ones (with ``take``) of an array of units, two at a time."""
    out = f"array<struct<doc_id:{kind},size:bigint,take:bigint>>"
    done = lambda u, take: F.array(F.struct(u["doc_id"].alias("doc_id"), u["size"].alias("size"), take.alias("take")))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def add(acc: Column, e: Column) -> Column:
        r = acc["rest"]
        room, spare = r["size"] - r["mass"], e["size"] - e["mass"]
        gain, loss = F.least(room, e["mass"]), F.least(r["mass"], spare)
        up = _draw(r["doc_id"], e["doc_id"], level) * (gain + loss) < loss
        # four ends: the rest is taken, the rest is left, the other is taken, the other is left
        rest_full, rest_empty = up & (room <= e["mass"]), ~up & (r["mass"] <= spare)
        keeps = rest_full | rest_empty
        with_mass = lambda u, mass: F.struct(u["doc_id"].alias("doc_id"), u["size"].alias("size"), mass.alias("mass"))
        rest = (
            F.when(rest_full, with_mass(e, e["mass"] - room))
            .when(rest_empty, with_mass(e, e["mass"] + r["mass"]))
            .when(up, with_mass(r, r["mass"] + e["mass"]))
            .otherwise(with_mass(r, r["mass"] - spare))
        )
        decided = F.when(keeps, done(r, F.when(rest_full, one).otherwise(none))).otherwise(
            done(e, F.when(up, none).otherwise(one))
        )
        return F.struct(rest.alias("rest"), F.concat(acc["out"], decided).alias("out"))

    zero = F.struct(F.get(units, F.lit(0)).alias("rest"), F.array().cast(out).alias("out"))
    return F.aggregate(F.slice(units, F.lit(2), F.greatest(F.size(units) - 1, F.lit(0))), zero, add)


def written_out(alike: DataFrame) -> DataFrame:
    """Rows (without ``n`` and ``more``, with ``take``) of units of ``n`` rows, ``more`` of which are
    taken once more.  Large units are first dealt into stretches of ALIKE rows."""

    def rows(units: DataFrame, begin: Column, end: Column) -> DataFrame:
        each = units.withColumn("nth", F.explode(F.sequence(begin, end)))
        return each.withColumn("take", (F.col("nth") < F.col("more")).cast("bigint")).drop("n", "more", "nth", "begin")

    zero, last = F.lit(0).cast("bigint"), F.col("n") - 1
    few = rows(alike.where(F.col("n") <= ALIKE), zero, last)
    parts = alike.where(F.col("n") > ALIKE).withColumn("begin", F.explode(F.sequence(zero, last, F.lit(ALIKE).cast("bigint"))))
    parts = parts.repartition("doc_id", "size", "begin")
    return few.unionByName(rows(parts, F.col("begin"), F.least(F.col("begin") + ALIKE - 1, last)))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and taken, for each row (doc_id, text, source)."""
    folder = scratch_folder(docs.sparkSession)
    sized = docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"))
    units = stored(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), folder, "units")
    sources = stored(targets(units), folder, "sources")
    kind = units.schema["doc_id"].dataType.simpleString()

    # a rate of MOST is exact: such a target is MOST times the size
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # of n rows alike n * part are taken once more: whole rows at once, the fraction left by the tree
    part = rate - F.floor(rate)
    rated = units.join(sources, units.source.eqNullSafe(sources.source)).select(
        "doc_id", units.source, "size", "n", "place", "units",
        F.floor(F.col("n") * part).alias("sure"), (F.col("n") * part - F.floor(F.col("n") * part)).alias("part"),
    )
    open_ = (F.col("part") > 0) & (F.col("size") > 0)
    level, decided = 0, []
    most = sources.agg(F.max("units")).first()[0] or 0
    rest = rated.where(open_).select("place", "units", "doc_id", "size", (F.col("size") * F.col("part")).alias("mass"))
    while True:
        # levels are fixed by the largest source; a source that is down to one unit passes through
        count = F.ceil(F.col("units") / F.lit(float(BLOCK ** (level + 1))))
        grouped = rest.groupBy(
            "place", "units", F.pmod(F.xxhash64(F.lit(SEED + level), "doc_id", "size"), count).alias("block")
        ).agg(F.sort_array(F.collect_list(F.struct("doc_id", "size", "mass"))).alias("all"))
        folded = stored(
            grouped.select("place", "units", fold(F.col("all"), level, kind).alias("f")).select(
                "place", "units", F.col("f.rest").alias("rest"), F.col("f.out").alias("out")
            ),
            folder, f"level-{level}",
        )
        decided.append(folded.select("place", F.explode("out").alias("u")).select("place", "u.*").where("take > 0"))
        rest = folded.select("place", "units", "rest.*")
        if BLOCK ** (level + 1) >= most:
            break
        level += 1
    drawn = rest.where(F.col("mass") * 2 >= F.col("size")).select("place", "doc_id", "size", F.lit(1).cast("bigint").alias("take"))
    for d in decided:
        drawn = drawn.unionByName(d)
    sure = rated.select("place", "doc_id", "size", "n", F.col("sure").alias("take"))
    taken = sure.unionByName(drawn.withColumn("n", F.lit(0).cast("bigint")))
    alike = taken.groupBy("place", "doc_id", "size").agg(F.sum("n").alias("n"), F.sum("take").alias("more"))
    by_place = sources.select("place", "source", "source_size", "target", F.floor(rate).alias("whole"))
    return written_out(alike).join(by_place, "place").select(
        "doc_id", "source", "size", "source_size", "target", ((F.col("whole") + F.col("take")) * F.col("size")).alias("taken")
    )
