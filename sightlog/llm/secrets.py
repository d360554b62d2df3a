"""Secret scans with corpus-wide ownership frequency, in DataFrame operations only.

Matches of fixed patterns are secrets wherever they stand.  Further candidates, long mixed
tokens, are judged by how widely they are spread: the hashes of all candidates are counted by
distinct repositories and owners.  A value of one owner and few repositories looks like a live
credential; one that several owners share, or that an owner has in many repositories, is a copied
example.

Places are code points, found by adding up the lengths of matches and of what lies between them,
in time that grows with the text and the matches and not with their square.
Counts are aggregated by value and owner before they are put together, and joined back by value;
a value that a third of all rows have is one row per task and owner in the first, and a split
partition in the second.

Defined results: null text is empty; a null owner is an owner, a null repository a repository;
repeated rows each get a row, and count once for their repository.  Kinds at one start stand in
the order of KINDS.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sightlog.llm.common import bound, scratch_folder, stored, text_or_empty, walked

# Fixed values of the contract: patterns and least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

#: Long tokens; those with digits, small and capital letters are candidates.
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
MIXED = r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"

KINDS = ("assign", "access", "hex", "opaque")
MAX_OWNERS = 1
MAX_REPOS = 16

SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _matches(text: Column, kind: int, pattern: str, group: int, ok) -> Column:
    """Spans of the pattern's matches, leftmost and without overlap, whose value passes ``ok``."""
    p = F.lit(pattern)
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, p, F.lit(0)).alias("full"),
        F.regexp_extract_all(text, p, F.lit(group)).alias("value"),
    )

    def step(at: Column, piece: Column, _) -> tuple[Column, Column, Column]:
        start = at + F.length(piece["gap"])
        end = start + F.length(piece["full"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), piece["value"].alias("value"))
        return F.coalesce(end, start), span, F.coalesce(ok(piece["value"]), F.lit(False))

    found = walked(pieces, F.lit(0), SPANS, step)["out"]
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPANS))


def _any(value: Column) -> Column:
    return value.isNotNull()


def scan(text: Column) -> tuple[Column, Column]:
    """Base spans by start and kind, and opaque candidates."""
    base = F.concat(
        _matches(text, 0, ASSIGN, 2, lambda v: F.length(v) >= ASSIGN_VALUE),
        _matches(text, 1, ACCESS, 0, _any),
        _matches(text, 2, HEX, 0, _any),
    )
    return F.array_sort(base), _matches(text, 3, OPAQUE, 0, lambda v: v.rlike(MIXED))


def apart(base: Column, opaque: Column) -> Column:
    """The opaque spans that overlap no base span; others say nothing new.

    One walk over all spans in order: an opaque one waits until it is clear that no base span
    begins inside it.
    """
    none = F.lit(None).cast(SPANS[len("array<"):-1])

    def step(acc: Column, s: Column, _) -> tuple[Column, Column, Column]:
        is_base, covered = s["kind"] < 3, s["start"] < acc["end"]
        waits = (
            F.when(is_base & (s["start"] < acc["waits"]["end"]), none)
            .when(is_base | covered, acc["waits"]).otherwise(s)
        )
        end = F.when(is_base, F.greatest(acc["end"], s["end"])).otherwise(acc["end"])
        return F.struct(end.alias("end"), waits.alias("waits")), acc["waits"], ~(is_base | covered) & acc["waits"].isNotNull()

    apart_ = bound(
        walked(F.array_sort(F.concat(base, opaque)), F.struct(F.lit(0).alias("end"), none.alias("waits")), SPANS, step),
        lambda w: F.when(w["carry"]["waits"].isNull(), w["out"]).otherwise(F.concat(w["out"], F.array(w["carry"]["waits"]))),
    )
    return F.when(F.size(opaque) == 0, opaque).when(F.size(base) == 0, opaque).otherwise(apart_)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each value, of rows (value, repo, owner)."""
    once = found.groupBy("value", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = once.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return owners.groupBy("value").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def secrets(
    docs: DataFrame, keep: str = "doc_id", repo: str = "doc_id", owner: str = "source", max_owners: int = MAX_OWNERS,
    max_repos: int = MAX_REPOS,
) -> DataFrame:
    """The column ``keep``, base, extra, n_live and n_copied for each row of ``docs``.

    ``base`` and ``extra`` are spans; extra ones are live-looking opaque tokens apart from base
    spans.  Values with at most ``max_owners`` owners and ``max_repos`` repositories are live, others
    copied.
    """
    folder = scratch_folder(docs.sparkSession)
    text = text_or_empty()
    base, opaque = scan(text)
    own = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(keep).alias("keep"), F.col(repo).alias("repo"),
            F.col(owner).alias("owner"), base.alias("base"), opaque.alias("opaque"),
        ),
        folder, "found",
    )
    spans = F.concat("base", apart(F.col("base"), F.col("opaque")))
    candidates = own.select(
        "row", "repo", "owner", F.explode(spans).alias("span")
    ).select("row", "repo", "owner", "span", F.sha2("span.value", 256).alias("value"))
    known = ownership(candidates.select("value", "repo", "owner"))
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    judged = (
        candidates.select("row", "span", "value").join(known, "value")
        .groupBy("row")
        .agg(
            F.array_sort(F.collect_list(F.when(live & (F.col("span.kind") == 3), F.col("span")))).alias("extra"),
            F.sum(live.cast("bigint")).alias("n_live"),
            F.sum((~live).cast("bigint")).alias("n_copied"),
        )
    )
    return own.select("row", "keep", "base").join(judged, "row", "left").select(
        F.col("keep").alias(keep), "base",
        F.coalesce("extra", F.array().cast(SPANS)).alias("extra"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def of_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def redacted(text: Column, spans: Column, mark: str = "[redacted]") -> Column:
    """The text with each stretch that spans cover replaced by a mark."""

    def stretch(acc: Column, block: Column) -> Column:
        end = F.array_max(F.transform(block, lambda s: s["end"]))
        return F.struct(acc["at"].alias("begin"), F.substr(text, acc["at"] + 1, F.greatest(end - acc["at"], F.lit(0))).alias("text"))

    def step(acc: Column, s: Column, known: Column) -> tuple[Column, Column, Column]:
        apart = (s["start"] >= acc["at"]) & ((s["start"] > acc["at"]) | (acc["seen"] == 0))
        piece = F.concat(F.substr(known["text"], acc["at"] - known["begin"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.lit(1).alias("seen")), piece, apart

    done = bound(
        walked(spans, F.struct(F.lit(0).alias("at"), F.lit(0).alias("seen")), "array<string>", step, stretch),
        lambda w: F.concat(F.array_join(w["out"], ""), F.substr(text, w["carry"]["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) == 0, text).otherwise(done)
