"""Every query of the subpackage against plain versions, on given, odd and empty tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sightlog.llm import kneser_ney, langid, licenses, mixing, quotes, secrets, substring
from sightlog.llm.queries import QUERIES

FOLDERS = ["small", "odd"]


@pytest.fixture(params=FOLDERS)
def folder(request):
    return request.getfixturevalue(request.param)


def documents(spark, folder: str) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def rows(df, *columns: str) -> list[tuple]:
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_secrets(spark, folder):
    found = rows(QUERIES["op1_secrets"](spark, folder), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert Counter(found) == Counter((d, *brute.secrets(t)) for d, t, _, _ in documents(spark, folder))


def test_quality(spark, folder):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = rows(QUERIES["op2_quality"](spark, folder), *columns, "kept")
    assert Counter(r[:-1] for r in found) == Counter((d, *brute.quality_base(t)) for d, t, _, _ in documents(spark, folder))
    assert not any(r[-1] and r[-2] for r in found)


def test_substring(spark, folder):
    found = rows(QUERIES["op3_substring"](spark, folder), "doc_id", "n_words", "n_removed", "kept_sha256")
    docs = {(d, t): (d, t) for d, t, _, _ in documents(spark, folder) if d is not None}
    expected = brute.deduplicated(list(docs.values()))
    assert {r for r in found if r[0] is not None} == set(expected)


def test_mixing(spark, folder):
    found = rows(QUERIES["op4_mixing"](spark, folder), "doc_id", "size", "source_size", "target", "taken")
    docs = documents(spark, folder)
    assert Counter((r[0], r[1]) for r in found) == Counter((d, len(brute.words(t))) for d, t, _, _ in docs)
    sizes, largest, source = defaultdict(int), defaultdict(int), {}
    for d, t, _, s in docs:
        n = len(brute.words(t))
        sizes[s] += n
        source[d, n] = s
        largest[s] = max(largest[s], n)
    wanted, taken = brute.targets(sizes), defaultdict(int)
    for d, n, source_size, target, words in found:
        s = source[d, n]
        assert source_size == sizes[s] and target == pytest.approx(wanted[s])
        assert words <= 3 * n and (n == 0 or words % n == 0)
        taken[s] += words
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= largest[s] / 2 + 1e-6


def test_mixing_reruns_agree(spark, odd):
    first = rows(QUERIES["op4_mixing"](spark, odd), "doc_id", "size", "taken")
    assert Counter(first) == Counter(rows(QUERIES["op4_mixing"](spark, odd), "doc_id", "size", "taken"))


def test_language(spark, folder):
    found = rows(QUERIES["op5_language_id"](spark, folder), "doc_id", "held_out", "lang_pred", "score")
    docs = {d: (t, lang) for d, t, lang, _ in documents(spark, folder) if d is not None and d < 10_000}
    known = [(docs[d][1], p) for d, h, p, _ in found if d in docs and h]
    assert sum(a == b for a, b in known) >= 0.95 * len(known)
    for d, held, named, score in found:
        assert 0 <= score <= 1
        assert d is None or held == brute.held_out(d)
    texts = {d: t for d, t, _, _ in documents(spark, folder)}
    for d, _, named, _ in found:
        if d is not None:
            assert (named == "und") == (not any(c.isalpha() for c in texts[d] or ""))


def test_decontamination(spark, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    expected = brute.decontaminated([(d, t) for d, t, _, _ in documents(spark, folder)], items)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert Counter(rows(QUERIES["op8_decontamination"](spark, folder), *columns)) == Counter(expected)


def test_simhash(spark, folder):
    found = rows(QUERIES["op10_simhash"](spark, folder), "doc_id", "fingerprint", "component_id")
    docs = [(d, t) for d, t, _, _ in documents(spark, folder)]
    assert len(found) == len(docs)
    expected = brute.near_duplicates([x for x in dict.fromkeys(docs) if x[0] is not None])
    for d, print_, component in found:
        if d is not None:
            assert (print_, component) == expected[d]


def test_perplexity(spark, folder):
    found = rows(QUERIES["op7_perplexity"](spark, folder), "doc_id", "chars", "perplexity", "threshold", "kept")
    docs = documents(spark, folder)
    assert Counter((r[0], r[1]) for r in found) == Counter((d, len(t or "")) for d, t, _, _ in docs)
    for _, chars, perplexity, threshold, kept in found:
        assert (perplexity is None) == (chars == 0) and (kept or chars == 0 or perplexity > threshold)


def test_licenses(spark, folder):
    found = rows(QUERIES["op9_licenses"](spark, folder), "doc_id", "licenses")
    texts = {d: t for d, t, _, _ in documents(spark, folder)}
    assert len(found) == len(documents(spark, folder))
    for d, names in found:
        if d is not None:  # rows without id: test_licenses_of_rows_without_id
            has = [n for n, line in (("MIT", "Released under the MIT License"), ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
                                     ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
                                     ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0")) if line in (texts[d] or "")]
            assert set(has) <= set(names.split(","))
            assert bool(has) or not names


def test_licenses_of_rows_without_id(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    texts = [mit, "nothing of that kind here", gpl, None, "", mit + " " + gpl, mit]
    df = spark.createDataFrame([(None, t) for t in texts] + [(7, mit), (7, "plain text of the same id")], "doc_id long, text string")
    found = Counter((r.doc_id, ",".join(sorted({f["name"] for f in r.findings}))) for r in licenses.licenses(df).collect())
    assert found == Counter({(None, "MIT"): 2, (None, ""): 3, (None, "GPL-3.0"): 1, (None, "GPL-3.0,MIT"): 1, (7, "MIT"): 1, (7, ""): 1})


def test_licenses_in_chunks(spark, monkeypatch):
    """Windows and findings do not depend on where chunks end."""
    rng, names = random.Random(3), [t for _, t in licenses.TEMPLATES]
    rows = [(i, " ".join(rng.choice(names) if rng.random() < 0.1 else f"w{rng.randrange(9)}" for _ in range(rng.randrange(1, 400)))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = Counter((r.doc_id, tuple(map(tuple, r.findings))) for r in licenses.licenses(df).collect())
    monkeypatch.setattr(licenses, "CHUNK", 512)
    assert Counter((r.doc_id, tuple(map(tuple, r.findings))) for r in licenses.licenses(df).collect()) == whole


def test_secrets_of_one_owner_in_many_documents(spark):
    """A token that one source has in many documents is a copied example, in few a live credential."""
    placeholder, live, shared = "Example0Placeholder1Token2x", "Live9Credential8Of7One6Owner", "Shared5By4Two3Owners2Token1"
    rows = [(i, f"see {placeholder} there", "hot") for i in range(2000)] + [(5000, f"a {live} b", "hot"), (5001, f"a {live} c", "hot")]
    rows += [(6000, shared, "x"), (6001, shared, None), (None, placeholder, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.secrets(df).select("doc_id", "n_live", "n_copied", F.size("extra").alias("n")).collect()
    assert {r.doc_id for r in found if r.n_live} == {5000, 5001}
    assert all(r.n == r.n_live and r.n_live + r.n_copied == 1 for r in found)
    assert len(found) == len(rows)


def test_many_secrets_in_one_text(spark):
    text = " ".join(f"token=abcdef{i:05d} é AKIA{'Q' * 16}" for i in range(3000))
    df = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    found = secrets.secrets(df)
    (row,) = found.select("doc_id", F.sha2(secrets.listed(F.col("base")), 256).alias("h"), F.size("base").alias("n")).collect()
    assert row.n == 6000 and row.h == brute.secrets(text)[-1]
    (cut,) = found.select(secrets.redacted(F.lit(text), F.col("base")).alias("text")).collect()
    assert cut.text == " ".join(["[redacted] é [redacted]"] * 3000)


def test_mixing_of_a_source_without_ids(spark):
    """Rows that share id and size come as near the target as others, also where one is a third of all."""
    rows = [(None, "w " * 10, "a")] * 1500 + [(i, "w " * (i % 9 + 1), "b") for i in range(1500)] + [(5, "w " * 7, "c")] * 1500
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    by = mixed.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("largest")
    ).collect()
    assert {r.source: r.n for r in by} == {"a": 1500, "b": 1500, "c": 1500}
    assert all(abs(r.taken - r.target) <= r.largest / 2 + 1e-6 for r in by)


def test_perplexity_rejects_bad_text(spark):
    """Shuffled and foreign characters go, text like the trusted one stays, whatever its length."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}{c}" for a in ("ba", "to", "li") for b in ("ren", "mos", "kat") for c in ("", "er", "ing", "s")]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    good = [(i, sentence(rng.randrange(20, 60)), "en") for i in range(400)]
    noise = lambda n: "".join(rng.choice("qxzvjw#@%&0123456789 ") for _ in range(n))
    bad = [(1000 + i, noise(rng.randrange(40, 300)), "en") for i in range(100)] + [(None, noise(200), "en")] * 3
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 400, 2)] + [(1000 + i, 0, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    kept = kneser_ney.classify(docs, labels).where("kept").select("doc_id").collect()
    assert not [r for r in kept if r.doc_id is None or r.doc_id >= 1000]
    assert len(kept) >= 0.95 * len(good)


def test_letters(spark, small):
    df = spark.createDataFrame([(1, "½ ² Ⅷ 12 _"), (2, "漢"), (3, "é"), (4, "①"), (5, None)], "doc_id long, text string")
    labelled = spark.createDataFrame([(i, f"some english text é 漢 {i}", "en") for i in range(20)], "doc_id long, text string, lang string")
    named = {r.doc_id: r.lang_pred for r in langid.identify(df, labelled).collect()}
    assert named == {1: "und", 2: "en", 3: "en", 4: "und", 5: "und"}


def test_three_hundred_languages(spark):
    """With many languages pieces become fewer, not too short to tell anything."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k:03d}": ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(30)] for k in range(300)}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(40)), lang) for i, lang in enumerate(list(words) * 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    held = ~langid.learned(F.col("doc_id"))
    named = langid.identify(df.where(held), df.where(~held)).select((F.col("lang") == F.col("lang_pred")).cast("int").alias("right"))
    assert named.agg(F.avg("right")).first()[0] >= 0.95


def test_quotes(spark, odd):
    found = {(r[0], r[1]): r for r in rows(QUERIES["op6_quotes"](spark, odd), "conv_id", "turn", "body", "reply_to", "thread", "n_quotes", "n_linked", "place")}
    assert found[1, 1][2:] == ("Try again with cmake.", 0, 0, 1, 1, 1)
    # the level-1 quote decides; the level-2 one is linked as well
    assert found[1, 2][2:] == ("That works, thank you.", 1, 0, 2, 2, 2)
    assert found[1, 3][3:] == (0, 0, 1, 1, 3)  # a passage over two lines, wrapped differently
    assert found[None, 1][3] is None and found[2, 0][2] == ""
    long = [found[3, i] for i in range(3000)]
    assert [r[3] for r in long] == [None, *range(2999)]
    assert {r[4] for r in long} == {0} and [r[7] for r in long] == list(range(3000))


def test_pipeline(spark, odd):
    mixed = corpus_pipeline.run(spark, odd)
    docs = documents(spark, odd)
    assert mixed.columns[: len(spark.read.parquet(f"{odd}/documents.parquet").columns)] == spark.read.parquet(f"{odd}/documents.parquet").columns
    ids = [r[0] for r in rows(mixed, "doc_id")]
    assert len(ids) == len(set(ids)) and set(ids) <= {d for d, *_ in docs}
    items = [tuple(r) for r in spark.read.parquet(f"{odd}/benchmark.parquet").select("item_id", "text").collect()]
    left = rows(mixed, "doc_id", "text", "mix_copies", "mix_words")
    assert not any(r[5] for r in brute.decontaminated([(d, t) for d, t, _, _ in left], items))
    assert not any(sum(brute.secrets(t)[:3]) for _, t, _, _ in left)
    assert all(w == c * len(brute.words(t)) and 1 <= c <= 3 for _, t, c, w in left)


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_and_empty_input(spark, odd, empty, stage):
    name, function = corpus_pipeline.STAGES[stage]
    for folder in (odd, empty):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        out = function(spark, docs, folder)
        assert out.columns[: len(docs.columns)] == docs.columns
        assert (out.columns == docs.columns) == (stage < 4)
        assert out.count() <= docs.count()


def test_stages_keep_clean_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = [(d, t) for d, t, _, _ in documents(spark, small)]
    assert corpus_pipeline.language(spark, docs, small).count() == docs.count()
    groups = {c for _, c in brute.near_duplicates(texts).values()}
    assert {r[0] for r in rows(corpus_pipeline.near_dedup(spark, docs, small), "doc_id")} == groups
    redacted = dict(rows(corpus_pipeline.secret_redaction(spark, docs, small), "doc_id", "text"))
    assert all(redacted[d] == t for d, t in texts if not sum(brute.secrets(t)[:3]))


def test_pipeline_texts_against_plain_versions(spark, small, tmp_path):
    """The first four stages, document by document."""
    docs = {d: t for d, t, _, _ in documents(spark, small) if any(c.isalpha() for c in t or "")}
    components = {c for _, c in brute.near_duplicates(list(docs.items())).values()}
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    expected = {}
    for d in components:
        text = brute.without_windows(docs[d], items)
        if text is not None:
            expected[d] = brute.redacted(text)
    stage = spark.read.parquet(f"{small}/documents.parquet")
    for i, (_, function) in enumerate(corpus_pipeline.STAGES[:4]):
        function(spark, stage, small).write.parquet(f"{tmp_path}/{i}")
        stage = spark.read.parquet(f"{tmp_path}/{i}")
    found = {d: (t, n) for d, t, n in rows(stage, "doc_id", "text", "n_chars")}
    assert {d: t for d, (t, _) in found.items()} == expected
    assert all(n == len(t) for t, n in found.values())


def test_distances_against_plain_version(spark, small):
    from sightlog.llm import divergence
    from sightlog.llm.hashing import Words

    docs = documents(spark, small)
    name = {}
    for _, t, _, _ in docs:
        words = Words([t])
        name.update(zip(brute.words(t), words.names.tolist()))
    wanted = {}
    for lang in {x for _, _, x, _ in docs}:
        texts = [t for _, t, x, _ in docs if x == lang]
        counts = Counter(w for t in texts for w in brute.words(t))
        total = sum(counts.values())
        heavy = [(n, name[w] - (1 << 64) if name[w] >> 63 else name[w], w) for w, n in counts.items() if n * divergence.RARE >= total]
        common = [w for _, _, w in sorted(heavy, reverse=True)[: divergence.COMMON]]
        classes = Counter(divergence._class_of(b) for t in texts for b in t.encode())
        wanted[lang] = (
            [classes[i] for i in range(len(divergence.CLASSES))],
            {w: counts[w] for w in common}, total - sum(counts[w] for w in common),
        )
    for d, kept, by_class, by_word in rows(QUERIES["op2_quality"](spark, small), "doc_id", "kept", "class_distance", "word_distance"):
        text, lang = next((t, x) for i, t, x, _ in docs if i == d)
        classes, common, rest = wanted[lang]
        own = Counter(divergence._class_of(b) for b in text.encode())
        assert by_class == pytest.approx(brute.distance([own[i] for i in range(len(classes))], classes), abs=1e-9)
        mine = Counter(w for w in brute.words(text) if w in common)
        total = len(brute.words(text))
        assert by_word == pytest.approx(
            brute.distance([*[mine[w] for w in common], total - sum(mine.values())], [*common.values(), rest]), abs=1e-9
        )
        if kept:
            assert by_class <= divergence.MAX_CLASS_DISTANCE or len(text) < divergence.MIN_CHARS_JUDGED
            assert by_word <= divergence.MAX_WORD_DISTANCE or total < divergence.MIN_WORDS_JUDGED


def test_perplexity_against_plain_model(spark, small):
    """The whole chain, from counts to perplexities, for a few documents."""
    from sightlog.llm.langid import learned  # noqa: F401 - the rule is repeated below

    docs = documents(spark, small)
    labels = defaultdict(list)
    for d, q, x in rows(spark.read.parquet(f"{small}/labels.parquet"), "doc_id", "quality", "toxic"):
        labels[d].append((q, x) == (1, 0))
    fit = {d for d, good in labels.items() if all(good) and not brute.held_out(d)}
    found = {r[0]: r[1] for r in rows(QUERIES["op7_perplexity"](spark, small), "doc_id", "perplexity")}
    for lang in ("en", "de"):
        model = brute.KneserNey([t for d, t, x, _ in docs if x == lang and d in fit], order=4)
        for d, t, x, _ in docs[::9]:
            if x == lang and t:
                assert found[d] == pytest.approx(model.perplexity(t), rel=1e-6)


def test_language_stage_keeps_documents_when_no_language_is_known(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(-1).cast("bigint")))
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit("12 34 !?")).withColumn("doc_id", F.lit(-2).cast("bigint")))
    with_letters = {d for d, t in rows(docs, "doc_id", "text") if any(c.isalpha() for c in t or "")}
    kept = {r[0] for r in rows(corpus_pipeline.language(spark, docs, small), "doc_id")}
    assert kept == with_letters and len(kept) >= 190


def test_substring_without_ids_and_with_shared_ids(spark, odd):
    """Rows without id, and rows that share an id, are documents of their own."""
    text = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    passage = text("p", 30)
    given = [(d, t) for d, t, _, _ in documents(spark, odd)]
    given += [(None, text("a", 90)), (None, text("b", 10) + " " + passage), (None, passage + " " + text("c", 70)), (None, text("e", 200))]
    given += [(7_000_000, text("f", 80)), (7_000_000, passage + " " + text("g", 9)), (7_000_000, text("h", 60)), (2**63 - 1, text("i", 40) + " " + passage)]
    df = spark.createDataFrame(given, "doc_id bigint, text string").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition(5)
    found = rows(substring.removed_repeats(df, digest=True), "doc_id", "n_words", "n_removed", "kept")
    half = F.shiftrightunsigned(F.xxhash64("text"), 1).bitwiseAND(F.lit(~1))
    hashed = {(d, t): h for d, t, h in rows(df.withColumn("h", half), "doc_id", "text", "h")}
    # ids in order, those without one last, and then by hash
    keyed = {(d is None, d or 0, h, t): t for (d, t), h in hashed.items()}
    expected = Counter((None if key[0] else key[1], *rest) for key, *rest in brute.deduplicated(list(keyed.items())))
    assert set(found) == set(expected)
    assert (None, 200, 0) in {r[:3] for r in found} and (7_000_000, 60, 0) in {r[:3] for r in found}


def test_quality_has_a_reference_for_every_language(spark, monkeypatch):
    """Documents of rare languages are compared with their own, however many languages there are."""
    from sightlog.llm import divergence

    monkeypatch.setattr(divergence, "MAX_LANGUAGES", 3)
    docs = []
    for k in range(10):
        for i in range(2 + (k < 3)):
            docs.append((100 * k + i, " ".join(f"l{k}w{(j * (i + 3)) % 40} x{k}y{j * 7 + i}" for j in range(100)), f"l{k}"))
    docs += [(9_000 + i, docs[3 * i][1], None) for i in range(4)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(4)
    found = {r.doc_id: r for r in divergence.judge(df).collect()}
    assert len(found) == len(docs)
    for k in range(10):
        alone = {r.doc_id: r for r in divergence.judge(df.where(F.col("lang") == f"l{k}")).collect()}
        assert alone and all(found[d] == r and r.word_distance > 0 for d, r in alone.items())
    assert all(found[9_000 + i].word_distance == 0 for i in range(4))


def test_short_quoted_lines_and_many_threads(spark):
    said = "Is the build ready now, and can we ship?\nYes, please.\nOk"
    talk = [(1, 0, "user", said), (1, 1, "assistant", "Something else."), (1, 2, "user", "> Yes, please.\nDone."), (1, 3, "user", "> Ok\nFine.")]
    # threads of their own over several ranges, with replies to early ones at the end
    talk += [(2, i, "user", f"line {i} of many") for i in range(3000)]
    talk += [(2, 3000 + i, "user", f"> line {7 * i} of many\nreply") for i in range(50)]
    df = spark.createDataFrame(talk, "conv_id long, turn int, role string, text string").repartition(5)
    found = {(r.conv_id, r.turn): r for r in quotes.linked(df).collect()}
    assert [found[1, t].reply_to for t in range(4)] == [None, None, 0, 0]
    assert [found[1, t].n_linked for t in (2, 3)] == [1, 1]
    assert [found[1, t].place for t in range(4)] == [0, 3, 1, 2]
    own = [r for r in found.values() if r.conv_id == 2]
    assert all(found[2, 3000 + i].reply_to == 7 * i for i in range(50))
    assert [r.place for r in sorted(own, key=lambda r: (r.thread, r.turn))] == list(range(3050))
