"""Importance resampling, the recurrent model and ranked search against plain versions."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from sightlog.llm import gru, importance, lexical, recurrent
from sightlog.llm.common import LOWER
from sightlog.llm.queries import QUERIES


def table(spark, folder: str, name: str, *columns: str) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*columns).collect()]


@pytest.fixture(params=["small", "odd"])
def folder(request):
    return request.getfixturevalue(request.param)


def features(text: str | None) -> list[str]:
    words = brute.ITEM_WORDS.findall(brute.lower(text or ""))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % 10_000


def importance_rows(docs: list[tuple], target: list[str | None]) -> list[tuple]:
    """(doc_id, n_features, weight, score, long enough)."""
    s = Counter(bucket(f) for _, t in docs for f in features(t))
    t = Counter(bucket(f) for text in target for f in features(text))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out = []
    for d, text in docs:
        f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((d, len(f), weight, score, len(brute.ITEM_WORDS.findall(brute.lower(text or ""))) >= 20))
    return out


def test_importance(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    expected = importance_rows(docs, [t for (t,) in table(spark, folder, "benchmark", "text")])
    found = [tuple(r) for r in QUERIES["op11_importance"](spark, folder).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert Counter(r[:4] for r in found) == Counter(r[:4] for r in expected)
    drawn = sorted((r for r in expected if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = drawn[: 25 * len(drawn) // 100]
    ranked = sorted((r for r in found if r[4] is not None), key=lambda r: r[4])
    assert [r[4] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [r[:4] for r in ranked] == [r[:4] for r in drawn]


@pytest.mark.parametrize("head", [0, 1, 50])
def test_head_changes_nothing(spark, small, head):
    """Whatever is broadcast, buckets are the same."""
    texts = [t.encode() for (t,) in table(spark, small, "documents", "text")[:40]]
    split = [importance.folded_words(t) for t in texts]
    words = Counter(w for f in split for w in f)
    pairs = Counter(p for f in split for p in zip(f, f[1:]))
    top = [w for w, _ in words.most_common(head)]
    known = importance.head_of(top, [p for p, _ in pairs.most_common(head)], 10_000)
    numbers, size = importance.bucket_numbers(known, 10_000, [importance.folded_words(t) for t in texts])
    assert size.tolist() == [len(features(t.decode())) for t in texts]
    ends = np.cumsum(size)
    for t, a, b in zip(texts, ends - size, ends):
        assert Counter(numbers[a:b].tolist()) == Counter(bucket(f) for f in features(t.decode()))


def test_counters_keep_what_is_frequent():
    counts = Counter({f"w{i}": 1 for i in range(1000)} | {"a": 500, "b": 400})
    kept = importance._cut_back(counts, 10)
    assert len(kept) <= 10 and kept["a"] >= 499 and kept["b"] >= 399


def ranked(docs: list[tuple], items: list[tuple], top: int = 50) -> Counter:
    terms = [(d, Counter(brute.ITEM_WORDS.findall(brute.lower(t or "")))) for d, t in docs]
    terms = [(d, c) for d, c in terms if c]
    n_docs, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(w for _, c in terms for w in c)
    out = Counter()
    for item, text in items:
        scores = []
        for d, c in terms:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = 0
            for w in set(brute.ITEM_WORDS.findall(brute.lower(text or ""))) & set(c):
                weight = math.floor(1000 * math.log((2.0 * n_docs + 2) / (2.0 * df[w] + 1)))
                score += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(scores)[:top], 1):
            out[item, rank, None if none else d, -score] += 1
    return out


def test_search(spark, folder):
    docs, items = table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text")
    found = QUERIES["op13_lexical_search"](spark, folder).select("item_id", "rank", "doc_id", "score")
    assert Counter(tuple(r) for r in found.collect()) == ranked(docs, items)


@pytest.mark.parametrize("shares", [(1.0,), (0.3, 1.0), (0.0001, 0.001, 0.01, 0.1, 0.5, 1.0)])
def test_search_does_not_depend_on_owners_or_blocks(spark, small, shares):
    docs, items = table(spark, small, "documents", "doc_id", "text"), table(spark, small, "benchmark", "item_id", "text")
    frames = (spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7), spark.createDataFrame(items, "item_id bigint, text string"))
    found = lexical.search(*frames, top=5, shares=shares, block_bytes=4000)
    assert Counter(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()) == ranked(docs, items, 5)


def test_base_scores(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    lowered = [(d, brute.words(brute.lower(t or "")) + [None]) for d, t in docs]
    out = [zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0 for d, _ in docs]
    counts = Counter(w for (_, ws), o in zip(lowered, out) if not o for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter()
    for (d, ws), o in zip(lowered, out):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        expected[d, o, len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 6)] += 1
    found = QUERIES["op12_recurrent_lm"](spark, folder).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == expected
    # held-out texts are more probable under the model than under the counts
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in found)


def toy_model(seed: int = 0) -> tuple[dict, np.ndarray]:
    rng = np.random.default_rng(seed)
    class_of = np.array([0, 1, 1, 1, 2, 2, 3])
    weights = gru.start(class_of, rng.integers(1, 20, 7).astype(float), 5, seed)
    for k in ("class_weight", "word_weight", "bias"):
        weights[k] = rng.normal(0, 0.5, weights[k].shape).astype(np.float32)
    return weights, class_of


def plain_score(w: dict, class_of: np.ndarray, tokens: list[int], end: int) -> float:
    """One text, one token at a time."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, before, total = np.zeros(5), end, 0.0
    for t in tokens:
        x, a = w["embed"][before] @ w["input"] + w["bias"], h @ w["state"]
        z, r = sigmoid(x[:5] + a[:5]), sigmoid(x[5:10] + a[5:10])
        h = (1 - z) * np.tanh(x[10:] + r * a[10:]) + z * h
        classes = np.exp(h @ w["class_weight"] + w["class_bias"])
        within = np.exp(w["word_weight"] @ h + w["word_bias"]) * (class_of == class_of[t])
        total += math.log(classes[class_of[t]] / classes.sum() * within[t] / within.sum())
        before = t
    return total


@pytest.mark.parametrize("lanes,steps", [(1, 3), (4, 2), (50, 7)])
def test_state_is_carried_over_windows(lanes, steps):
    weights, class_of = toy_model()
    rng = np.random.default_rng(1)
    lengths = np.array([1, 40, 3, 17, 2, 90, 5])
    tokens = rng.integers(0, 7, lengths.sum())
    ends = np.cumsum(lengths)
    expected = [plain_score(weights, class_of, tokens[a:b].tolist(), 0) for a, b in zip(ends - lengths, ends)]
    assert gru.Scorer(weights, class_of, 0, lanes, steps).score(tokens, lengths) == pytest.approx(expected, rel=1e-4)


def test_probabilities_of_all_words_add_up():
    weights, class_of = toy_model(3)
    assert sum(math.exp(plain_score(weights, class_of, [t], 0)) for t in range(7)) == pytest.approx(1)


def test_gradients_against_differences():
    weights, class_of = toy_model(2)
    weights = {k: v.astype(np.float64) for k, v in weights.items()}
    bounds = np.searchsorted(class_of, np.arange(class_of[-1] + 2))
    rng = np.random.default_rng(5)
    before, token = rng.integers(0, 7, (4, 3)), rng.integers(0, 7, (4, 3))
    fresh = np.zeros((4, 3), bool)
    fresh[0], fresh[2, 1] = True, True

    def loss(w):
        out, _, _ = gru.forward(w, w["embed"] @ w["input"] + w["bias"], before, fresh, np.zeros((3, 5)), False)
        return -gru.outputs(w, class_of, bounds, out.reshape(-1, 5).astype(np.float64), token.ravel())[0].sum()

    back = {k: np.zeros_like(v) for k, v in weights.items()}
    out, _, kept = gru.forward(weights, weights["embed"] @ weights["input"] + weights["bias"], before, fresh, np.zeros((3, 5)), True)
    _, d = gru.outputs(weights, class_of, bounds, out.reshape(-1, 5), token.ravel(), back)
    gru.backward(weights, before, fresh, kept, d.reshape(out.shape), back)
    for k in gru.NAMES:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in weights[k].shape)
            moved = {n: v.copy() for n, v in weights.items()}
            moved[k][at] += 1e-2
            up = loss(moved)
            moved[k][at] -= 2e-2
            assert (up - loss(moved)) / 2e-2 == pytest.approx(back[k][at], abs=2e-2, rel=2e-2)


def test_no_documents_to_learn_from(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:5]
    df = spark.createDataFrame([(i, "some words here") for i in held] + [(None, None)], "doc_id bigint, text string")
    found = recurrent.score(df).collect()
    assert len(found) == 6 and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in found)
    assert all(r.score <= 0 for r in found)


def test_every_training_document_is_learned_from_once(spark, monkeypatch):
    rows = [(i, " ".join(f"w{i % 7}x{j % 5}" for j in range(i % 40))) for i in range(600)] + [(5, "again"), (None, "no id")]
    learned, train = [], recurrent.trained_round

    def seen(texts, *rest):
        learned.extend(r.doc_id for r in texts.select("doc_id").collect())
        return train(texts, *rest)

    monkeypatch.setattr(recurrent, "trained_round", seen)
    found = recurrent.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(found) == len(rows)
    assert sorted(learned) == sorted(r.doc_id for r in found if not r.held_out)


def test_words_of_bytes():
    texts = [b"  A b\tC\x0bd ", b"", None, "ÀB ß x y\x1cz\x85 q\x00r".encode(), b"\n", b"\xff\xfeA \xc3 B", b"x"]
    expected = [(i, w) for i, t in enumerate(texts) for w in (t.translate(LOWER).split() if t else [])]
    for skipped in (0, 3):
        words, row = recurrent.words_of(pa.array(texts, pa.binary()).slice(skipped))
        assert list(zip((row + skipped).tolist(), words.to_pylist())) == [e for e in expected if e[0] >= skipped]


def test_wide_scores_do_not_overflow():
    weights, class_of = toy_model(1)
    weights = {k: v * np.float32(40) if k in ("class_weight", "word_weight") else v for k, v in weights.items()}
    bounds = np.searchsorted(class_of, np.arange(class_of[-1] + 2))
    states, token = np.linspace(-1, 1, 35, dtype=np.float32).reshape(7, 5), np.array([3, 0, 6, 5, 1, 4, 2])
    w = {k: v.astype(np.float64) for k, v in weights.items()}
    classes = states @ w["class_weight"] + w["class_bias"]
    words = states @ w["word_weight"].T + w["word_bias"]
    own = class_of[None, :] == class_of[token][:, None]
    expected = classes[np.arange(7), class_of[token]] - np.logaddexp.reduce(classes, axis=1)
    expected += words[np.arange(7), token] - np.logaddexp.reduce(np.where(own, words, -np.inf), axis=1)
    back = {k: np.zeros_like(v) for k, v in weights.items()}
    found, slopes = gru.outputs(weights, class_of, bounds, states, token, back)
    assert found == pytest.approx(expected, rel=1e-4, abs=1e-4)
    assert np.isfinite(slopes).all() and all(np.isfinite(g).all() for g in back.values())


def test_sums_by_key():
    rng = np.random.default_rng(8)
    for n in (1, 5, 700):  # keys with one row, with some, and with many
        rows, key = rng.normal(0, 1, (3, n, 4)).astype(np.float32), (rng.random(n) ** 3 * 60).astype(np.int64)
        keys, sums = gru.sums_by(rows, key, 60)
        assert sorted(keys.tolist()) == np.unique(key).tolist()
        assert sums == pytest.approx(np.stack([rows[:, key == k].sum(axis=1) for k in keys], axis=1), abs=1e-4)


def test_tokens_in_blocks_against_all_at_once():
    weights, class_of = toy_model(4)
    bounds = np.searchsorted(class_of, np.arange(class_of[-1] + 2))
    rng = np.random.default_rng(9)
    n = 2 * gru.BLOCK + 5
    states, token = np.tanh(rng.normal(0, 1, (n, 5))).astype(np.float32), rng.integers(0, 7, n)
    one, all_back = {}, {k: np.zeros_like(v) for k, v in weights.items()}
    found, slopes = gru.outputs(weights, class_of, bounds, states, token, all_back, 0.5)
    back = {k: np.zeros_like(v) for k, v in weights.items()}
    for i in range(n):
        one[i] = gru.outputs(weights, class_of, bounds, states[i : i + 1], token[i : i + 1], back, 0.5)
    assert found == pytest.approx(np.concatenate([one[i][0] for i in range(n)]), abs=1e-5)
    assert slopes == pytest.approx(np.concatenate([one[i][1] for i in range(n)]), abs=1e-5)
    for k in gru.NAMES:
        assert all_back[k] == pytest.approx(back[k], abs=1e-2)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_words_that_share_a_hash_keep_their_counts(spark, monkeypatch, threshold):
    words = [b"a", b"b", b"ab", b"ba", b"", b"\xff", b"abc"]
    counts = spark.createDataFrame([(w, 10 * i) for i, w in enumerate(words[:5])], "word binary, n bigint")
    rows = [(r, w, 1 + r % 3) for r in range(20) for w in words[r % 4 :]]
    each = spark.createDataFrame(rows, "row bigint, word binary, times int")
    monkeypatch.setattr(recurrent.F, "xxhash64", lambda c: recurrent.F.octet_length(c).cast("bigint"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = recurrent.with_counts(each, counts).select("row", "word", "times", "n").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    n = {w: 10 * i for i, w in enumerate(words[:5])}
    assert sorted((r.row, bytes(r.word), r.times, r.n is None, r.n or 0) for r in found) == sorted((r, w, t, w not in n, n.get(w, 0)) for r, w, t in rows)
