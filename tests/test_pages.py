import random

import pytest

from sightlog.operators.pages import (
    PageError,
    islands,
    missing_pages,
    missing_ranges,
    require_totals,
    total_count,
    truncation,
)


def test_total_count(rows):
    df = rows([(1, '{"total_count": 250}'), (2, '{"total_count": -1}'), (3, '{"total_count": "x"}'),
               (4, "{}"), (5, None), (6, "{bad"), (7, '{"total_count": 0}'),
               (8, '{"total_count": "72"}'), (9, '{"total_count": 72.0}')], "id int, payload string")
    got = {r["id"]: r["total_count"] for r in total_count(df).collect()}
    assert got == {1: 250, 2: None, 3: None, 4: None, 5: None, 6: None, 7: 0, 8: None, 9: None}
    with pytest.raises(PageError, match="^7 "):
        require_totals(df)
    assert require_totals(df.where("id in (1, 7)")).count() == 2


@pytest.mark.parametrize("block", [1, 2, 10_000])
def test_missing_pages(rows, block):
    totals = rows([("a", 250), ("b", 300), ("c", 0), ("d", None)], "walk string, total_count long")
    landed = rows([("a", 0), ("a", 200), ("a", 200), ("b", 100)], "walk string, offset long")
    got = missing_pages(landed, totals, ["walk"], 100, block)
    assert sorted(map(tuple, got.collect())) == [("a", 100), ("b", 0), ("b", 200)]


@pytest.mark.parametrize("block", [1, 2, 5, 10_000])
@pytest.mark.parametrize("density", [0.3, 0.9, 1.0])
def test_islands_against_brute_force(rows, block, density):
    rng = random.Random(block)
    data = [(k, p) for k in "ab" for p in range(60) if rng.random() < density]
    expected = []
    for k in "ab":
        mine = sorted(p for key, p in data if key == k)
        start = previous = None
        for p in mine:
            if previous is None or p != previous + 1:
                if previous is not None:
                    expected.append((k, start, previous, previous - start + 1))
                start = p
            previous = p
        if previous is not None:
            expected.append((k, start, previous, previous - start + 1))
    df = rows(data, "walk string, page long")
    got = islands(df, ["walk"], "page", block).select("walk", "first", "last", "length")
    assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_truncation(rows):
    sizes = {"full": [5, 5, 5, 5], "ended": [5, 5, 0, 0], "gappy": [5, 0, 5, 0], "short": [5, 5]}
    df = rows([(w, i, n) for w, pages in sizes.items() for i, n in enumerate(pages)],
              "walk string, page long, n long")
    got = {r["walk"]: (r["pages"], r["longest_empty_run"], r["truncated"])
           for r in truncation(df, ["walk"], "page", "n", 4, 2, block=2).collect()}
    assert got == {"full": (4, 0, True), "ended": (4, 2, False), "gappy": (4, 1, True), "short": (2, 0, False)}
    with pytest.raises(ValueError):
        truncation(df, ["walk"], "page", "n", 0, 2)


@pytest.mark.parametrize("block", [1, 3, 10_000])
@pytest.mark.parametrize("max_rows", [None, 95])
def test_missing_ranges_are_the_missing_pages(rows, block, max_rows):
    rng = random.Random(block)
    walks = [(w, rng.choice([0, 1, 10, 95, 400, None])) for w in "abcdefgh"] + [(None, 30)]
    landed = [(w, rng.choice([rng.randrange(45) * 10, rng.randrange(450), -10])) for w, _ in walks[:-2] for _ in range(rng.randrange(60))]
    totals, pages = rows(walks, "walk string, total_count long"), rows(landed, "walk string, offset long")
    gaps = missing_ranges(pages, totals, ["walk"], 10, block, max_rows).collect()
    found = sorted((str(g["walk"]), o) for g in gaps for o in range(g["first"], g["last"] + 1, 10))
    expected = sorted((str(r["walk"]), r["offset"]) for r in missing_pages(pages, totals, ["walk"], 10, max_rows=max_rows).collect())
    assert found == expected and sum(g["pages"] for g in gaps) == len(found)
    ends = {(g["walk"], g["last"] + 10) for g in gaps}
    assert not any((g["walk"], g["first"]) in ends for g in gaps)  # as long as can be


def test_missing_ranges_of_a_walk_without_keys(rows):
    landed, totals = rows([(0,), (20,), (30,)], "offset long"), rows([(60,)], "total_count long")
    assert sorted(tuple(r) for r in missing_ranges(landed, totals, [], 10).collect()) == [(10, 10, 1), (40, 50, 2)]
    with pytest.raises(ValueError, match="page_rows"):
        missing_ranges(landed, totals, [], 0)
