import random
from datetime import date, datetime, timedelta

import pytest

from sightlog.functions.hashing import with_audit
from sightlog.plans import queue as Q
from sightlog.plans.staging import staging_view
from sightlog.specs import Column, TableSpec
from sightlog.tables import CATALOG, SALE_LOG, STATE_KEY

SUNDAY = date(2025, 11, 9)
MONDAY = date(2025, 11, 10)
LATER = datetime(2025, 12, 1, 12)
CARD = TableSpec(
    schema="raw", name="cards",
    columns=(Column("appid", int), Column("success", bool), Column("release_date", datetime | None)),
    key=STATE_KEY,
)
RELEASED = datetime(2020, 1, 1)


def at(day, hour=0):
    return datetime(day.year, day.month, day.day, hour)


@pytest.fixture()
def store(rows):
    """Staging views from short row lists: catalog, sales, cards."""

    def make(catalog=(), sales=(), cards=()):
        named = "appid long, name string, last_update timestamp"
        card = "appid long, success boolean, release_date timestamp, last_update timestamp"
        return (
            staging_view(with_audit(rows(list(catalog), named), CATALOG), CATALOG),
            staging_view(with_audit(rows(list(sales), named), SALE_LOG), SALE_LOG),
            staging_view(with_audit(rows(list(cards), card), CARD), CARD),
        )

    return make


def ids(df):
    return sorted(r["appid"] for r in df.collect())


def eligible(store):
    _, sales, cards = store
    return Q.eligible_sales(Q.latest_sales(sales), Q.current_cards(cards))


def days_before(n):
    return at(SUNDAY - timedelta(days=n), 3)


def test_sale_transitions(store):
    sales = [
        (1, "single", days_before(0)),
        (2, "adjacent", days_before(0)), (2, "adjacent", days_before(1)),
        (3, "gap5", days_before(0)), (3, "gap5", days_before(5)),
        (4, "gap6", days_before(0)), (4, "gap6", days_before(6)),
        (5, "stale", days_before(3)),
        (6, "before", days_before(0)), (6, "renamed", days_before(0) + timedelta(hours=1)),
        (7, "back", days_before(0)), (7, "back", days_before(9)), (7, "back", days_before(10)),
        (8, "repeat", days_before(0)), (8, "repeat", days_before(0) + timedelta(hours=2)),
    ]
    got = ids(Q.sale_transitions(eligible(store(sales=sales)), SUNDAY))
    # 6 has two names on one day and so looks as if it appeared once
    assert got == [1, 4, 6, 7, 8]


def test_eligibility_by_card(store):
    sales = [(i, "s", days_before(0)) for i in (0, 1, 2, 3)]
    cards = [(1, True, RELEASED, days_before(2)), (2, False, None, days_before(2)),
             (0, False, None, days_before(2))]
    assert ids(eligible(store(sales=sales, cards=cards))) == [1, 3]


def test_current_card_is_the_newest_state(store):
    cards = [(1, False, None, days_before(3)), (1, True, RELEASED, days_before(2)),
             (1, False, None, days_before(1))]
    _, _, view = store(cards=cards)
    assert [r["success"] for r in Q.current_cards(view).collect()] == [True]


def test_never_fetched(store):
    catalog = [(1, "card", days_before(1)), (2, "sale", days_before(1)), (3, "new", days_before(1)),
               (4, "old name", days_before(2)), (4, "new name", days_before(1))]
    catalog_view, sales, cards = store(
        catalog, [(2, "sale", days_before(30))], [(1, False, None, days_before(1))])
    latest, current = Q.latest_sales(sales), Q.current_cards(cards)
    assert ids(Q.never_fetched(catalog_view, current, latest)) == [3, 4, 4]
    assert ids(Q.never_fetched(catalog_view, current, latest, distinct_ids=True)) == [3, 4]
    assert [r["appid"] for r in Q.never_fetched(catalog_view, current, latest, limit=1).collect()] == [3]


@pytest.mark.parametrize(
    "run_date, now, expected",
    [(SUNDAY, LATER, [1, 2]), (MONDAY, LATER, []), (SUNDAY, at(SUNDAY, 23), [])],
)
def test_retry(store, run_date, now, expected):
    cards = [(1, False, RELEASED, at(SUNDAY, 1)), (2, True, None, days_before(3)),
             (3, True, RELEASED, days_before(3)), (4, True, None, days_before(3))]
    s = store(sales=[(4, "s", days_before(40))], cards=cards)
    assert ids(Q.retry_failed(Q.current_cards(s[2]), eligible(s), run_date, now)) == expected


def test_retry_takes_highest_ids(store):
    cards = [(i, False, None, days_before(3)) for i in range(9)]
    s = store(cards=cards)
    got = Q.retry_failed(Q.current_cards(s[2]), eligible(s), SUNDAY, LATER, limit=3)
    assert ids(got) == [6, 7, 8]


def test_weekday_arm_reads_nothing(store):
    s = store(cards=[(1, False, None, days_before(3))])
    plan = Q.retry_failed(Q.current_cards(s[2]), eligible(s), MONDAY, LATER)
    assert "Scan" not in plan._jdf.queryExecution().optimizedPlan().toString().replace("LocalRelation <empty>", "")


def brute_queue(catalog, sales, cards, run_date, now):
    def firsts(rows, key):
        out = {}
        for r in rows:
            k = key(r)
            out[k] = min(out.get(k, r[-1]), r[-1])
        return out

    card_states = firsts(cards, lambda r: r[:3])
    current = {}
    for (appid, success, released), seen in card_states.items():
        if appid not in current or seen > current[appid][2]:
            current[appid] = (success, released, seen)
    newest = max((c[2] for c in current.values()), default=None)
    by_id = {}
    for (appid, _, _), seen in firsts(sales, lambda r: (r[0], r[1], r[2].date())).items():
        by_id.setdefault(appid, []).append(seen)
    specials = {
        k: [d.date() for d in sorted(v, reverse=True)[:2]]
        for k, v in by_id.items()
        if k not in current or current[k][0]
    }
    changed = [
        k for k, d in specials.items()
        if max(d) == run_date and ((max(d) - min(d)).days == 0 or (max(d) - min(d)).days > 5)
    ]
    fresh = [k[0] for k in firsts(catalog, lambda r: r[:2]) if k[0] not in current and k[0] not in by_id]
    retry = []
    if run_date.isoweekday() == 7 and newest is not None and newest.date() != now.date():
        retry = [k for k, c in current.items() if (not c[0] or c[1] is None) and k not in specials]
    return sorted(changed + fresh + retry)


@pytest.mark.parametrize("seed", range(4))
def test_queue_against_brute_force(store, seed):
    rng = random.Random(seed)
    moments = iter(rng.sample(range(24 * 3600 * 12), 1500))
    start = at(SUNDAY - timedelta(days=11))

    def moment():
        return start + timedelta(seconds=next(moments))

    def appid():
        return rng.choice([1, 1, 1, *range(40)])

    catalog = [(appid(), rng.choice("ab"), moment()) for _ in range(300)]
    sales = [(appid() // 2 * 2, rng.choice("ab"), moment()) for _ in range(250)]
    cards = [(appid() // 3 * 3, rng.random() < 0.5, rng.choice([None, RELEASED]), moment()) for _ in range(60)]
    c, s, k = store(catalog, sales, cards)
    got = ids(Q.fetch_queue(c, s, k, SUNDAY, LATER))
    assert got == brute_queue(catalog, sales, cards, SUNDAY, LATER)
    assert [r["appid"] for r in Q.export_queue(Q.fetch_queue(c, s, k, SUNDAY, LATER)).collect()] == got


def test_arms_for_new_and_failed_share_no_id(store):
    cards = [(i, False, None, days_before(3)) for i in range(0, 10, 2)]
    c, s, k = store([(i, "n", days_before(4)) for i in range(10)], (), cards)
    current, latest = Q.current_cards(k), Q.latest_sales(s)
    new = set(ids(Q.never_fetched(c, current, latest)))
    retry = set(ids(Q.retry_failed(current, Q.eligible_sales(latest, current), SUNDAY, LATER)))
    assert new == {1, 3, 5, 7, 9} and retry == {0, 2, 4, 6, 8}


def test_default_run_date(store):
    day = date(2026, 1, 1)
    c, s, k = store(sales=[(1, "s", at(day, 4))])
    assert ids(Q.fetch_queue(c, s, k, now=LATER)) == [1]
