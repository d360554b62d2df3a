import random
from datetime import date, datetime, timedelta

import pytest

from sightlog.functions.hashing import with_audit
from sightlog.operators.compaction import add_column, compact, idempotent_append, unseen
from sightlog.plans.staging import staging_view
from sightlog.tables import CATALOG, PACKAGES, SALE_LOG

SCHEMA = "appid long, name string, last_update timestamp"


def random_log(rows, spec, seed):
    rng = random.Random(seed)
    start = datetime(2025, 1, 20)
    data = [
        (rng.choice([0, 0, 0, 1, 2, 3]), rng.choice("AB"), start + timedelta(hours=rng.randrange(24 * 30)))
        for _ in range(300)
    ]
    return with_audit(rows(data, SCHEMA), spec)


def bag(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("spec", [CATALOG, SALE_LOG], ids=["states", "daily"])
@pytest.mark.parametrize("seed", [1, 2])
def test_staging_does_not_see_compaction(rows, spec, seed):
    raw = random_log(rows, spec, seed)
    small = compact(raw, spec)
    assert small.count() < raw.count()
    assert bag(staging_view(raw, spec)) == bag(staging_view(small, spec))
    assert bag(compact(small, spec)) == bag(small)


def test_order_and_partitioning_do_not_matter(rows):
    raw = random_log(rows, CATALOG, 7)
    assert bag(compact(raw, CATALOG)) == bag(compact(raw.repartition(1).orderBy("ver"), CATALOG))


def test_two_months_keep_two_rows(rows):
    raw = with_audit(
        rows([(1, "a", datetime(2025, 1, 31)), (1, "a", datetime(2025, 2, 1)), (1, "a", datetime(2025, 2, 3))], SCHEMA),
        CATALOG,
    )
    kept = sorted(r["last_update"] for r in compact(raw, CATALOG).collect())
    assert kept == [datetime(2025, 1, 31), datetime(2025, 2, 1)]
    assert staging_view(raw, CATALOG).count() == 1


@pytest.mark.parametrize("spec", [CATALOG, SALE_LOG], ids=["states", "daily"])
def test_repeated_append_adds_nothing(rows, spec):
    old, new = random_log(rows, spec, 11), random_log(rows, spec, 12)
    once = idempotent_append(compact(old, spec), new, spec)
    twice = idempotent_append(once, new, spec)
    assert bag(once) == bag(twice)
    assert unseen(new, once, spec).count() == 0


def test_unseen_reads_only_given_months(rows):
    batch = with_audit(rows([(1, "a", datetime(2025, 2, 1))], SCHEMA), CATALOG)
    target = with_audit(rows([(1, "a", datetime(2025, 1, 1))], SCHEMA), CATALOG)
    assert unseen(batch, target, CATALOG, [date(2025, 2, 1)]).count() == 1
    assert unseen(batch, batch, CATALOG, [date(2025, 2, 1)]).count() == 0


def test_added_column_reads_as_default(rows):
    columns = "appid long, packageid long, package_option_text string, package_price_with_discount long"
    old = rows([(1, 2, "t", 5)], columns)
    new = rows([(1, 2, "t", 5, "n")], columns + ", name string")
    both = add_column(old, new, PACKAGES.added_defaults)
    assert {r["name"] for r in both.collect()} == {"", "n"}
    assert with_audit(both, PACKAGES, datetime(2025, 1, 1)).select("row_hash").distinct().count() == 1
