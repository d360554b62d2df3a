import json
from datetime import date, datetime

import pytest

from sightlog.operators.pages import PageError
from sightlog.operators.quality import CheckError
from sightlog.plans import store
from sightlog.plans.queue import QueueError
from sightlog.sources.warehouse import Warehouse
from sightlog.tables import ALL_TABLES, CARDS, CATALOG, METRICS, PACKAGES, PRICES, SALE_LOG, SNAPSHOTS

SUNDAY, MONDAY = datetime(2025, 11, 9, 0, 30), datetime(2025, 11, 10, 0, 30)


@pytest.fixture()
def wh(spark):
    warehouse = Warehouse(spark)
    for spec in ALL_TABLES:
        warehouse.create_databases([spec.schema])
        warehouse.drop(spec)
    warehouse.deploy(ALL_TABLES)
    return warehouse


def pages(rows, *items):
    links = [{"name": n, "logo": f"https://x/apps/{i}/h.jpg"} for i, n in items]
    return rows([(json.dumps({"total_count": len(links), "items": links}),)], "payload string")


def cards(rows, *entries):
    data = [(i, p if p is None else json.dumps({str(i): p})) for i, p in entries]
    return rows(data, "appid long, payload string")


def good(name, **data):
    return {"success": True, "data": {"name": name, **data}}


def test_days_of_loads(wh, rows, spark, tmp_path):
    run = str(tmp_path / "run")
    store.load_search(wh, pages(rows, (1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e")), run, SUNDAY, "daily", now=SUNDAY)
    store.load_search(wh, pages(rows, (2, "b"), (3, "c")), run, SUNDAY, "sales", SALE_LOG, now=SUNDAY)
    store.load_cards(
        wh,
        cards(rows, (1, good("a", release_date={"date": "Nov 3, 2025"}, package_groups=[{"subs": [{"packageid": 9}]}])),
              (3, {"success": False}), (4, good("d")), (6, None)),
        run, SUNDAY, "cards", now=SUNDAY,
    )
    keyed = rows([(json.dumps({"1": {"name": "a", "price": "1.0"}}),)], "payload string")
    store.load_snapshots(wh, keyed, run, SUNDAY, "snapshots", now=SUNDAY)
    sizes = {s.name: wh.read(s).count() for s in ALL_TABLES}
    assert sizes == {"catalog": 5, "sale_log": 2, "cards": 4, "prices": 2, "packages": 1,
                     "snapshots": 1, "load_metrics": 1 + 1 + 1 + 4 + 2}
    assert not (tmp_path / "run" / "cards").exists()

    # same day: 2 is new on sale, 5 was never fetched, and nothing is retried after a load
    views = store.build_views(wh, SUNDAY.date(), now=SUNDAY)
    assert sorted(r["appid"] for r in spark.table("fetch_queue").collect()) == [2, 5]
    # read a day later the failed and undated cards come back; 3 is on sale but its card failed
    views = store.build_views(wh, SUNDAY.date(), now=MONDAY)
    store.export(views, str(tmp_path / "queue"))
    assert [r["appid"] for r in spark.read.parquet(str(tmp_path / "queue")).collect()] == [2, 3, 4, 5, 6]
    assert spark.sql("SELECT count(*) FROM stg_packages WHERE appid = 1").first()[0] == 1

    outcomes = store.check_tables(wh, views, date(2025, 11, 10))
    assert len(outcomes) == 10 and {o.status for o in outcomes} == {"pass"}
    late = store.check_tables(wh, views, date(2025, 11, 12))
    assert spark.table("dbt_dq.stg_snapshots_is_fresh").count() == 1
    assert [o.name for o in late if o.status != "pass"] == ["stg_snapshots_is_fresh"]


def test_reload_of_a_day_is_invisible(wh, rows, tmp_path):
    for _ in range(2):
        store.load_search(wh, pages(rows, (1, "a"), (2, "b")), str(tmp_path / "r"), SUNDAY, "daily", now=SUNDAY)
    assert wh.read(CATALOG).count() == 4
    assert store.build_views(wh)["catalog"].count() == 2
    wh.compact(CATALOG)
    assert wh.read(CATALOG).count() == 2


def test_histories_are_kept_apart(wh, rows, tmp_path):
    run = str(tmp_path / "r")
    store.load_search(wh, pages(rows, *[(i, "n") for i in range(10)]), run, SUNDAY, "weekly", now=SUNDAY)
    store.load_search(wh, pages(rows, (1, "n")), run, MONDAY, "daily", now=MONDAY)
    assert wh.read(METRICS).count() == 2
    with pytest.raises(CheckError):
        store.load_search(wh, pages(rows, (1, "n")), run, MONDAY, "weekly", now=MONDAY)


def test_one_drifting_table_does_not_hold_back_the_others(wh, rows, tmp_path):
    run = str(tmp_path / "r")
    price = {"currency": "USD", "initial": 100, "final": 100, "discount_percent": 0}
    store.load_cards(wh, cards(rows, (1, good("a", price_overview=price)), (2, good("b"))), run, SUNDAY, "c", now=SUNDAY)
    price["final"] = 10
    with pytest.raises(ExceptionGroup) as refused:
        store.load_cards(wh, cards(rows, (1, good("a", price_overview=price)), (2, good("b"))), run, MONDAY, "c", now=MONDAY)
    assert refused.group_contains(CheckError, match="price_final") and len(refused.value.exceptions) == 1
    assert [wh.read(s).count() for s in (CARDS, PRICES, PACKAGES)] == [4, 2, 0]
    assert (tmp_path / "r" / "prices").exists() and not (tmp_path / "r" / "cards").exists()
    assert wh.read(SNAPSHOTS).count() == 0


def test_pages_need_a_total(wh, rows, tmp_path):
    with pytest.raises(PageError):
        store.load_search(wh, rows([('{"items": []}',)], "payload string"), str(tmp_path), SUNDAY, "d")


def test_a_crawl_may_go_without_the_check(wh, rows, tmp_path):
    run = str(tmp_path / "r")
    store.load_search(wh, pages(rows, *[(i, "n") for i in range(10)]), run, SUNDAY, "weekly", now=SUNDAY)
    store.load_search(wh, pages(rows, (1, "n")), run, MONDAY, "weekly", now=MONDAY, check=None)
    assert wh.read(CATALOG).count() == 11 and wh.read(METRICS).count() == 1


def test_search_loads_report_what_is_missing(wh, rows, tmp_path):
    items = [{"name": "a", "logo": "/apps/1/"}, {"name": "b", "logo": "/subs/2/"}]
    landed = rows([(0, json.dumps({"total_count": 350, "items": items})), (200, json.dumps({"total_count": 350, "items": []}))],
                  "offset long, payload string")
    report = store.load_search(wh, landed, str(tmp_path / "r"), SUNDAY, "d", now=SUNDAY, page_rows=100)
    assert (report.missing_pages, report.dropped_items) == (2, 1)
    bounded = store.load_search(wh, landed, str(tmp_path / "r"), SUNDAY, "d", now=SUNDAY, page_rows=100, max_rows=200)
    assert bounded.missing_pages == 1


@pytest.mark.parametrize("ids", [[], [3, 0], [-1]])
def test_a_queue_that_cannot_be_worked_off(rows, tmp_path, ids):
    queue = rows([(i,) for i in ids], "appid long")
    with pytest.raises(QueueError):
        store.export({store.QUEUE_VIEW: queue}, str(tmp_path / "q"))
