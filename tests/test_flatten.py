import json
from datetime import datetime

import pytest

from sightlog.operators import flatten
from sightlog.operators.validate import VIOLATIONS, validate
from sightlog.tables import CARDS, PACKAGES, PRICES, SNAPSHOTS

FULL = {
    "name": "Game", "required_age": "18", "is_free": False, "supported_languages": "en",
    "website": None, "pc_requirements": {"minimum": "8 GB"}, "mac_requirements": [],
    "linux_requirements": {"recommended": "x"}, "developers": ["d1", "d2"],
    "categories": [{"id": 2, "description": "Single"}, {"id": 9, "description": "Co-op"}],
    "genres": [{"id": "1", "description": "Action"}],
    "release_date": {"date": "Nov 3, 2025"},
    "price_overview": {"currency": "USD", "initial": 999, "final": 499, "discount_percent": 50},
    "package_groups": [
        {"subs": [{"packageid": 5, "option_text": "Std", "price_in_cents_with_discount": 499},
                  {"packageid": 6, "option_text": None}]},
        {"subs": []}, {}, {"subs": None}, {"subs": [{"packageid": 7}]},
    ],
}


@pytest.fixture()
def parse(rows):
    def run(*payloads):
        data = [
            (i + 1, p if p is None or isinstance(p, str) else json.dumps({str(i + 1): p}))
            for i, p in enumerate(payloads)
        ]
        return flatten.parse_cards(rows(data, "appid long, payload string"))

    return run


def card(parse, payload):
    return validate(flatten.card_rows(parse(payload)), CARDS).first()


def test_full_card(parse):
    row = card(parse, {"success": True, "data": FULL})
    assert row["success"] is True and row["appid"] == 1 and row["name"] == "Game"
    assert row["required_age"] == 18 and row["is_free"] is False
    assert row["pc_requirements"] == "8 GB"
    assert row["mac_requirements"] == "" and row["linux_requirements"] == ""
    assert row["website"] is None
    assert row["developers"] == ["d1", "d2"] and row["publishers"] == []
    assert row["categories_id"] == [2, 9] and row["categories_description"] == ["Single", "Co-op"]
    assert row["genres_id"] == ["1"] and row["genres_description"] == ["Action"]
    assert row["release_date"] == datetime(2025, 11, 3)
    assert row[VIOLATIONS] == []


def test_missing_is_not_null(parse):
    row = card(parse, {"success": True, "data": {"name": None, "pc_requirements": {"minimum": None}}})
    assert row["name"] is None and row["pc_requirements"] is None
    assert row["website"] == "" and row["supported_languages"] == ""
    assert row["required_age"] is None and row["is_free"] is None and row["release_date"] is None


@pytest.mark.parametrize(
    "payload", [None, "{bad", "[]", "{}", '{"2": {"success": true}}', {"success": False}, [], {},
                {"success": False, "data": None}],
)
def test_failed_responses_give_one_failed_card(parse, payload):
    parsed = parse(payload)
    got = validate(flatten.card_rows(parsed), CARDS).collect()
    assert len(got) == 1
    assert got[0]["success"] is False and got[0]["name"] == "" and got[0][VIOLATIONS] == []
    assert got[0]["developers"] == [] and got[0]["categories_id"] == []
    assert flatten.price_rows(parsed).count() == flatten.package_rows(parsed).count() == 0


def test_null_success_breaks_a_rule(parse):
    assert card(parse, {"success": None})[VIOLATIONS] == ["success:required"]


def test_blank_age_and_odd_age(parse):
    assert card(parse, {"success": True, "data": {"required_age": " "}})["required_age"] is None
    assert card(parse, {"success": True, "data": {"required_age": 17.0}})["required_age"] == 17
    assert card(parse, {"success": True, "data": {"required_age": "18+"}})[VIOLATIONS] == ["required_age:type"]
    assert card(parse, {"success": True, "data": {"required_age": -1}})[VIOLATIONS] == ["required_age:ge"]


def test_prices(parse):
    parsed = parse({"success": True, "data": FULL}, {"success": True, "data": {"name": "Free"}},
                   {"success": True, "data": {"name": None, "price_overview": {"currency": " "}}})
    got = {r["appid"]: r for r in validate(flatten.price_rows(parsed), PRICES).collect()}
    assert tuple(got[1])[:6] == (1, "Game", "USD", 999, 499, 50)
    assert tuple(got[2])[:6] == (2, "Free", None, None, None, None)
    assert got[3]["currency"] is None and got[3][VIOLATIONS] == ["name:required"]


def test_packages(parse):
    parsed = parse({"success": True, "data": FULL},
                   {"success": True, "data": {"name": "x", "package_groups": []}},
                   {"success": True, "data": {"name": "y"}},
                   {"success": True, "data": {"package_groups": [{"subs": [{"option_text": "q"}]}]}})
    got = validate(flatten.package_rows(parsed), PACKAGES).collect()
    by_id = {r["packageid"]: r for r in got}
    assert sorted(k for k in by_id if k) == [5, 6, 7]
    assert by_id[5]["package_price_with_discount"] == 499 and by_id[5]["name"] == "Game"
    assert by_id[6]["package_option_text"] is None and by_id[7]["package_option_text"] == ""
    assert by_id[None][VIOLATIONS] == ["packageid:required"]
    assert len(got) == 4


@pytest.mark.parametrize("pick", [flatten.price_rows, flatten.package_rows, flatten.card_rows])
def test_json_is_parsed_once(parse, pick):
    plan = pick(parse({"success": True}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_landing_columns_are_carried(rows):
    df = rows([(1, "{}", "run-1")], "appid long, payload string, run string")
    assert flatten.card_rows(flatten.parse_cards(df)).first()["run"] == "run-1"


def test_search(rows):
    page = {"total_count": 3, "items": [
        {"name": "A", "logo": "https://x/apps/10/h.jpg"}, {"name": None, "logo": "https://x/apps/11/h.jpg"},
        {"logo": "https://x/apps/12/h.jpg"}, {"name": "Bundle", "logo": "https://x/bundles/3/h.jpg"},
        {"name": "No link"},
    ]}
    df = rows([(json.dumps(page),), ('{"items": null}',), ("{}",), (None,)], "payload string")
    assert sorted(map(tuple, flatten.search_rows(df).collect())) == [(10, "A"), (11, ""), (12, "")]
    dropped = flatten.search_items(df).where("appid IS NULL")
    assert sorted(r["name"] for r in dropped.collect()) == ["Bundle", "No link"]


def test_keyed_pages(rows):
    pages = [
        json.dumps({"5": {"appid": 5, "name": "A", "price": "1.5", "ccu": "", "other": 1}, "6": {"name": "B", "score_rank": " "}}),
        "{}", None,
    ]
    df = rows([(p,) for p in pages], "payload string")
    got = {r["appid"]: r for r in validate(flatten.keyed_rows(df, SNAPSHOTS), SNAPSHOTS).collect()}
    assert sorted(got) == [5, 6]
    assert got[5]["price"] == 1.5 and got[5]["ccu"] is None and got[6]["score_rank"] is None
    assert all(r[VIOLATIONS] == [] for r in got.values())


@pytest.mark.parametrize(
    ("data", "label"),
    [
        ({"name": 5}, "name:type"),
        ({"developers": "abc"}, "developers:type"),
        ({"categories": {"id": 1}}, "categories:type"),
        ({"genres": [{"id": 1, "description": "x"}]}, "genres_id:type"),
        ({"price_overview": "x"}, "price_overview:type"),
        ({"package_groups": "y"}, "package_groups:type"),
        ({"package_groups": [{"subs": {"packageid": 1}}]}, "package_groups:type"),
        ({"website": {"a": 1}}, "website:type"),
        ({"supported_languages": [1, 2]}, "supported_languages:type"),
        ({"linux_requirements": ["x"]}, "linux_requirements:type"),
        ({"release_date": {"date": 2020}}, "release_date:type"),
        ({"required_age": [18]}, "required_age:type"),
    ],
)
def test_wrong_shapes_stop_the_load(parse, tmp_path, data, label):
    from sightlog.operators.validate import ValidationError
    from sightlog.sources import staged

    parsed = parse({"success": True, "data": {"name": "n", **data}})
    assert card(parse, {"success": True, "data": {"name": "n", **data}})[VIOLATIONS] == [label]
    with pytest.raises(ValidationError) as broken:
        staged.stage(flatten.card_rows(parsed), CARDS, str(tmp_path / "cards"))
    assert broken.value.counts == {label: 1}


def test_blank_shapes_are_defaults(parse):
    blank = {"categories": "", "genres": None, "price_overview": [], "package_groups": 0,
             "pc_requirements": [], "release_date": False}
    assert card(parse, {"success": True, "data": blank})[VIOLATIONS] == []
    assert card(parse, {"success": False, "data": []})[VIOLATIONS] == []
    assert card(parse, [])[VIOLATIONS] == []
    assert card(parse, '{"1": "text"}')[VIOLATIONS] == ["response:type"]


def test_wrong_name_breaks_price_and_package_rows(parse):
    parsed = parse({"success": True, "data": {"name": 5, "package_groups": [{"subs": [{"packageid": 1}]}]}})
    assert validate(flatten.price_rows(parsed), PRICES).first()[VIOLATIONS] == ["name:type"]
    assert validate(flatten.package_rows(parsed), PACKAGES).first()[VIOLATIONS] == ["name:type"]
