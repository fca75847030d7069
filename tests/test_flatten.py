import json

import pytest

from siltstone.operators import flatten
from tests.helpers import RUN_TS, dicts, events

HEAD = {"event_id": "evt", "ingested_at": "2026-05-17T12:00:00+00:00"}


def offer_rows(spark, data, **head):
    document = {**HEAD, **head, "payload": {"data": data}}
    return dicts(flatten.flatten_offers(events(spark, document), RUN_TS), "offer_id")


def test_every_field_of_an_offer_arrives(spark):
    """Two offers that differ in each field."""
    green = dict(offerId="green", devName="Lamp", finalPrice=12.5, regularPrice=40, giftable=False,
                 refundable=True, inDate="2031-02-03", outDate="2031-02-09", layout=dict(id="left"))
    red = dict(offerId="red", devName="Chair", finalPrice=99, regularPrice=99.5, giftable=True,
               refundable=False, inDate="2031-03-01", outDate="2031-03-02", layout=dict(id="right"))
    rows = offer_rows(spark, {"date": "2031-02-04", "entries": [red, green]}, event_id="night-run")
    names = ("offer_id", "dev_name", "final_price", "regular_price", "giftable", "refundable",
             "in_date", "out_date", "layout_id")
    assert [tuple(r[c] for c in names) for r in rows] == [
        tuple(o[c] for c in ("offerId", "devName")) + (float(o["finalPrice"]), float(o["regularPrice"]))
        + tuple(o[c] for c in ("giftable", "refundable", "inDate", "outDate")) + (o["layout"]["id"],)
        for o in (green, red)
    ]
    assert {(r["snapshot_date"], r["source_event_id"]) for r in rows} == {("2031-02-04", "night-run")}


@pytest.mark.parametrize(
    "offer",
    [{"devName": "no id"}, {"offerId": ""}, {"offerId": 0, "offer_id": None}, "text", 7, None],
)
def test_entries_without_an_id_are_dropped(spark, offer):
    assert offer_rows(spark, {"entries": [offer]}) == []


def test_falsy_values_fall_through_the_aliases(spark):
    rows = offer_rows(
        spark,
        {"featured": [
            {"offerId": "a", "finalPrice": 0},
            {"offerId": "b", "finalPrice": 0, "final_price": 7, "devName": "", "dev_name": "d"},
            {"offer_id": "c", "finalPrice": "0", "regularPrice": "x", "regular_price": 5},
            {"offer_id": 12, "finalPrice": True, "layout": "L"},
        ]},
        event_time="2026-05-18T01:00:00Z",
    )
    found = {r["offer_id"]: r for r in rows}
    assert found["a"]["final_price"] is None
    assert found["b"]["final_price"] == 7.0 and found["b"]["dev_name"] == "d"
    # The text "0" is truthy and a number; "x" is truthy and none.
    assert found["c"]["final_price"] == 0.0 and found["c"]["regular_price"] is None
    assert found["12"]["final_price"] == 1.0 and found["12"]["layout_id"] == "L"
    assert found["a"]["snapshot_date"] == "2026-05-18"


def test_first_list_of_objects_in_document_order(spark):
    data = {"entries": [], "words": ["x"], "zz": [{"offerId": "z"}], "aa": [{"offerId": "a"}]}
    assert [r["offer_id"] for r in offer_rows(spark, data)] == ["z"]


def test_events_that_hold_no_offers(spark):
    documents = [
        {**HEAD, "payload": []}, {**HEAD, "payload": None}, HEAD, "bad json", "[1]",
        {**HEAD, "payload": {"data": [{"offerId": "x"}]}},
    ]
    assert flatten.flatten_offers(events(spark, *documents), RUN_TS).count() == 0


def test_missing_event_time_gives_no_snapshot(spark):
    (row,) = offer_rows(spark, {"daily": [{"offerId": "a", "layout": {"name": "n"}}]})
    assert row["snapshot_date"] is None and row["layout_id"] == "n"


def catalog_row(spark, record, **payload):
    document = {**HEAD, "payload": payload or {"data": [record]}}
    (row,) = dicts(flatten.flatten_catalog(events(spark, document), RUN_TS))
    return row


def test_every_field_of_a_catalog_record_arrives(spark):
    record = {name: {"value": f"{name} of it"} for name in ("rarity", "type", "set")}
    row = catalog_row(spark, record | {"id": "lamp-7", "name": "Lamp", "description": "It shines.",
                                       "introduction": {"text": "Came with winter"}})
    assert {k: row[k] for k in ("catalog_id", "name", "description", "rarity", "type", "set_name", "introduction_text")} == {
        "catalog_id": "lamp-7", "name": "Lamp", "description": "It shines.", "rarity": "rarity of it",
        "type": "type of it", "set_name": "set of it", "introduction_text": "Came with winter"}


def test_catalog_odd_shapes(spark):
    row = catalog_row(spark, None, data={"k": {"cosmeticId": 5, "rarity": "epic", "introduction": "S1"}, "n": 3})
    assert (row["catalog_id"], row["rarity"], row["introduction_text"]) == ("5", "epic", "S1")
    row = catalog_row(spark, {"id": "x", "rarity": {"name": "Rare", "value": None}, "set": {}, "introduction": 4})
    assert (row["rarity"], row["set_name"], row["introduction_text"]) == ("Rare", None, None)
    row = catalog_row(spark, {"id": "x", "type": {"other": 1}, "introduction": {"text": "", "backendValue": "B"}})
    assert json.loads(row["type"]) == {"other": 1} and row["introduction_text"] == "B"


def test_entities_with_and_without_a_code(spark):
    full = {"code": "77-88", "title": "Harbour", "creatorCode": "mo", "displayName": "The harbour",
            "category": "boats", "createdIn": "3.1", "tags": ["water", "calm"]}
    bare = {"displayName": "Hill", "tags": "wind", "category": {"id": 12}}
    document = {**HEAD, "payload": {"data": [{"title": "nameless"}, bare, "text", full]}}
    found = {r["entity_id"]: r for r in dicts(flatten.flatten_entities(events(spark, document), RUN_TS))}
    assert set(found) == {"77-88", "Hill"}
    harbour, hill = found["77-88"], found["Hill"]
    assert (harbour["creator_code"], harbour["created_in"], json.loads(harbour["tags"])) == ("mo", "3.1", ["water", "calm"])
    assert (hill["tags"], hill["category"], hill["title"]) == ("wind", "12", None)
    keyed = {**HEAD, "payload": {"data": {"first": full}}}
    assert flatten.flatten_entities(events(spark, keyed), RUN_TS).isEmpty()


def metric_rows(spark, payload, event_id="corr:E-1"):
    document = {"event_id": event_id, "event_time": "2026-05-17", "payload": payload}
    rows = dicts(flatten.flatten_metrics(events(spark, document), RUN_TS))
    return sorted(
        (r["entity_id"], r["metric_name"], r["metric_timestamp"], r["metric_value"] is None, r["metric_value"])
        for r in rows
    )


def test_every_point_of_every_metric_is_a_row(spark):
    series = {name: [(f"moment {i}", i * 1.5 if i % 3 else None) for i in range(n)] for name, n in (("plays", 4), ("peakCCU", 2))}
    payload = {"interval": "hour"} | {
        name: {"data": [{"timestamp": t, "value": v} for t, v in points]} for name, points in series.items()
    }
    assert metric_rows(spark, payload, "night:HARBOUR") == sorted(
        ("HARBOUR", name, t, v is None, v) for name, points in series.items() for t, v in points
    )


@pytest.mark.parametrize(
    "payload, expected",
    [
        ({"plays": {"data": {"T": 7}}}, [("T", 7.0)]),
        ({"plays": {"data": {"k": {"time": "t", "count": 5}}}}, [("t", 5.0)]),
        ({"plays": {"data": {"k": {"value": None, "count": 5}}}}, [("k", None)]),
        ({"plays": {"data": {"k": None}}}, [("k", None)]),
        ({"plays": [{"timestamp": "t", "value": 1}]}, [("t", 1.0)]),
        ({"plays": [{"timestamp": "t", "value": None, "count": 3}]}, [("t", None)]),
        ({"plays": [{"timestamp": "", "time": "u", "count": "3"}]}, [("u", 3.0)]),
        ({"plays": [{"value": 1}, 5, "x"]}, []),
        ({"plays": {"value": 3}}, []),
        ({"plays": None}, []),
        ({"other": 1}, []),
        ({"plays": None, "metrics": {"plays": [{"time": "t", "value": 2}]}}, [("t", 2.0)]),
        ({"metrics": {"plays": [{"time": "t", "value": 2}]}}, [("t", 2.0)]),
    ],
)
def test_metric_bodies(spark, payload, expected):
    assert [(r[2], r[4]) for r in metric_rows(spark, payload)] == expected


def test_names_from_the_metrics_map_prefer_a_body_beside_it(spark):
    payload = {"metrics": {"x": [{"time": "inner", "value": 1}]}, "x": [{"time": "outer", "value": 2}]}
    assert metric_rows(spark, payload) == [("E-1", "x", "outer", False, 2.0)]


def test_entity_comes_from_the_payload_or_the_event_id(spark):
    body = {"plays": [{"time": "t", "value": 1}]}
    assert metric_rows(spark, {"code": "C", **body})[0][0] == "C"
    assert metric_rows(spark, {"island_code": "I", "code": "C", **body})[0][0] == "I"
    assert metric_rows(spark, body, "a:b:c")[0][0] == "c"
    assert metric_rows(spark, body, "no-colon") == []
