"""Shaping of decoded entities to curated rows."""

import pytest

import make
from headway.feeds import registry
from headway.operators.rows import conform
from headway.sources import snapshots

PLACE = {"date": "2025-12-04", "hour": "12"}


@pytest.fixture(scope="module")
def shape(spark):
    def run(feed, *entities):
        spec = registry()[feed]
        raw = spark.createDataFrame(
            [(*PLACE.values(), make.payload(*entities))], "date string, hour string, content binary"
        )
        shaped = spec.shape(snapshots.entities_of(snapshots.decode(raw, spec)))
        assert shaped.columns == ["date", "hour", *spec.schema.names]
        rows = conform(shaped, spec.schema, ("date", "hour")).collect()
        return [row.asDict(recursive=True) for row in rows]

    return run


def test_vehicle_maps_every_field(shape):
    [row] = shape("vehicle_positions", make.vehicle("tram"))
    body = make.vehicle()["vehicle"]
    plain = {k: v for k, v in body.items() if k not in ("trip", "vehicle", "position")}
    assert row == {
        **PLACE, "header_timestamp": make.HEADER_TIME, "entity_id": "tram", **make.TRIP,
        "vehicle_id": "unit-8", "vehicle_label": "Eight", "license_plate": "KX208",
        **make.POSITION, **plain,
    }


def test_bare_vehicle_is_one_row_of_nulls(shape):
    [row] = shape("vehicle_positions", {"id": "bare"})
    filled = {k: v for k, v in row.items() if v is not None}
    assert filled == {
        **PLACE, "entity_id": "bare", "header_timestamp": make.HEADER_TIME, "multi_carriage_details": []
    }


def test_empty_text_is_null_only_for_entity_and_carriage_names(shape):
    carriage = {"id": "", "label": "", "carriage_sequence": 0}
    entity = make.vehicle("", stop_id="", vehicle={"id": ""}, multi_carriage_details=[carriage, {}])
    [row] = shape("vehicle_positions", entity)
    assert [row[c] for c in ("entity_id", "stop_id", "vehicle_id", "vehicle_label")] == [None, "", "", None]
    named, bare = row["multi_carriage_details"]
    assert [named[c] for c in ("id", "label", "carriage_sequence")] == [None, None, 0]
    assert not any(v is not None for v in bare.values())


def test_trip_has_a_row_per_stop_with_the_trip_on_each(shape):
    rows = shape("trip_updates", make.trip("run", n_stops=4))
    own = ("stop_sequence", "stop_id", "arrival_delay", "departure_delay")
    assert [tuple(r.pop(c) for c in own) for r in rows] == [
        (3, "quay-0", -7, 15), (7, "quay-1", -8, 16), (11, "quay-2", -9, 17), (15, "quay-3", -10, 18)
    ]
    for row in rows:
        assert row == {
            **PLACE, "header_timestamp": make.HEADER_TIME, "entity_id": "run", **make.TRIP,
            "vehicle_id": "unit-8", "vehicle_label": "Eight", "timestamp": make.TRIP_TIME, "delay": -42,
            "arrival_time": make.ARRIVAL, "departure_time": make.DEPARTURE,
            "departure_occupancy_status": 7, "stop_schedule_relationship": 3,
        }


@pytest.mark.parametrize("entity", [make.trip("run", n_stops=0), {"id": "run"}])
def test_trip_without_stops_keeps_one_row(shape, entity):
    [row] = shape("trip_updates", entity)
    assert row["entity_id"] == "run"
    of_stops = registry()["trip_updates"].schema.names[-8:]
    assert of_stops[0] == "stop_sequence"
    assert all(row[c] is None for c in of_stops)


def test_stop_times_need_both_message_and_field(shape):
    stops = [{"stop_id": "s", "departure": {"time": 0}}]
    [row] = shape("trip_updates", {"id": "x", "trip_update": {"trip": {}, "stop_time_update": stops}})
    times = ("arrival_delay", "arrival_time", "departure_delay", "departure_time")
    assert [row[c] for c in times] == [None, None, None, 0]


def test_alert_has_a_row_per_informed_entity(shape):
    rows = shape("service_alerts", make.alert("works", n_informed=3))
    names = ("agency_id", "route_id", "trip_id", "stop_id")
    assert [tuple(r.pop(c) for c in names) for r in rows] == [
        (f"operator-{n}", f"line-{n}", f"run-{n}", f"pier-{n}") for n in range(3)
    ]
    for row in rows:
        assert row == {
            **PLACE, "header_timestamp": make.HEADER_TIME, "entity_id": "works", "cause": 10,
            "effect": 9, "severity_level": 4, "header_text": "Track works",
            "description_text": "No trams beyond the quay", "url": "https://trams.example/works",
            "active_period": make.alert()["alert"]["active_period"], "route_type": 5, "direction_id": 1,
        }


def test_alert_without_informed_entity_keeps_one_row(shape):
    [row] = shape("service_alerts", {"id": "works", "alert": {"url": make.text(("u", None))}})
    filled = {k: v for k, v in row.items() if v is not None}
    assert filled == {
        **PLACE, "entity_id": "works", "header_timestamp": make.HEADER_TIME, "url": "u", "active_period": []
    }


def test_selector_direction_is_its_own_and_trip_needs_its_id(shape):
    informed = [{"direction_id": 0, "trip": {"trip_id": ""}}, {"trip": {"direction_id": 1}}]
    rows = shape("service_alerts", {"id": "x", "alert": {"informed_entity": informed}})
    assert [(r["trip_id"], r["direction_id"]) for r in rows] == [("", 0), (None, None)]


@pytest.mark.parametrize(
    "translations, want",
    [
        ([("Gleis", "de"), ("Platform", None)], "Platform"),
        ([("Gleis", "de"), ("Platform", "")], "Platform"),
        ([("Gleis", "de"), ("Binario", "it")], "Gleis"),
        ([("", ""), ("Gleis", "de")], ""),
        ([("Gleis", "de"), ("", None)], ""),
        ([("first", ""), ("second", None)], "first"),
        ([], None),
    ],
)
def test_first_text(shape, translations, want):
    [row] = shape("service_alerts", {"id": "x", "alert": {"description_text": make.text(*translations)}})
    assert row["description_text"] == want


def test_entities_of_all_kinds_become_rows(shape):
    rows = shape("trip_updates", make.alert("a"), make.trip("t", 1), make.vehicle("v"))
    assert [(r["entity_id"], r["trip_id"]) for r in rows] == [
        ("a", None), ("t", make.TRIP["trip_id"]), ("v", None)
    ]
