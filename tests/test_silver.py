import json

from conftest import rows
from pyspark.sql import functions as F

from kerbside.plans import silver

T1, T2 = 1713175200123, 1713175800000  # 2024-04-15 10:00:00.123 and 10:10:00


def body(**content):
    return json.dumps(content)


def ts(df, *names):
    return df.withColumns({n: F.col(n).cast("string") for n in names})


def geom(df, name):
    return df.withColumn(name, F.transform(name, lambda p: F.concat_ws(" ", p["lon"], p["lat"]))).withColumn(
        name, F.when(F.col(name).isNotNull(), F.concat_ws(", ", name))
    )


VEHICLES = [
    {"device_id": "d1", "vehicle_id": "ab12", "vehicle_type": "bicycle"},
    {"device_id": "d2", "vehicle_id": "x1"},
    None,
]


def test_registries(page):
    bronze = page(
        ("VOI", "VEHICLES", body(vehicles=VEHICLES)), ("VOI", "VEHICLES", body(vehicles=VEHICLES)),
        ("DOTT", "VEHICLES", body(data={"vehicles": VEHICLES})), ("DOTT", "VEHICLES", body(vehicles=[{"device_id": "no"}])),
        ("BOLT", "VEHICLES", body(data={"vehicles": VEHICLES[:1]})), ("BOLT", "VEHICLES", body(vehicles=VEHICLES[1:])),
        ("POPPY", "VEHICLE_TYPES", body(data={"vehicle_types": [{"vehicle_type_id": "vt1", "form_factor": "car"}]})),
    )
    assert rows(silver.voi_vehicles(bronze)) == [("d1", "ab12", "bicycle"), ("d2", "x1", None)]
    assert rows(silver.dott_vehicles(bronze)) == [("d1", "ab12", "bicycle"), ("d2", "x1", None)]
    assert rows(silver.bolt_vehicles(bronze)) == [("d1", "ab12", "bicycle"), ("d2", "x1", "scooter")]
    assert rows(silver.poppy_vehicles(bronze)) == [("vt1", "car")]


def trip(trip_id, device, **more):
    return {
        "trip_id": trip_id, "device_id": device, "start_time": T1, "end_time": T2, "duration": 600, "distance": 1520.5,
        "start_location": {"lat": 50.84, "lng": 4.35}, "end_location": {"lat": 50.85, "lng": 4.36}, **more,
    }


LINE = {"type": "LineString", "coordinates": [[4.35, 50.84], [4.3, 50.8], [4.36, 50.85]]}
STRAIGHT, DELIVERED = "4.35 50.84, 4.36 50.85", "4.35 50.84, 4.3 50.8, 4.36 50.85"


def registered(provider, wrap):
    twice = [
        {"device_id": "d1", "vehicle_id": "a", "vehicle_type": "bicycle"},
        {"device_id": "d1", "vehicle_id": "b", "vehicle_type": "aerial"},
    ]
    return (provider, "VEHICLES", wrap(twice))


def test_voi_trips(page):
    bronze = page(
        registered("VOI", lambda v: body(vehicles=v)),
        ("VOI", "TRIPS", body(trips=[
            trip("t1", "d1", route=LINE), trip("t2", "d9"), trip("t2", "d9"), trip("t3", "d9", end_location=None),
            trip("t4", "d9", route={"type": "Point", "coordinates": [4.3, 50.8]}), trip("t5", "d9", end_location={"lat": 1.0}),
        ])),
    )
    got = geom(silver.voi_trips(bronze), "route_geom")
    assert rows(got, "trip_id", "vehicle_short_id", "vehicle_type", "route_geom") == [
        ("t1", "a", "bicycle", DELIVERED), ("t1", "b", "aerial", DELIVERED), ("t2", None, None, STRAIGHT),
        # t4 was delivered with a point: no route, instead of one that nobody drove
        ("t3", None, None, None), ("t4", None, None, None), ("t5", None, None, None),
    ]
    one = ts(got, "start_ts", "end_ts").where("trip_id = 't2'").first()
    assert (one.start_ts, one.end_ts) == ("2024-04-15 10:00:00.123", "2024-04-15 10:10:00")
    assert (float(one.trip_duration), one.trip_distance_meters, one.start_lat, one.end_lon) == (600.0, 1520.5, 50.84, 4.36)


def test_dott_trips_squash_the_registry(page):
    bronze = page(
        registered("DOTT", lambda v: body(data={"vehicles": v})),
        ("DOTT", "TRIPS", body(trips=[trip("t1", "d1", route=LINE), trip("t2", "d9")])),
    )
    got = geom(silver.dott_trips(bronze), "route_geom")
    # The greatest id and the greatest type may come from different registry rows.
    assert rows(got, "trip_id", "vehicle_short_id", "vehicle_type", "route_geom") == [
        ("t1", "b", "bicycle", DELIVERED), ("t2", "d9", "bicycle", STRAIGHT),
    ]


def test_bolt_trips(page):
    bronze = page(
        registered("BOLT", lambda v: body(vehicles=v)),
        ("BOLT", "TRIPS", body(trips=[trip("t1", "d1")], data={"trips": [trip("no", "d1")]})),
        ("BOLT", "TRIPS", body(data={"trips": [trip("t2", "d9")]})),
    )
    got = silver.bolt_trips(bronze)
    assert rows(got, "trip_id", "vehicle_short_id", "vehicle_type", "duration") == [
        ("t1", "a", "bicycle", 600), ("t1", "b", "aerial", 600), ("t2", "d9", "scooter", 600),
    ]


def poppy_trip(trip_id, **more):
    return {
        "trip_id": trip_id, "vehicle_id": "p1", "vehicle_type": "car", "start_time": T1, "end_time": T2,
        "trip_duration": 600, "trip_distance": 1520.5, "route": {"features": [{"geometry": LINE}]}, **more,
    }


def test_poppy_trips_keep_the_newest_delivery(page):
    bronze = page(
        ("POPPY", "TRIPS", json.dumps([poppy_trip("t1"), poppy_trip("t2", route={"features": []})]), "2024-04-16 03:00:00"),
        ("POPPY", "TRIPS", json.dumps([poppy_trip("t1", vehicle_id="p9")]), "2024-04-17 03:00:00"),
        ("POPPY", "TRIPS", json.dumps([poppy_trip("t1", vehicle_id="p5")]), "2024-04-15 03:00:00"),
    )
    got = geom(silver.poppy_trips(bronze), "route_geom")
    assert rows(got, "trip_id", "vehicle_short_id", "start_lat", "start_lon", "end_lat", "end_lon", "route_geom") == [
        ("t1", "p9", 50.84, 4.35, 50.85, 4.36, DELIVERED), ("t2", "p1", None, None, None, None, None),
    ]


EVENT = {
    "device_id": "d1", "event_types": ["trip_start", "other"], "vehicle_state": "on_trip", "trip_ids": ["t1"],
    "location": {"lat": 50.84, "lng": 4.35}, "timestamp": T1,
}


def test_events_and_their_empty_arrays(page):
    bare = {**EVENT, "event_types": [], "trip_ids": []}
    missing = {"device_id": "d1", "timestamp": T1}
    content = [body(events=[EVENT, EVENT, bare]), body(data={"events": [missing, EVENT]}), body(nothing=1)]
    bronze = page(*[(p, "EVENTS", c) for p in ("VOI", "BOLT") for c in content])
    columns = ("device_id", "event_type", "vehicle_state", "trip_id", "lat", "lon")
    once = [
        ("d1", "trip_start", "on_trip", "t1", 50.84, 4.35), ("d1", None, "on_trip", None, 50.84, 4.35), ("d1", None, None, None, None, None),
    ]
    assert rows(silver.voi_events(bronze), *columns) == sorted(once, key=repr)
    # Bolt events are not made distinct.
    assert rows(silver.bolt_events(bronze), *columns) == sorted(once + [once[0]] * 2, key=repr)


CHANGE = {
    "device_id": "d1", "vehicle_id": "x1", "vehicle_type": "scooter", "event_types": ["trip_end"], "vehicle_state": "available",
    "trip_id": "t1", "event_location": {"geometry": {"coordinates": [4.35, 50.84]}}, "battery_pct": 0.5, "event_time": T1,
}


def test_status_changes(page):
    bronze = page(
        ("DOTT", "EVENTS", body(data={"status_changes": [CHANGE, CHANGE]})), ("DOTT", "EVENTS", body(status_changes=[CHANGE])),
        ("BOLT", "STATUS_CHANGES", body(data={"status_changes": [CHANGE]})), ("BOLT", "STATUS_CHANGES", body(status_changes=[CHANGE])),
    )
    dott = rows(silver.dott_events(bronze), "vehicle_short_id", "event_type", "lat", "lon", "battery_percent", "provider_name")
    assert dott == [("x1", "trip_end", 50.84, 4.35, 50.0, "Dott")]
    bolt = rows(silver.bolt_status_changes(bronze), "vehicle_id", "event_type", "lat", "lon", "trip_id")
    assert bolt == [("x1", "trip_end", 50.84, 4.35, "t1")] * 2


def test_voi_snapshots_fan_out_with_the_registry(page):
    snapshot = {
        "device_id": "d1", "last_event": {"vehicle_state": "available", "event_types": ["trip_end"], "trip_ids": ["t1"]},
        "last_telemetry": {"location": {"lat": 50.84, "lng": 4.35}, "timestamp": T1},
    }
    bronze = page(
        registered("VOI", lambda v: body(vehicles=v)),
        ("VOI", "VEHICLES_STATUS", body(vehicles_status=[snapshot, {**snapshot, "device_id": "d9"}, None])),
    )
    assert rows(silver.voi_vehicles_status(bronze), "vehicle_short_id", "device_id", "event_type", "lat") == [
        ("a", "d1", "trip_end", 50.84), ("b", "d1", "trip_end", 50.84), (None, "d9", "trip_end", 50.84),
    ]


def test_dott_snapshots_of_both_formats(page):
    new = {
        "device_id": "d1",
        "last_event": {"vehicle_state": "available", "event_types": ["trip_end"], "trip_ids": ["t1"], "location": {"lat": 1.5, "lng": 2.5}},
        "last_telemetry": {"location": {"lat": 50.84, "lng": 4.35}},
    }
    no_telemetry = {**new, "device_id": "d2", "last_telemetry": None}
    old = {
        "device_id": "d3", "vehicle_type": "moped", "last_vehicle_state": "reserved", "last_event_types": [], "last_event_time": T2,
        "current_location": {"geometry": {"coordinates": [4.35, 50.84]}, "properties": {"timestamp": T1}},
    }
    by_event = {**old, "device_id": "d4", "current_location": {"geometry": {"coordinates": [4.35, 50.84]}}}
    bronze = page(
        ("DOTT", "VEHICLES_STATUS", body(last_updated=T2, vehicles=[new, no_telemetry])),
        ("DOTT", "VEHICLES_STATUS", body(last_updated=1, data={"vehicles": [old, by_event]})),
    )
    got = ts(silver.dott_vehicles_status(bronze), "reported_at")
    assert rows(got, "device_id", "vehicle_type", "vehicle_state", "event_type", "trip_id", "lat", "lon", "reported_at") == [
        ("d1", "scooter", "available", "trip_end", "t1", 50.84, 4.35, "2024-04-15 10:10:00"),
        ("d2", "scooter", "available", "trip_end", "t1", 1.5, 2.5, "2024-04-15 10:10:00"),
        ("d3", "moped", "reserved", "telemetry", None, 50.84, 4.35, "2024-04-15 10:00:00.123"),
        ("d4", "moped", "reserved", "telemetry", None, 50.84, 4.35, "2024-04-15 10:10:00"),
    ]


def test_poppy_snapshots_fall_back_for_time_and_type(page):
    bike = {"bike_id": "p1", "vehicle_type_id": "vt1", "lat": 50.84, "lon": 4.35}
    bronze = page(
        ("POPPY", "VEHICLE_TYPES", body(data={"vehicle_types": [{"vehicle_type_id": "vt1", "form_factor": "van"}]})),
        ("POPPY", "FREE_BIKE_STATUS", body(last_updated=1713175200, data={"bikes": [{**bike, "last_reported": 1713175190}, {**bike, "bike_id": "p2", "vehicle_type_id": "no"}]})),
        ("POPPY", "FREE_BIKE_STATUS", body(data={"bikes": [{**bike, "bike_id": "p3"}]}), "2024-04-15 12:00:00", "2024-04-15 11:00:00"),
    )
    got = ts(silver.poppy_vehicles_status(bronze), "reported_at")
    assert rows(got, "device_id", "vehicle_id", "vehicle_type", "vehicle_state", "event_type", "trip_id", "reported_at") == [
        ("p1", "p1", "van", "available", "unspecified", None, "2024-04-15 09:59:50"),
        ("p2", "p2", "car", "available", "unspecified", None, "2024-04-15 10:00:00"),
        ("p3", "p3", "van", "available", "unspecified", None, "2024-04-15 11:00:00"),
    ]


def ping(at, lon, lat=50.0, trips=("t1",)):
    return {"device_id": "d1", "timestamp": at, "location": {"lat": lat, "lng": lon}, "trip_ids": list(trips)}


def test_dott_telemetry_lines(page):
    hour = 3_600_000
    bronze = page(
        ("DOTT", "TELEMETRY", body(telemetry=[ping(T1 + 2 * hour, 3.0), ping(T1, 1.0), ping(T1, 1.0), ping(T1 + 5, 2.0, trips=())])),
        ("DOTT", "TELEMETRY", body(telemetry=[ping(T1 + hour, 2.0), ping(T1 + 1, None), ping(T1, None, trips=["t2"]), ping(T1, 9.0, trips=["t3"])])),
    )
    got = geom(silver.dott_telemetry(bronze), "telemetry_route_geom")
    assert rows(got) == [("t1", "1.0 50.0, 1.0 50.0, 2.0 50.0, 3.0 50.0"), ("t2", None), ("t3", "9.0 50.0")]


def test_bolt_telemetry_needs_a_latitude(page):
    def bolt(at, lat, lon):
        return {"trip_id": "t1", "device_id": "d1", "timestamp": at, "location": {"lat": lat, "lng": lon}}

    bronze = page(
        ("BOLT", "TELEMETRY", body(telemetry=[bolt(T1, 1.0, 2.0), bolt(T1, 1.0, 2.0), bolt(T1, None, 2.0)])),
        ("BOLT", "TELEMETRY", body(data={"telemetry": [bolt(T1, 3.0, None)]})),
    )
    assert rows(silver.bolt_telemetry(bronze), "lat", "lon") == [(1.0, 2.0), (1.0, 2.0), (3.0, None)]


def test_bad_values_become_null_on_request(page):
    bronze = page(("VOI", "EVENTS", body(events=[{**EVENT, "timestamp": "soon"}])))
    got = silver.voi_events(bronze, strict=False).first()
    assert got.reported_at is None and got.device_id == "d1"


def test_views_are_registered_under_their_names(spark, page):
    silver.register_views(spark, page(("VOI", "VEHICLES", body(vehicles=VEHICLES))))
    assert spark.sql("SELECT count(*) FROM stg_voi_vehicles").first()[0] == 2
    assert len(silver.VIEWS) == 17
    for name in silver.VIEWS:
        assert spark.table(name).columns
