import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_silver import EVENT, LINE, T1, T2, body, ping, poppy_trip, registered, trip, ts

from kerbside.functions.lines import drop_repeats, line_end, line_start, point, stitch, straight_line
from kerbside.operators.latest import latest_per_key
from kerbside.operators.quality import QualityError
from kerbside.operators.upsert import read_mart
from kerbside.plans import build, silver, status, trips
from kerbside.schemas import SEED, STATUS_MART, TRIPS_MART
from kerbside.sources.bronze import append_pages, read_bronze
from workload import frames, pages

HOUR = 3_600_000


def seed_frame(spark, *data):
    return spark.createDataFrame(list(data), f"provider_name string, {SEED}")


def route_text(df):
    text = F.concat_ws(", ", F.transform("GEOM", lambda p: F.concat_ws(" ", p["lon"], p["lat"])))
    return df.withColumn("GEOM", F.when(F.col("GEOM").isNotNull(), text))


def test_routes_by_provider(spark, page):
    far = {"end_location": {"lat": 50.0, "lng": 3.0}}
    bronze = page(
        ("DOTT", "TRIPS", body(trips=[trip("d1", "x", **far), trip("d2", "x", route=LINE), trip("d3", "x", end_location=None), trip("d4", "x", **far)])),
        ("DOTT", "TELEMETRY", body(telemetry=[
            ping(T1 + 2, 3.0, trips=["d1"]), ping(T1 + 1, 2.0, trips=["d1"]), ping(T1 + 1, 2.0, trips=["d1"]),
            ping(T1, 2.0, trips=["d3"]), ping(T1, None, trips=["d4"]),
        ])),
        ("BOLT", "TRIPS", body(trips=[trip("b1", "x"), trip("b2", "x"), trip("b3", "x", end_location=None)])),
        ("BOLT", "TELEMETRY", body(telemetry=[
            {"trip_id": "b1", "timestamp": T1 + 1, "location": {"lat": 2.0, "lng": 2.0}},
            {"trip_id": "b1", "timestamp": T1, "location": {"lat": 1.0, "lng": 1.0}},
            {"trip_id": "b1", "timestamp": T1 + 1, "location": {"lat": 2.0, "lng": 2.0}},
            {"trip_id": "b3", "timestamp": T1, "location": {"lat": 9.0, "lng": 9.0}},
        ])),
        ("VOI", "TRIPS", body(trips=[trip("v1", "x", route=LINE), trip("v2", "x")])),
        ("POPPY", "TRIPS", json.dumps([poppy_trip("p1"), poppy_trip("p2", route=None)])),
    )
    got = rows(route_text(trips.all_trips(bronze)), "TRIP_ID", "GEOM", "START_LON", "END_LON")
    assert got == [
        ("b1", "1.0 1.0, 2.0 2.0, 2.0 2.0", 1.0, 2.0),  # repeated points stay
        ("b2", "4.35 50.84, 4.36 50.85", 4.35, 4.36),
        ("b3", "9.0 9.0", 9.0, 9.0),  # a single ping, no fallback
        ("d1", "4.35 50.84, 2.0 50.0, 3.0 50.0", 4.35, 3.0),  # stitched, repeated points removed
        ("d2", "4.35 50.84, 4.3 50.8, 4.36 50.85", 4.35, 4.36),
        ("d3", None, None, None),  # telemetry without an end point: no route and no fallback
        ("d4", "4.35 50.84, 3.0 50.0", 4.35, 3.0),  # telemetry without a position is none
        ("p1", "4.35 50.84, 4.3 50.8, 4.36 50.85", 4.35, 4.36),
        ("p2", None, None, None),
        ("v1", "4.35 50.84, 4.3 50.8, 4.36 50.85", 4.35, 4.36),
        ("v2", "4.35 50.84, 4.36 50.85", 4.35, 4.36),
    ]


def test_vehicles_and_corrections(spark, page):
    standing = [{"device_id": "s", "vehicle_id": "sv", "vehicle_type": "scooter_standing"}]
    bronze = page(
        ("BOLT", "VEHICLES", body(vehicles=standing)), ("BOLT", "TRIPS", body(trips=[trip("b1", "s"), trip("b2", "x")])),
        ("VOI", "VEHICLES", body(vehicles=[{"device_id": "d1", "vehicle_id": "a", "vehicle_type": "scooter"}])),
        ("VOI", "TRIPS", body(trips=[trip("v1", "d1"), trip("v2", "x"), trip("v3", "x")])),
        ("DOTT", "TRIPS", body(trips=[trip("d1", "x"), trip("d2", "x")])),
    )
    seeds = seed_frame(
        spark, ("Voi", "v1", "lost1", "bicycle"), ("Voi", "v2", "lost2", "bicycle"), ("Dott", "d1", "lost3", "kayak"),
        ("Voi", "d2", "not for this provider", "kayak"), ("Bolt", "b2", None, None),
    )
    assert rows(trips.all_trips(bronze, seeds), "TRIP_ID", "VEHICLE_ID", "VEHICLE_TYPE") == [
        ("b1", "sv", "scooter"), ("b2", "x", "scooter"), ("d1", "lost3", "bicycle"), ("d2", "x", "bicycle"),
        ("v1", "lost1", "scooter"), ("v2", "lost2", "bicycle"), ("v3", None, None),
    ]


def test_newest_record_per_trip_across_providers(page):
    bronze = page(
        ("VOI", "TRIPS", body(trips=[trip("t1", "a"), trip("t1", "b", start_time=T2, duration=1), trip(None, "c"), trip(None, "d")])),
        ("DOTT", "TRIPS", body(trips=[trip("t1", "e"), trip("t2", "f"), trip("t2", "g", start_time=None)])),
    )
    got = trips.all_trips(bronze)
    assert list(got.columns) == list(TRIPS_MART)
    assert rows(got.withColumn("TRIP_DURATION", F.col("TRIP_DURATION").cast("int")), "TRIP_ID", "PROVIDER_NAME", "TRIP_DURATION") == [
        ("t1", "Voi", 1), ("t2", "Dott", 600), (None, "Voi", 600),
    ]
    assert got.where("TRIP_ID = 't2'").first().START_TS is None


def naive_trips(bronze, seeds):
    """The mart put together from the silver views, in the order the mart is defined."""
    voi, dott, bolt, poppy = (f(bronze) for f in (silver.voi_trips, silver.dott_trips, silver.bolt_trips, silver.poppy_trips))
    start, end = point(F.col("start_lon"), F.col("start_lat")), point(F.col("end_lon"), F.col("end_lat"))

    def patched(df, provider):
        side = seeds.where(F.col("provider_name") == provider).select(
            F.col("TRIP_ID").alias("trip_id"), F.col("VEHICLE_ID").alias("sv"), F.col("VEHICLE_TYPE").alias("st")
        )
        return df.join(side, "trip_id", "left")

    def shaped(df, kind, route, duration="trip_duration", distance="trip_distance_meters", start_ts="start_ts", end_ts="end_ts"):
        return df.select(
            "trip_id", F.coalesce("sv", "vehicle_short_id").alias("vehicle_id"), kind.alias("vehicle_type"), "provider_name",
            F.col(start_ts).alias("start_ts"), F.col(end_ts).alias("end_ts"), F.col(duration).cast("decimal(38,9)").alias("trip_duration"),
            F.col(distance).alias("trip_distance"), route.alias("route"),
        )

    tel = silver.dott_telemetry(bronze)
    dott_route = drop_repeats(
        F.when(F.col("telemetry_route_geom").isNotNull(), stitch(start, F.col("telemetry_route_geom"), end)).otherwise(F.col("route_geom"))
    )
    from kerbside.operators.routes import line_agg

    pings = silver.bolt_telemetry(bronze).withColumn("ping_ms", F.unix_millis("reported_at"))
    bolt_route = F.coalesce(F.col("line"), straight_line(start, end))
    kind = F.col("vehicle_type")
    whole = (
        shaped(patched(voi, "Voi"), F.coalesce("vehicle_type", "st"), F.col("route_geom"))
        .unionByName(shaped(patched(dott, "Dott").join(tel, "trip_id", "left"), kind, dott_route))
        .unionByName(
            shaped(
                patched(bolt, "Bolt").join(line_agg(pings, ["trip_id"]), "trip_id", "left"),
                F.when(kind == "scooter_standing", "scooter").otherwise(kind), bolt_route,
                "duration", "distance", "started_at", "ended_at",
            )
        )
        .unionByName(shaped(patched(poppy, "Poppy"), kind, F.col("route_geom")))
    )
    newest = latest_per_key(whole, ["trip_id"], "start_ts", ties=["vehicle_id"])
    return newest.select(
        "trip_id", "vehicle_id", "vehicle_type", "provider_name", "start_ts", "end_ts", "trip_duration", "trip_distance",
        line_start(F.col("route"))["lat"], line_start(F.col("route"))["lon"], line_end(F.col("route"))["lat"], line_end(F.col("route"))["lon"],
        F.size("route"),
    )


def test_trips_mart_equals_the_views_put_together(spark, sf_dir):
    bronze, seeds = pages.bronze(spark, sf_dir), frames.seeds(spark, sf_dir)
    mart = trips.all_trips(bronze, seeds).drop("ROUTE").withColumn("GEOM", F.size("GEOM"))
    assert rows(mart) == rows(naive_trips(bronze, seeds))


def event(device, at, state, kind, lat=50.84, **more):
    return {**EVENT, "device_id": device, "timestamp": at, "vehicle_state": state, "event_types": [kind], "location": {"lat": lat, "lng": 4.35}, **more}


def test_status_mart(page):
    bronze = page(
        registered("VOI", lambda v: body(vehicles=v)),
        ("VOI", "EVENTS", body(events=[
            event("d1", T1, "available", "ping"), event("D9", T1, "available", "ping"), event("D9", T1 + HOUR, "available", "ping"),
            event("D9", T1 + 2 * HOUR, "on_trip", "trip_start"), event("D9", T1 + 2 * HOUR, "broken", "maintenance_pick_up"),
            event(None, T1, "available", "ping"),
        ])),
        ("POPPY", "TRIPS", json.dumps([poppy_trip("p1")])),
    )
    got = ts(status.vehicles_status(bronze), "VALID_FROM_TS", "VALID_TO_TS")
    assert list(got.columns) == list(STATUS_MART)
    assert rows(got, "UID", "VEHICLE_ID", "VEHICLE_TYPE", "VEHICLE_STATE", "TRIP_ID", "VALID_TO_TS") == [
        ("a_20240415_100000123", "a", "bicycle", "available", "t1", None),
        ("b_20240415_100000123", "b", "aerial", "available", "t1", None),  # registered twice
        ("d9_20240415_100000123", "D9", "bicycle", "available", "t1", "2024-04-15 12:00:00.123"),
        ("d9_20240415_120000123", "D9", "bicycle", "on_trip", "t1", None),
        ("p1_20240415_100000123", "p1", "car", "reserved", "p1", "2024-04-15 10:10:00"),
        ("p1_20240415_101000000", "p1", "car", "available", "p1", None),
    ]
    squashed = status.vehicles_status(bronze, squash=True)
    assert rows(squashed.where("PROVIDER_NAME = 'Voi'"), "VEHICLE_ID").count(("b",)) == 1
    assert rows(squashed, "VEHICLE_ID").count(("a",)) == 0


DAY = 24 * HOUR


def test_incremental_status_run(spark, page, tmp_path):
    first = page(("VOI", "EVENTS", body(events=[event("v", T1, "available", "ping"), event("w", T1, "available", "ping")])))
    mart = str(tmp_path / "mart")
    build.build_status(spark, first, mart, str(tmp_path / "s1"))
    later = page(
        ("VOI", "EVENTS", body(events=[event("v", T1, "available", "ping"), event("w", T1, "available", "ping")])),
        ("VOI", "EVENTS", body(events=[
            event("v", T1 + HOUR, "on_trip", "trip_start"), event("v", T1 + 2 * DAY, "available", "trip_end"),
            event("w", T1 - 3 * DAY, "old", "trip_end"),  # too late to reach the mart
        ])),
    )
    build.build_status(spark, later, mart, str(tmp_path / "s2"))
    second = rows(ts(read_mart(spark, mart), "VALID_TO_TS"), "UID", "VALID_TO_TS")
    assert second == [
        ("v_20240415_100000123", "2024-04-15 11:00:00.123"), ("v_20240415_110000123", "2024-04-17 10:00:00.123"),
        ("v_20240417_100000123", None), ("w_20240415_100000123", None),
    ]
    # The same batch again changes nothing but what lies in the slice: stored ends before it stay.
    build.build_status(spark, later, mart, str(tmp_path / "s3"))
    assert rows(ts(read_mart(spark, mart), "VALID_TO_TS"), "UID", "VALID_TO_TS") == second


def test_empty_target_means_full_load(spark, page):
    bronze = page(("VOI", "EVENTS", body(events=[event("v", T1, "available", "ping")])))
    empty = status.vehicles_status(bronze).where("false")
    assert rows(status.vehicles_status(bronze, empty), "UID") == [("v_20240415_100000123",)]


def test_trips_build_upserts_and_stops_on_faults(spark, page, tmp_path):
    mart = str(tmp_path / "trips")
    build.build_trips(spark, page(("DOTT", "TRIPS", body(trips=[trip("t1", "a"), trip("t2", "b")]))), mart, str(tmp_path / "s1"), buckets=4)
    newer = page(("DOTT", "TRIPS", body(trips=[trip("t2", "c", start_time=T2), trip("t3", "d")])))
    for run in ("s2", "s3"):
        build.build_trips(spark, newer, mart, str(tmp_path / run), buckets=4)
        assert rows(read_mart(spark, mart), "TRIP_ID", "VEHICLE_ID") == [("t1", "a"), ("t2", "c"), ("t3", "d")]
    with pytest.raises(QualityError, match="START_TS"):
        build.build_trips(spark, page(("DOTT", "TRIPS", body(trips=[trip("t4", "a", start_time=None)]))), mart, str(tmp_path / "s4"), buckets=4)
    assert rows(read_mart(spark, mart), "TRIP_ID") == [("t1",), ("t2",), ("t3",)]


def test_whole_build_from_stored_bronze(spark, page, tmp_path):
    bronze, gold = str(tmp_path / "bronze"), str(tmp_path / "gold")
    append_pages(
        page(
            ("DOTT", "TRIPS", body(trips=[trip("t1", "a")])), ("DOTT", "EVENTS", body(data={"status_changes": []})),
            ("BOLT", "EVENTS", body(events=[event("v", T1, "available", "ping")])),
        ),
        bronze,
    )
    build.build_all(spark, bronze, gold, str(tmp_path / "stage1"))
    assert spark.sql("SELECT TRIP_ID FROM fct_all_trips").first()[0] == "t1"
    assert spark.sql("SELECT count(*) FROM stg_dott_trips").first()[0] == 1
    append_pages(
        page(
            ("BOLT", "EVENTS", body(events=[event("v", T1 + HOUR, "on_trip", "trip_start")]), "2024-01-01 05:00:00"),
            ("BOLT", "EVENTS", body(events=[event("v", T1 + 2 * HOUR, "available", "trip_end")]), "2024-01-02 00:00:00"),
            ("POPPY", "FREE_BIKE_STATUS", body(data={"bikes": [{"bike_id": "p", "vehicle_type_id": "x", "last_reported": T1 // 1000}]}), "2024-01-02 00:00:00"),
        ),
        bronze,
    )
    build.build_all(spark, bronze, gold, str(tmp_path / "stage2"))
    got = rows(spark.table("fct_vehicles_status"), "UID", "VEHICLE_TYPE", "VEHICLE_STATE")
    assert got == [
        ("p_20240415_100000000", "car", "available"), ("v_20240415_100000123", "scooter", "available"),
        ("v_20240415_110000123", "scooter", "on_trip"), ("v_20240415_120000123", "scooter", "available"),
    ]
    # Parsed pages that were kept between runs give the same mart as parsing everything again.
    assert rows(status.vehicles_status(read_bronze(spark, bronze)), "UID", "VEHICLE_TYPE", "VEHICLE_STATE") == got
    assert spark.read.parquet(f"{gold}/parsed_reports").count() == 4


def test_stored_pages_follow_registries_types_and_trips(spark, page, tmp_path):
    bronze, store = str(tmp_path / "bronze"), str(tmp_path / "store")
    batches = (
        [registered("VOI", lambda v: body(vehicles=v)), ("VOI", "EVENTS", body(events=[event("d1", T1, "available", "ping")]))],
        [("POPPY", "TRIPS", json.dumps([poppy_trip("p1")]), "2024-01-05 00:00:00")],
        [(*registered("BOLT", lambda v: body(vehicles=v)), "2024-01-03 00:00:00"), ("BOLT", "EVENTS", body(events=[event("d1", T1, "available", "ping")]), "2024-01-05 00:00:00")],
    )
    for batch in batches:
        append_pages(page(*batch), bronze)
        landed = read_bronze(spark, bronze)
        stored, fresh = build.refresh(spark, landed, store), status.parse_pages(landed, keep=("load_date",))
        for name, part in vars(fresh).items():
            columns = part.columns
            got, want = (sorted(map(str, df.select(columns).collect())) for df in (getattr(stored, name), part))
            assert got == want, name
    assert stored.trips.count() == 1 and stored.registry.count() > 2
