"""The trips mart run by run against the full build over all pages so far."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_marts import route_text, seed_frame
from test_silver import LINE, T1, body, ping, poppy_trip, trip

from kerbside.operators.quality import QualityError
from kerbside.operators.upsert import read_mart
from kerbside.plans import trips, trips_state
from kerbside.schemas import TRIPS_MART
from kerbside.sources.bronze import append_pages, read_bronze

DAY = 86_400_000


def bolt_ping(trip_id, ms, lat):
    return {"trip_id": trip_id, "device_id": "b", "location": {"lat": lat, "lng": 4.3}, "timestamp": ms}


def named(device, vehicle):
    return {"device_id": device, "vehicle_id": vehicle, "vehicle_type": "bicycle"}


def loads():
    """Pages and corrections of four runs: pings, copies, registry entries and corrections that come after their trips."""
    return [
        ([("DOTT", "TRIPS", body(trips=[trip("t1", "a"), trip("t2", "b", start_time=T1 + 3 * DAY)])),
          ("VOI", "TRIPS", body(trips=[trip("v1", "c", route=LINE), trip("v2", "d")])), ("BOLT", "TRIPS", body(trips=[trip("b1", "e")])),
          ("VOI", "VEHICLES", body(vehicles=[named("c", "vc"), named("d", "vd")])), ("POPPY", "TRIPS", json.dumps([poppy_trip("p1")]))],
         []),
        ([("DOTT", "TELEMETRY", body(telemetry=[ping(T1 + 5 * DAY, 4.4), ping(T1, 4.4, trips=["gone"])])),
          ("BOLT", "TELEMETRY", body(telemetry=[bolt_ping("b1", T1, 50.8), bolt_ping("b1", T1, 50.8)]))],
         []),
        ([("DOTT", "TRIPS", body(trips=[trip("t1", "a", start_time=T1 + 9 * DAY), trip("t3", "a")])),
          ("DOTT", "VEHICLES", body(data={"vehicles": [named("b", "vb")]})), ("VOI", "VEHICLES", body(vehicles=[named("c", "va"), named("d", "vd")])),
          ("DOTT", "TELEMETRY", body(telemetry=[ping(T1 - 9 * DAY, 4.2)])),
          ("POPPY", "TRIPS", json.dumps([poppy_trip("p1", vehicle_id="other")]), "2024-01-02 00:00:00")],
         [("Bolt", "b1", "fixed", "moped")]),
        ([("VOI", "VEHICLES", body(vehicles=[named("x", "vx")]))], []),
    ]


def whole(spark, bronze, seeds):
    return rows(route_text(trips.all_trips(read_bronze(spark, bronze), seeds)), *TRIPS_MART)


def kept(spark, mart):
    return rows(route_text(read_mart(spark, mart)), *TRIPS_MART)


def test_equal_to_the_full_build_after_every_run(spark, page, tmp_path):
    bronze, mart, state = (f"{tmp_path}/{name}" for name in ("bronze", "mart", "state"))
    dates = []
    for run, (load, fixes) in enumerate(loads()):
        append_pages(page(*load), bronze)
        seeds = seed_frame(spark, *fixes)
        dates.append([str(d) for d in trips_state.build_trips_state(spark, bronze, mart, f"{tmp_path}/s{run}", state, seeds)])
        assert kept(spark, mart) == whole(spark, bronze, seeds)
        if run == 1:
            trips_state.compact(spark, state)
            assert [p.name for p in (tmp_path / "state/trips").glob("run=*")] == ["run=2"]
    # The third run moves t1 from one date to another; the last takes the correction back and touches b1 alone.
    first = str(spark.sql(f"SELECT to_date(timestamp_millis({T1}))").first()[0])
    later = str(spark.sql(f"SELECT to_date(timestamp_millis({T1 + 9 * DAY}))").first()[0])
    assert dates[1] == [first] and first in dates[2] and later in dates[2] and dates[3] == [first]
    # Nothing new: nothing is rewritten.
    assert trips_state.build_trips_state(spark, bronze, mart, f"{tmp_path}/s9", state, seeds) == []


def test_a_date_that_lost_its_last_trip_is_removed(spark, page, tmp_path):
    bronze, mart, state = (f"{tmp_path}/{name}" for name in ("bronze", "mart", "state"))
    for run, day in enumerate((0, 9)):
        append_pages(page(("DOTT", "TRIPS", body(trips=[trip("t1", "a", start_time=T1 + day * DAY)]))), bronze)
        trips_state.build_trips_state(spark, bronze, mart, f"{tmp_path}/s{run}", state)
    assert len(kept(spark, mart)) == 1 and len([p for p in (tmp_path / "mart").iterdir() if p.name.startswith("start_date=")]) == 1


def test_only_days_and_dates_of_touched_trips_are_opened(spark, page, tmp_path, monkeypatch):
    bronze, mart, state = (f"{tmp_path}/{name}" for name in ("bronze", "mart", "state"))
    many = [trip(f"t{day}", "a", start_time=T1 + day * DAY, end_time=T1 + day * DAY) for day in range(12)]
    append_pages(page(("DOTT", "TRIPS", body(trips=many)), ("DOTT", "TELEMETRY", body(telemetry=[ping(T1 + d * DAY, 4.0, trips=[f"t{d}"]) for d in range(12)]))), bronze)
    trips_state.build_trips_state(spark, bronze, mart, f"{tmp_path}/s0", state)
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "mart").glob("start_date=*")}
    asked = []
    keep = trips_state.in_values
    monkeypatch.setattr(trips_state, "in_values", lambda df, column, values: (asked.append((column, sorted(values))), keep(df, column, values))[1])
    append_pages(page(("DOTT", "TELEMETRY", body(telemetry=[ping(T1 + 4 * DAY + 1, 4.1, trips=["t4"])]))), bronze)
    trips_state.build_trips_state(spark, bronze, mart, f"{tmp_path}/s1", state)
    day = T1 // DAY + 4
    assert [values for column, values in asked if column == "day"] == [[day], [day]]
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "mart").glob("start_date=*")}
    assert len([name for name in after if before[name] != after[name]]) == 1 and len(after) == 12


def test_a_dead_run_is_repeated_and_lost_files_are_refused(spark, page, tmp_path, monkeypatch):
    bronze, mart, state = (f"{tmp_path}/{name}" for name in ("bronze", "mart", "state"))
    for run, (load, _) in enumerate(loads()[:2]):
        append_pages(page(*load), bronze)
        with monkeypatch.context() as broken:
            broken.setattr(trips_state.Log, "mark", lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):  # the mart is swapped, the run is not marked
                trips_state.build_trips_state(spark, bronze, mart, f"{tmp_path}/d{run}", state)
        trips_state.build_trips_state(spark, bronze, mart, f"{tmp_path}/s{run}", state)
        assert kept(spark, mart) == whole(spark, bronze, None)
    with pytest.raises(ValueError, match="no mart"):
        trips_state.build_trips_state(spark, bronze, f"{tmp_path}/other", f"{tmp_path}/s8", state)
    with pytest.raises(ValueError, match="folders of 1 days"):
        trips_state.build_trips_state(spark, bronze, mart, f"{tmp_path}/s7", state, width=7)
    append_pages(page(*loads()[0][0]), f"{tmp_path}/elsewhere")
    with pytest.raises(ValueError, match="are gone"):
        trips_state.build_trips_state(spark, f"{tmp_path}/elsewhere", mart, f"{tmp_path}/s9", state)


def test_a_trip_without_id_or_start_fails_the_run(spark, page, tmp_path):
    for name, bad, told in (("id", trip(None, "a"), "trip_id"), ("start", trip("t", "a", start_time=None), "START_TS")):
        append_pages(page(("DOTT", "TRIPS", body(trips=[bad]))), f"{tmp_path}/{name}")
        with pytest.raises(QualityError, match=told):
            trips_state.build_trips_state(spark, f"{tmp_path}/{name}", f"{tmp_path}/m{name}", f"{tmp_path}/s{name}", f"{tmp_path}/k{name}")


def test_days_of_wild_clocks(spark):
    ms = spark.createDataFrame([(None,), (-(2**62),), (T1,), (2**62,)], "ms long")
    assert [r[0] for r in ms.select(trips_state._day(F.col("ms"))).collect()] == [0, 0, T1 // DAY, 40_000]
    assert [r[0] for r in ms.select(trips_state._day(F.col("ms"), 7)).collect()] == [0, 0, T1 // DAY // 7 * 7, 39_998]
