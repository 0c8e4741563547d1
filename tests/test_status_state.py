"""The status mart on a kept state against runs over the whole history."""

import json
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kerbside.operators.upsert import read_mart
from kerbside.plans import build, status, status_state
from kerbside.sources.bronze import append_pages, read_bronze

DAY = 86_400_000
T0 = 1_713_175_200_000


def event(device, kind, state, days, lat=50.84):
    return {"device_id": device, "event_types": [kind], "vehicle_state": state, "location": {"lat": lat, "lng": 4.35}, "timestamp": int(T0 + days * DAY)}


def events(*items):
    return ("VOI", "EVENTS", json.dumps({"events": list(items)}))


def registry(device, vehicle):
    return ("VOI", "VEHICLES", json.dumps({"vehicles": [{"device_id": device, "vehicle_id": vehicle, "vehicle_type": "bicycle"}]}))


def poppy(trip, start, end):
    line = {"type": "LineString", "coordinates": [[4.35, 50.84], [4.36, 50.85]]}
    one = {
        "trip_id": trip, "vehicle_id": "p1", "vehicle_type": "car", "start_time": int(T0 + start * DAY), "end_time": int(T0 + end * DAY),
        "trip_duration": 600, "trip_distance": 1.5, "route": {"features": [{"geometry": line}]},
    }
    return ("POPPY", "TRIPS", json.dumps([one]))


def loads():
    """Pages of four runs: reports in time, late for their slice, too late, a registry entry after its reports, trips delivered again."""
    return [
        [events(event("d1", "trip_start", "on_trip", 0), event("d1", "telemetry", "on_trip", 0.1), event("d2", "trip_end", "available", 3)),
         registry("d1", "v1"), poppy("t1", 0.5, 2.6), poppy("t2", 2.8, 2.9)],
        [events(event("d1", "trip_end", "available", 3.2), event("d2", "telemetry", "available", 3.5)), poppy("t2", 2.8, 3.1)],
        [events(event("d3", "telemetry", "available", 1.0), event("d3", "telemetry", "available", 3.4), event("d1", "telemetry", "reserved", 0.2),
                event("d2", "maintenance_pick_up", "non_operational", 4.8)), registry("d2", "v2"), registry("d3", "v3")],
        [events(event("d3", "telemetry", "available", 4.9), event("d1", "telemetry", "available", 5.0), event("d2", "trip_start", "on_trip", 5.1))],
    ]


def test_equal_to_runs_over_the_whole_history(spark, page, tmp_path):
    bronze, state = f"{tmp_path}/bronze", f"{tmp_path}/state"
    late = []
    for run, load in enumerate(loads()):
        # The third load is stamped with an earlier date than the second.
        stamp = f"2024-05-{10 + (run, run, 0.5, run)[run] * 2:02.0f} 00:00:00"
        append_pages(page(*[(*p, stamp) for p in load]), bronze)
        build.build_status(spark, read_bronze(spark, bronze), f"{tmp_path}/whole", f"{tmp_path}/w{run}")
        late.append(status_state.build_status_state(spark, bronze, f"{tmp_path}/kept", f"{tmp_path}/k{run}", state))
        whole, kept = (read_mart(spark, f"{tmp_path}/{name}") for name in ("whole", "kept"))
        assert rows(kept) == rows(whole.select(*kept.columns))
    assert late == [0, 0, 2, 0]
    assert kept.where("VEHICLE_ID = 'v2' AND VALID_FROM_TS > '2024-04-18'").count() > 0
    # Old reports are reduced to one of each device, and two versions are left.
    start = F.lit(status_state._newest(spark, state).start)
    held = spark.read.parquet(f"{state}/run=3/reports")
    assert held.where(F.col("reported_at") < start).groupBy("provider_name", "device_id").count().where("count > 1").count() == 0
    assert sorted(p.name for p in (tmp_path / "state").glob("run=*")) == ["run=2", "run=3"]
    # Nothing new: nothing changes.
    status_state.build_status_state(spark, bronze, f"{tmp_path}/kept", f"{tmp_path}/k9", state)
    assert rows(read_mart(spark, f"{tmp_path}/kept")) == rows(whole.select(*kept.columns))


def test_only_new_files_are_opened(spark, page, tmp_path, monkeypatch):
    bronze = f"{tmp_path}/bronze"
    opened = []
    parse = status_state.parse_pages
    monkeypatch.setattr(status_state, "parse_pages", lambda pages, strict: (opened.append(pages.inputFiles()), parse(pages, strict))[1])
    for run, load in enumerate(loads()[:2]):
        append_pages(page(*load), bronze)
        status_state.build_status_state(spark, bronze, f"{tmp_path}/mart", f"{tmp_path}/s{run}", f"{tmp_path}/state")
    assert not set(opened[0]) & set(opened[1]) and set(opened[0]) | set(opened[1]) == set(read_bronze(spark, bronze).inputFiles())


def test_a_mart_set_back_is_refused_and_a_dead_run_is_repeated(spark, page, tmp_path, monkeypatch):
    bronze, mart, state = (f"{tmp_path}/{name}" for name in ("bronze", "mart", "state"))
    append_pages(page(*loads()[0]), bronze)
    status_state.build_status_state(spark, bronze, mart, f"{tmp_path}/s0", state)
    append_pages(page(*loads()[1]), bronze)
    with monkeypatch.context() as broken:
        broken.setattr(status_state, "fold", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            status_state.build_status_state(spark, bronze, mart, f"{tmp_path}/s1", state)
    status_state.build_status_state(spark, bronze, mart, f"{tmp_path}/s2", state)
    for run, load in enumerate(loads()[:2]):
        append_pages(page(*load), f"{tmp_path}/again")
        build.build_status(spark, read_bronze(spark, f"{tmp_path}/again"), f"{tmp_path}/whole", f"{tmp_path}/w{run}")
    assert rows(read_mart(spark, mart)) == rows(read_mart(spark, f"{tmp_path}/whole"))
    with pytest.raises(ValueError, match="before the state"):
        status_state.build_status_state(spark, bronze, f"{tmp_path}/other", f"{tmp_path}/s3", state)


def test_pages_of_a_run_are_parsed_once(spark, page, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(kind):
        calls.add(1)
        return kind

    def fresh(load):
        parsed = status.parse_pages(page(*load))
        return replace(parsed, reports=parsed.reports.withColumn("event_type", told("event_type")))

    for run, load in enumerate(loads()[:3]):
        before = calls.value
        status_state.run_status(spark, fresh(load), f"{tmp_path}/mart", f"{tmp_path}/s{run}", f"{tmp_path}/state")
        assert calls.value - before == (3, 2, 4)[run]


def test_late_reports_are_those_of_all_reports(spark, page):
    bike = {"bike_id": "b", "lat": 50.8, "lon": 4.3}
    bikes = [{**bike, "vehicle_type_id": kind, "last_reported": T0 // 1000 + second} for second, kind in enumerate(["x", "x", "y", None, "z", "x"])]
    kinds = [{"vehicle_type_id": "x", "form_factor": form} for form in ("car", "van", "van")] + [{"vehicle_type_id": "y"}]
    parsed = status.parse_pages(page(
        *loads()[0], *loads()[1], ("POPPY", "FREE_BIKE_STATUS", json.dumps({"data": {"bikes": bikes}})),
        ("POPPY", "VEHICLE_TYPES", json.dumps({"data": {"vehicle_types": kinds}})),
    ))
    for days in (-1, 0, 0.00004, 2.7, 9):
        start = F.timestamp_millis(F.lit(int(T0 + days * DAY)))
        assert status_state.late_reports(parsed, start) == status.complete_reports(parsed).where(F.col("reported_at") < start).count()
