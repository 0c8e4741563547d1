import random

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from kerbside.functions.clock import time_chunk
from kerbside.operators.latest import best_report, latest_per_key
from kerbside.operators.timeline import (
    change_intervals, change_points, is_change, lag_by, last_reports, lead_by, validity_intervals,
)

REPORT = "vehicle_id string, provider_name string, at string, vehicle_state string, event_type string, lat double, lon double, trip_id string"


def reports(spark, *data):
    raw = spark.createDataFrame([(v, "Voi", at, s, e, la, lo, t) for v, at, s, e, la, lo, t in data], REPORT)
    return raw.withColumn("reported_at", F.to_timestamp("at")).drop("at")


def test_latest_counts_a_missing_time_as_newest(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z"), ("b", None, "w"), (None, 1, "n"), (None, 3, "m")], "k string, ts int, v string"
    )
    assert rows(latest_per_key(df, ["k"], "ts"), "k", "v") == [("a", "y"), ("b", "w"), (None, "m")]


def test_latest_settles_ties_the_same_way_in_any_layout(spark):
    data = [("a", 1, v) for v in "dbca"]
    got = {
        latest_per_key(spark.createDataFrame(data, "k string, ts int, v string").repartition(n), ["k"], "ts").first().v
        for n in (1, 2, 7)
    }
    assert got == {"a"}


def test_best_report_prefers_trip_events(spark):
    df = reports(
        spark,
        ("v", "2024-01-01 10:00:00", "s1", "ping", 1.0, 1.0, None),
        ("v", "2024-01-01 10:00:00", "s2", "maintenance_pick_up", 1.0, 1.0, None),
        ("v", "2024-01-01 10:00:00", "s3", "user_drop_off", 1.0, 1.0, None),
        ("v", "2024-01-01 11:00:00", "s4", None, 1.0, 1.0, None),
    )
    assert rows(best_report(df), "vehicle_state") == [("s3",), ("s4",)]


def kept(spark, *steps):
    """Times of the reports kept among ``(state, event, lat, lon)`` steps one hour apart."""
    df = reports(
        spark, *[("v", f"2024-01-01 {i:02d}:00:00", s, e, la, lo, None) for i, (s, e, la, lo) in enumerate(steps)]
    )
    return [r.reported_at.hour for r in change_points(df).orderBy("reported_at").collect()]


def test_change_filter_is_three_valued(spark):
    assert kept(spark, ("a", "ping", 1.0, 1.0), ("a", "ping", 1.0, 1.0), ("b", "ping", 1.0, 1.0)) == [0, 2]
    # An unknown event type, an unknown state and an unknown place are no change by themselves.
    assert kept(spark, ("a", "ping", 1.0, 1.0), ("a", None, 1.0, 1.0)) == [0]
    assert kept(spark, ("a", "ping", 1.0, 1.0), (None, "ping", 1.0, 1.0)) == [0]
    assert kept(spark, ("a", "ping", 1.0, 1.0), ("a", "ping", None, 1.0)) == [0]
    # A missing state before is a change, and so is any telling event.
    assert kept(spark, (None, "ping", 1.0, 1.0), ("a", "ping", 1.0, 1.0)) == [0, 1]
    assert kept(spark, ("a", "ping", 1.0, 1.0), ("a", "trip_end", 1.0, 1.0)) == [0, 1]


def test_moves_are_measured_from_the_report_before_not_the_one_kept(spark):
    creeping = [("a", "ping", 1.0 + 0.0004 * i, 1.0) for i in range(6)]
    assert kept(spark, *creeping) == [0]
    assert kept(spark, ("a", "ping", 1.0, 1.0), ("a", "ping", 1.0006, 1.0), ("a", "ping", 1.0006, 1.0006)) == [0, 1, 2]
    # 0.5 and 0.5005 differ by exactly the limit in the spacing of doubles or less.
    assert kept(spark, ("a", "ping", 0.0, 1.0), ("a", "ping", 0.0005, 1.0)) == [0]


def random_history(spark, n=4000, seed=7, hot_share=3):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        vehicle = "hot" if i % hot_share == 0 else f"v{rnd.randrange(40)}"
        minute = rnd.randrange(60 * 24 * 12)
        at = None if rnd.random() < 0.003 else f"2024-01-{1 + minute // 1440:02d} {minute // 60 % 24:02d}:{minute % 60:02d}:00"
        data.append(
            (vehicle, at, rnd.choice(["a", "a", "a", "b", None]), rnd.choice(["ping", "ping", "telemetry", "trip_end", None]),
             rnd.choice([1.0, 1.0003, 1.001, None]), rnd.choice([2.0, 2.0, 2.1]), None)
        )
    return best_report(reports(spark, *data))


def plain_intervals(df):
    w = Window.partitionBy("vehicle_id", "provider_name").orderBy(F.col("reported_at").asc_nulls_last())
    prev = df.withColumn("prev", F.lag(F.struct("vehicle_state", "lat", "lon")).over(w))
    changed = prev.where(
        is_change(F.col("vehicle_state"), F.col("lat"), F.col("lon"), F.col("event_type"), F.col("prev"))
    ).drop("prev")
    return changed.withColumn("valid_to", F.lead("reported_at").over(w))


COLUMNS = ("vehicle_id", "reported_at", "vehicle_state", "event_type", "lat", "lon", "valid_to")


def test_chunked_intervals_equal_one_window_per_vehicle(spark):
    df = random_history(spark).cache()
    wanted = rows(plain_intervals(df), *COLUMNS)
    for seconds in (3600, 86_400, 7 * 86_400):
        assert rows(change_intervals(df, chunk_seconds=seconds), *COLUMNS) == wanted
    assert rows(validity_intervals(change_points(df).drop("prev")), *COLUMNS) == wanted


def test_history_only_sets_the_first_comparison(spark):
    df = random_history(spark, seed=11).where("reported_at IS NOT NULL").cache()
    cut = "2024-01-08 00:00:00"
    w = Window.partitionBy("vehicle_id", "provider_name").orderBy("reported_at")
    prev = df.withColumn("prev", F.lag(F.struct("vehicle_state", "lat", "lon")).over(w))
    sliced = prev.where(
        is_change(F.col("vehicle_state"), F.col("lat"), F.col("lon"), F.col("event_type"), F.col("prev"))
        & (F.col("reported_at") >= cut)
    )
    wanted = rows(sliced.withColumn("valid_to", F.lead("reported_at").over(w)), *COLUMNS)
    recent, earlier = df.where(F.col("reported_at") >= cut), df.where(F.col("reported_at") < cut)
    assert rows(change_intervals(recent, before=last_reports(earlier)), *COLUMNS) == wanted


def test_intervals_of_a_vehicle_chain(spark):
    got = change_intervals(random_history(spark, seed=3).where("reported_at IS NOT NULL"))
    by_vehicle = {}
    for r in got.orderBy("reported_at").collect():
        by_vehicle.setdefault(r.vehicle_id, []).append(r)
    for history in by_vehicle.values():
        assert [r.valid_to for r in history[:-1]] == [r.reported_at for r in history[1:]]
        assert history[-1].valid_to is None


def test_neighbours_across_chunks(spark):
    df = spark.createDataFrame(
        [("a", i, f"p{i}", None if i == 5 else i * i) for i in range(0, 40, 5)], "k string, s int, name string, v int"
    ).withColumn("ts", F.timestamp_seconds(F.col("s") * 3600))
    chunk = time_chunk(F.col("ts"), 86_400)
    w = Window.partitionBy("k").orderBy("ts", "name")
    lagged = lag_by(df, ["k"], ["ts", "name"], chunk, ["v"]).select("s", "prev.v")
    assert rows(lagged) == rows(df.select("s", F.lag("v").over(w)))
    led = lead_by(df, ["k"], ["ts", "name"], chunk, ["v"]).select("s", "next.v")
    assert rows(led) == rows(df.select("s", F.lead("v").over(w)))
