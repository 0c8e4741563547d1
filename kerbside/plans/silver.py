"""The silver views, one per provider feed.

Each takes the bronze table and gives one typed frame. ``strict=False`` turns values that do not fit
their type into NULL instead of failing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.clock import ts_millis
from kerbside.functions.lines import delivered_line, from_geojson, point, straight_line
from kerbside.operators.enrich import squash_registry, with_registry, with_type_lookup
from kerbside.operators.latest import latest_per_key
from kerbside.operators.routes import line_agg
from kerbside.plans import feeds
from kerbside.sources.bronze import Bronze


def voi_vehicles(bronze: Bronze, strict: bool = True) -> DataFrame:
    return feeds.registry(bronze, "VOI").distinct()


def dott_vehicles(bronze: Bronze, strict: bool = True) -> DataFrame:
    return feeds.registry(bronze, "DOTT").distinct()


def bolt_vehicles(bronze: Bronze, strict: bool = True) -> DataFrame:
    return feeds.registry(bronze, "BOLT").distinct()


def poppy_vehicles(bronze: Bronze, strict: bool = True) -> DataFrame:
    return feeds.poppy_types(bronze).distinct()


def _ends() -> tuple[Column, Column]:
    return point(F.col("start_lon"), F.col("start_lat")), point(F.col("end_lon"), F.col("end_lat"))


def _trip_view(trips: DataFrame, vehicle: Column, kind: Column) -> DataFrame:
    return trips.select(
        "trip_id", vehicle.alias("vehicle_short_id"), kind.alias("vehicle_type"), "provider_name", "start_ts", "end_ts",
        "trip_duration", F.col("trip_distance").alias("trip_distance_meters"),
        "start_lat", "start_lon", "end_lat", "end_lon",
        delivered_line(F.col("route_json"), straight_line(*_ends())).alias("route_geom"),
    ).distinct()


def voi_trips(bronze: Bronze, strict: bool = True) -> DataFrame:
    """Voi trips; a trip of an unregistered device has no vehicle, one of a twice registered device comes twice."""
    joined = with_registry(feeds.mds_trips(bronze, "VOI", strict), voi_vehicles(bronze))
    return _trip_view(joined, F.col("reg_vehicle_id"), F.col("reg_vehicle_type"))


def dott_trips(bronze: Bronze, strict: bool = True) -> DataFrame:
    """Dott trips against one registry row per device."""
    joined = with_registry(feeds.mds_trips(bronze, "DOTT", strict), squash_registry(dott_vehicles(bronze)))
    return _trip_view(
        joined, F.coalesce("reg_vehicle_id", "device_id"), F.coalesce("reg_vehicle_type", F.lit("bicycle"))
    )


def bolt_trips(bronze: Bronze, strict: bool = True) -> DataFrame:
    """Bolt trips; they carry no route."""
    joined = with_registry(feeds.mds_trips(bronze, "BOLT", strict), bolt_vehicles(bronze))
    return joined.select(
        "trip_id",
        F.coalesce("reg_vehicle_id", "device_id").alias("vehicle_short_id"),
        F.coalesce("reg_vehicle_type", F.lit("scooter")).alias("vehicle_type"),
        "provider_name",
        F.col("start_ts").alias("started_at"),
        F.col("end_ts").alias("ended_at"),
        F.col("trip_duration").alias("duration"),
        F.col("trip_distance").alias("distance"),
        "start_lat", "start_lon", "end_lat", "end_lon",
    ).distinct()


def poppy_trips(bronze: Bronze, strict: bool = True) -> DataFrame:
    """The newest delivered copy of each Poppy trip."""
    newest = latest_per_key(feeds.poppy_trips(bronze, strict), ["trip_id"], "load_ts")
    return newest.select(
        "trip_id", F.col("vehicle_id").alias("vehicle_short_id"), "vehicle_type", "provider_name", "start_ts", "end_ts",
        "trip_duration", F.col("trip_distance").alias("trip_distance_meters"),
        "start_lat", "start_lon", "end_lat", "end_lon",
        from_geojson(F.col("route_json")).alias("route_geom"), "load_ts",
    )


def voi_events(bronze: Bronze, strict: bool = True) -> DataFrame:
    return feeds.mds_events(bronze, "VOI", strict).withColumn("provider_name", F.lit("Voi")).distinct()


def dott_events(bronze: Bronze, strict: bool = True) -> DataFrame:
    return (
        feeds.status_changes(bronze, "DOTT", "EVENTS", strict)
        .withColumnRenamed("vehicle_id", "vehicle_short_id")
        .withColumn("provider_name", F.lit("Dott"))
        .distinct()
    )


def bolt_events(bronze: Bronze, strict: bool = True) -> DataFrame:
    """Bolt events as delivered, repeated ones included."""
    return feeds.mds_events(bronze, "BOLT", strict)


def bolt_status_changes(bronze: Bronze, strict: bool = True) -> DataFrame:
    """Bolt status changes as delivered, repeated ones included."""
    return feeds.status_changes(bronze, "BOLT", "STATUS_CHANGES", strict).drop("battery_percent")


def voi_vehicles_status(bronze: Bronze, strict: bool = True) -> DataFrame:
    joined = with_registry(feeds.voi_status(bronze, strict), voi_vehicles(bronze))
    return joined.select(
        F.col("reg_vehicle_id").alias("vehicle_short_id"), F.col("reg_vehicle_type").alias("vehicle_type"), "device_id",
        "vehicle_state", "event_type", "trip_id", "lat", "lon", "reported_at",
    ).distinct()


def dott_vehicles_status(bronze: Bronze, strict: bool = True) -> DataFrame:
    joined = with_registry(feeds.dott_status(bronze, strict), dott_vehicles(bronze))
    return joined.select(
        F.coalesce("reg_vehicle_id", "device_id").alias("vehicle_short_id"),
        F.coalesce("reg_vehicle_type", "vehicle_type", F.lit("scooter")).alias("vehicle_type"),
        "device_id", "vehicle_state", "event_type", "trip_id", "lat", "lon", "reported_at",
        F.lit("Dott").alias("provider_name"),
    ).distinct()


def poppy_vehicles_status(bronze: Bronze, strict: bool = True) -> DataFrame:
    joined = with_type_lookup(feeds.poppy_bikes(bronze, strict), poppy_vehicles(bronze))
    return joined.select(
        "device_id", F.col("device_id").alias("vehicle_id"), "vehicle_type", F.lit("Poppy").alias("provider_name"),
        "vehicle_state", "event_type", "lat", "lon", "trip_id", "reported_at",
    ).distinct()


def dott_telemetry(bronze: Bronze, strict: bool = True) -> DataFrame:
    """One line per trip that Dott pings name; pings whose first trip is null belong to none."""
    return line_agg(feeds.dott_pings(bronze, strict).where(F.col("trip_id").isNotNull()), ["trip_id"], into="telemetry_route_geom")


def bolt_telemetry(bronze: Bronze, strict: bool = True) -> DataFrame:
    """Bolt pings as delivered, repeated ones included."""
    return feeds.bolt_pings(bronze, strict).select(
        "trip_id", "device_id", "lat", "lon", ts_millis(F.col("ping_ms"), strict).alias("reported_at")
    )


VIEWS: dict[str, Callable[..., DataFrame]] = {
    f"stg_{view.__name__}": view
    for view in (
        voi_vehicles, voi_trips, voi_events, voi_vehicles_status,
        dott_vehicles, dott_trips, dott_events, dott_vehicles_status, dott_telemetry,
        bolt_vehicles, bolt_trips, bolt_events, bolt_status_changes, bolt_telemetry,
        poppy_vehicles, poppy_trips, poppy_vehicles_status,
    )
}


def register_views(spark: SparkSession, bronze: Bronze, strict: bool = True) -> None:
    """Make every silver view available to SQL; nothing runs until it is queried."""
    for name, view in VIEWS.items():
        view(bronze, strict).createOrReplaceTempView(name)
