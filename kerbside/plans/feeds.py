"""Page items of every provider as typed rows, before any enrichment or duplicate removal.

Both layers are built on these feeds: the silver views add registry columns and DISTINCT, the marts
add their own reduction instead and so save the views' shuffles. ``keep`` names page columns to carry along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside import schemas as S
from kerbside.functions.clock import ts_millis, ts_seconds
from kerbside.functions.labels import battery_percent
from kerbside.functions.pages import convert, first_item, geojson_lat, geojson_lon, last_item, once, parse_items
from kerbside.schemas import ITEM_PATHS, typed_null
from kerbside.sources.bronze import Bronze, scan


def items(bronze: Bronze, provider: str, endpoint: str, schema: str, keep=(), root=()) -> DataFrame:
    return parse_items(scan(bronze, provider, endpoint), ITEM_PATHS[provider, endpoint], schema, keep, root)


def _get(path: str) -> Column:
    return F.col(f"item.{path}")


def _double(path: str, strict: bool) -> Column:
    return convert(_get(path), "double", strict)


def registry(bronze: Bronze, provider: str, keep=()) -> DataFrame:
    """``device_id, vehicle_id, vehicle_type``; Bolt leaves out the type of scooters."""
    kind = _get("vehicle_type")
    return items(bronze, provider, "VEHICLES", S.VEHICLE, keep).select(
        *keep,
        _get("device_id").alias("device_id"),
        _get("vehicle_id").alias("vehicle_id"),
        (F.coalesce(kind, F.lit("scooter")) if provider == "BOLT" else kind).alias("vehicle_type"),
    )


def mds_trips(bronze: Bronze, provider: str, strict: bool = True) -> DataFrame:
    """Trips of Voi, Dott or Bolt by device; ``route_json`` is the delivered GeoJSON text, if any."""
    duration = convert(_get("duration"), "int" if provider == "BOLT" else "decimal(38,9)", strict)
    route = typed_null() if provider == "BOLT" else _get("route")
    return items(bronze, provider, "TRIPS", S.TRIP).select(
        _get("trip_id").alias("trip_id"),
        _get("device_id").alias("device_id"),
        F.lit(provider.capitalize()).alias("provider_name"),
        ts_millis(_get("start_time"), strict).alias("start_ts"),
        ts_millis(_get("end_time"), strict).alias("end_ts"),
        duration.alias("trip_duration"),
        _double("distance", strict).alias("trip_distance"),
        _double("start_location.lat", strict).alias("start_lat"),
        _double("start_location.lng", strict).alias("start_lon"),
        _double("end_location.lat", strict).alias("end_lat"),
        _double("end_location.lng", strict).alias("end_lon"),
        route.alias("route_json"),
    )


def poppy_trips(bronze: Bronze, strict: bool = True, keep=()) -> DataFrame:
    """Every delivered copy of every Poppy trip, with ``load_ts``; end points come from the route."""
    geometry = F.get(_get("route.features"), F.lit(0))["geometry"]
    shape = F.from_json(geometry, "struct<coordinates:array<array<string>>>")

    def both_ends(parsed: Column) -> Column:
        positions = parsed["coordinates"]
        return F.struct(first_item(positions).alias("first"), last_item(positions).alias("last"))

    rows = items(bronze, "POPPY", "TRIPS", S.POPPY_TRIP, keep=("load_ts", *keep)).withColumn("ends", once(shape, both_ends))

    def number(text: Column) -> Column:
        return convert(text, "double", strict)

    return rows.select(
        *keep,
        _get("trip_id").alias("trip_id"),
        _get("vehicle_id").alias("vehicle_id"),
        _get("vehicle_type").alias("vehicle_type"),
        F.lit("Poppy").alias("provider_name"),
        ts_millis(_get("start_time"), strict).alias("start_ts"),
        ts_millis(_get("end_time"), strict).alias("end_ts"),
        convert(_get("trip_duration"), "decimal(38,9)", strict).alias("trip_duration"),
        _double("trip_distance", strict).alias("trip_distance"),
        number(geojson_lat(F.col("ends.first"))).alias("start_lat"),
        number(geojson_lon(F.col("ends.first"))).alias("start_lon"),
        number(geojson_lat(F.col("ends.last"))).alias("end_lat"),
        number(geojson_lon(F.col("ends.last"))).alias("end_lon"),
        geometry.alias("route_json"),
        "load_ts",
    )


def mds_events(bronze: Bronze, provider: str, strict: bool = True, keep=()) -> DataFrame:
    """Events of Voi or Bolt."""
    return items(bronze, provider, "EVENTS", S.EVENT, keep).select(
        *keep,
        _get("device_id").alias("device_id"),
        first_item(_get("event_types")).alias("event_type"),
        _get("vehicle_state").alias("vehicle_state"),
        first_item(_get("trip_ids")).alias("trip_id"),
        _double("location.lat", strict).alias("lat"),
        _double("location.lng", strict).alias("lon"),
        ts_millis(_get("timestamp"), strict).alias("reported_at"),
    )


def status_changes(bronze: Bronze, provider: str, endpoint: str, strict: bool = True, keep=()) -> DataFrame:
    """Status changes in the older format: Dott events and Bolt status changes."""
    place = _get("event_location.geometry.coordinates")
    return items(bronze, provider, endpoint, S.STATUS_CHANGE, keep).select(
        *keep,
        _get("device_id").alias("device_id"),
        _get("vehicle_id").alias("vehicle_id"),
        _get("vehicle_type").alias("vehicle_type"),
        first_item(_get("event_types")).alias("event_type"),
        _get("vehicle_state").alias("vehicle_state"),
        _get("trip_id").alias("trip_id"),
        convert(geojson_lat(place), "double", strict).alias("lat"),
        convert(geojson_lon(place), "double", strict).alias("lon"),
        battery_percent(_double("battery_pct", strict)).alias("battery_percent"),
        ts_millis(_get("event_time"), strict).alias("reported_at"),
    )


def voi_status(bronze: Bronze, strict: bool = True, keep=()) -> DataFrame:
    return items(bronze, "VOI", "VEHICLES_STATUS", S.VOI_STATUS, keep).select(
        *keep,
        _get("device_id").alias("device_id"),
        _get("last_event.vehicle_state").alias("vehicle_state"),
        first_item(_get("last_event.event_types")).alias("event_type"),
        first_item(_get("last_event.trip_ids")).alias("trip_id"),
        _double("last_telemetry.location.lat", strict).alias("lat"),
        _double("last_telemetry.location.lng", strict).alias("lon"),
        ts_millis(_get("last_telemetry.timestamp"), strict).alias("reported_at"),
    )


def dott_status(bronze: Bronze, strict: bool = True, keep=()) -> DataFrame:
    """Dott snapshots in either format; the newer keys win where both are there."""
    old_place = _get("current_location.geometry.coordinates")

    def place(axis: str, old: Column) -> Column:
        return F.coalesce(
            _double(f"last_telemetry.location.{axis}", strict),
            _double(f"last_event.location.{axis}", strict),
            convert(old, "double", strict),
        )

    seen = F.coalesce(
        ts_millis(_get("current_location.properties.timestamp"), strict),
        ts_millis(_get("last_event_time"), strict),
        ts_millis(F.col("last_updated"), strict),
    )
    return items(bronze, "DOTT", "VEHICLES_STATUS", S.DOTT_STATUS, keep, ("last_updated",)).select(
        *keep,
        _get("device_id").alias("device_id"),
        _get("vehicle_type").alias("vehicle_type"),
        F.coalesce(_get("last_event.vehicle_state"), _get("last_vehicle_state")).alias("vehicle_state"),
        F.coalesce(
            first_item(_get("last_event.event_types")), first_item(_get("last_event_types")), F.lit("telemetry")
        ).alias("event_type"),
        first_item(_get("last_event.trip_ids")).alias("trip_id"),
        place("lat", geojson_lat(old_place)).alias("lat"),
        place("lng", geojson_lon(old_place)).alias("lon"),
        seen.alias("reported_at"),
    )


def dott_pings(bronze: Bronze, strict: bool = True) -> DataFrame:
    """Dott pings that name at least one trip; the first one counts."""
    return (
        items(bronze, "DOTT", "TELEMETRY", S.DOTT_PING)
        .where(F.size(_get("trip_ids")) > 0)
        .select(
            first_item(_get("trip_ids")).alias("trip_id"),
            _get("device_id").alias("device_id"),
            _double("location.lat", strict).alias("lat"),
            _double("location.lng", strict).alias("lon"),
            convert(_get("timestamp"), "bigint", strict).alias("ping_ms"),
        )
    )


def bolt_pings(bronze: Bronze, strict: bool = True) -> DataFrame:
    """Bolt pings that have a latitude."""
    return (
        items(bronze, "BOLT", "TELEMETRY", S.BOLT_PING)
        .where(_get("location.lat").isNotNull())
        .select(
            _get("trip_id").alias("trip_id"),
            _get("device_id").alias("device_id"),
            _double("location.lat", strict).alias("lat"),
            _double("location.lng", strict).alias("lon"),
            convert(_get("timestamp"), "bigint", strict).alias("ping_ms"),
        )
    )


def poppy_types(bronze: Bronze, keep=()) -> DataFrame:
    return items(bronze, "POPPY", "VEHICLE_TYPES", S.POPPY_TYPE, keep).select(
        *keep, _get("vehicle_type_id").alias("vehicle_type_id"), _get("form_factor").alias("vehicle_type")
    )


def poppy_bikes(bronze: Bronze, strict: bool = True, keep=()) -> DataFrame:
    """Poppy snapshots; the time is that of the element, else of the page, else of the file."""
    seen = F.coalesce(
        ts_seconds(_get("last_reported"), strict), ts_seconds(F.col("last_updated"), strict), F.col("file_ts")
    )
    return items(
        bronze, "POPPY", "FREE_BIKE_STATUS", S.POPPY_BIKE, keep=("file_ts", *keep), root=("last_updated",)
    ).select(
        *keep,
        _get("bike_id").alias("device_id"),
        _get("vehicle_type_id").alias("vehicle_type_id"),
        F.lit("available").alias("vehicle_state"),
        F.lit("unspecified").alias("event_type"),
        typed_null().alias("trip_id"),
        _double("lat", strict).alias("lat"),
        _double("lon", strict).alias("lon"),
        seen.alias("reported_at"),
    )
