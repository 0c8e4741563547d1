"""The trips mart: one row per trip of any provider, with its route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.labels import plain_scooter
from kerbside.functions.lines import line_end, line_start, to_geojson
from kerbside.operators.enrich import one_registry_row, patch_lost_vehicles, squash_registry, with_registry
from kerbside.operators.latest import latest_per_key
from kerbside.operators.routes import attach_routes, trip_lines
from kerbside.plans import feeds
from kerbside.schemas import TRIPS_MART, conform
from kerbside.sources.bronze import Bronze

TRIP_ROW = {
    "trip_id": "string", "device_id": "string", "vehicle_id": "string", "vehicle_type": "string",
    "provider_name": "string", "start_ts": "timestamp", "end_ts": "timestamp", "trip_duration": "decimal(38,9)",
    "trip_distance": "double", "start_lat": "double", "start_lon": "double", "end_lat": "double",
    "end_lon": "double", "route_json": "string",
}


def union_trips(*branches: DataFrame) -> DataFrame:
    """Provider branches under one row type."""
    whole = None
    for branch in branches:
        part = conform(branch, TRIP_ROW)
        whole = part if whole is None else whole.unionByName(part)
    return whole


def trip_registry(voi: DataFrame, dott: DataFrame, bolt: DataFrame) -> DataFrame:
    """One registry row per provider and device, picked by each provider's rule."""

    def side(name: str, registry: DataFrame) -> DataFrame:
        return registry.select(F.lit(name).alias("provider_name"), "device_id", "vehicle_id", "vehicle_type")

    picked = one_registry_row(side("Voi", voi).unionByName(side("Bolt", bolt)), ["provider_name", "device_id"])
    return picked.unionByName(squash_registry(side("Dott", dott), ["provider_name", "device_id"]))


def name_vehicles(trips: DataFrame, registry: DataFrame) -> DataFrame:
    """Fill vehicle id and type: Voi knows registered vehicles only, Dott and Bolt fall back, Poppy brings its own."""
    joined = with_registry(trips, registry, ["provider_name", "device_id"])
    provider = F.col("provider_name")
    vehicle = (
        F.when(provider == "Voi", F.col("reg_vehicle_id"))
        .when(provider.isin("Dott", "Bolt"), F.coalesce("reg_vehicle_id", "device_id"))
        .otherwise(F.col("vehicle_id"))
    )
    kind = (
        F.when(provider == "Voi", F.col("reg_vehicle_type"))
        .when(provider == "Dott", F.coalesce("reg_vehicle_type", F.lit("bicycle")))
        .when(provider == "Bolt", plain_scooter(F.coalesce("reg_vehicle_type", F.lit("scooter"))))
        .otherwise(F.col("vehicle_type"))
    )
    return joined.withColumns({"vehicle_id": vehicle, "vehicle_type": kind}).drop("reg_vehicle_id", "reg_vehicle_type")


def to_mart(trips: DataFrame) -> DataFrame:
    """Mart columns; the end points are those of the route, not those the provider names."""
    first, last = line_start(F.col("route")), line_end(F.col("route"))
    return trips.select(
        F.col("trip_id").alias("TRIP_ID"),
        F.col("vehicle_id").alias("VEHICLE_ID"),
        F.col("vehicle_type").alias("VEHICLE_TYPE"),
        F.col("provider_name").alias("PROVIDER_NAME"),
        F.col("start_ts").alias("START_TS"),
        F.col("end_ts").alias("END_TS"),
        F.col("trip_duration").alias("TRIP_DURATION"),
        F.col("trip_distance").alias("TRIP_DISTANCE"),
        first["lat"].alias("START_LAT"),
        first["lon"].alias("START_LON"),
        last["lat"].alias("END_LAT"),
        last["lon"].alias("END_LON"),
        to_geojson(F.col("route")).alias("ROUTE"),
        F.col("route").alias("GEOM"),
    ).select(*TRIPS_MART)


def assemble_trips(trips: DataFrame, pings: DataFrame, registry: DataFrame, seeds: DataFrame | None) -> DataFrame:
    """Union of trips to mart rows.

    The newest record per trip is picked first. Vehicles are then looked up once per surviving trip, then corrections and
    routes, both by trip, so that no shuffle carries a finished line.
    """
    # Ties are settled by a hash of the route: no sort compares whole geometries.
    ties = [c for c in TRIP_ROW if c not in ("trip_id", "start_ts", "route_json")]
    keyed = trips.withColumn("_route", F.xxhash64("route_json"))
    newest = latest_per_key(keyed, ["trip_id"], "start_ts", [*ties, "_route"]).drop("_route")
    named = name_vehicles(newest, registry)
    patched = patch_lost_vehicles(named, seeds) if seeds is not None else named
    return to_mart(attach_routes(patched, trip_lines(pings)))


def all_trips(bronze: Bronze, seeds: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """The trips mart from bronze pages. ``seeds``: see ``patch_lost_vehicles``."""
    # Poppy has no registry; its vehicle id stands in for the device so that its trips spread in the registry join.
    newest_poppy = latest_per_key(feeds.poppy_trips(bronze, strict), ["trip_id"], "load_ts").withColumn("device_id", F.col("vehicle_id"))
    trips = union_trips(*[feeds.mds_trips(bronze, p, strict) for p in ("VOI", "DOTT", "BOLT")], newest_poppy)
    pings = (
        feeds.dott_pings(bronze, strict).withColumn("provider_name", F.lit("Dott"))
        .unionByName(feeds.bolt_pings(bronze, strict).withColumn("provider_name", F.lit("Bolt")))
    )
    registry = trip_registry(*[feeds.registry(bronze, p) for p in ("VOI", "DOTT", "BOLT")])
    return assemble_trips(trips, pings, registry, seeds)

