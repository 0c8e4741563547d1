"""One query per operator or view. Outputs hold flat columns only; instants are zone-less UTC."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside import configure
from kerbside.catalogue import endpoint_catalogue, with_endpoints
from kerbside.functions.clock import request_window
from kerbside.functions.labels import battery_percent
from kerbside.functions.lines import from_geojson, point, to_geojson
from kerbside.functions.pages import content_hash, unreadable_pages
from kerbside.operators.enrich import (
    only_ids, patch_lost_vehicles, squash_registry, unpivot_trips, with_registry, with_type_lookup,
)
from kerbside.operators.gaps import expected_grid, landed_hours, landing_gaps, page_gaps, page_runs, unbroken_pages
from kerbside.operators.latest import best_report, latest_per_key
from kerbside.operators.page_dedupe import PAGE_KEY, drop_empty, keep_if_changed, keep_if_unseen, last_hashes
from kerbside.operators.quality import SEED_CHECKS, Check, duplicates, run_checks
from kerbside.operators.routes import attach_routes, line_agg, rejected_routes, trip_lines
from kerbside.operators.timeline import change_points, validity_intervals
from kerbside.operators.upsert import incremental_slice, key_bucket, late_rows, publish, read_mart, upsert
from kerbside.plans import silver, status, trips
from kerbside.plans.build import refresh_reports
from kerbside.plans.quarantine import quarantine
from kerbside.plans.status_state import run_status
from kerbside.plans.trips_state import build_trips_state
from kerbside.plans.feeds import dott_pings, poppy_bikes
from kerbside.schemas import STATUS_MART
from kerbside.sources.bronze import append_pages, read_bronze
from kerbside.sources.files import import_dump, read_seed, read_table
from kerbside.sources.landing import (
    hour_pages, merged_items, page_filename, parse_names, read_hours, to_envelope, wrap_telemetry, write_hours,
)
from kerbside.sources.page_state import land
from workload import frames, pages
from workload.pages import LOADED

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# What the incremental queries take as already stored.
WEEK_BEFORE = "2024-01-13 00:00:00"
STORED_BEFORE = "2024-01-20 00:00:00"
HALF = "2024-01-15 00:00:00"


def flat(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places, decimals as doubles, timestamps without zone, integers as bigint."""

    def column(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        if isinstance(field.dataType, (T.DoubleType, T.DecimalType)):
            value = F.round(value, 6)
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.IntegerType):
            value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat(build(configure(spark), sf_dir))

    run.__doc__, run.__name__ = build.__doc__, build.__name__
    QUERIES[build.__name__] = run
    return run


def points(df: DataFrame, line: str, *keys: str) -> DataFrame:
    """A line as rows ``(keys, seq, lon, lat)``; a row without a line gives one row of NULLs."""
    return df.select(*keys, F.posexplode_outer(line).alias("seq", "p")).select(
        *keys, F.coalesce(F.col("seq"), F.lit(-1)).alias("seq"), F.col("p.lon").alias("lon"), F.col("p.lat").alias("lat")
    )


def _shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one the cluster names; a temporary one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{tempfile.mkdtemp(prefix=name)}/{name}"


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a stored table, the way a mart is met by its next run."""
    path = _shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _trip_number() -> Column:
    return F.regexp_extract("trip_id", r"\d+", 0).cast("bigint")


def _typed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.reports(spark, sf_dir).withColumn("vehicle_type", F.lit("scooter"))


# Status timeline


@query
def status_intervals(spark, sf_dir):
    """Flagship: the status mart of all reports."""
    return status.assemble_status(_typed_reports(spark, sf_dir))


@query
def status_incremental(spark, sf_dir):
    """A stored mart, then its next slice, upserted. Maintenance reports come late; the old ones never arrive."""
    reports = _typed_reports(spark, sf_dir)
    on_time = reports.where((F.col("reported_at") < STORED_BEFORE) & (F.col("event_type") != "maintenance_pick_up"))
    stored = _written(spark, status.assemble_status(on_time), "stored")
    return upsert(stored, status.assemble_status(reports, stored), "UID")


@query
def status_state_runs(spark, sf_dir):
    """The mart after three runs on a kept state. Maintenance reports come a run late, pings come last; some are too old for their slice."""
    folder = _shared_folder(spark, "state")
    reports = frames.reports(spark, sf_dir).withColumn("own_type", F.lit("scooter"))
    early, middle = F.col("reported_at") < WEEK_BEFORE, F.col("reported_at") < STORED_BEFORE
    late, last = F.col("event_type") == "maintenance_pick_up", F.col("event_type") == "ping"
    run = F.when(last, 3).when(late & early, 2).when(early, 1).when(middle & ~late, 2).otherwise(3)
    nothing = lambda shape: spark.createDataFrame([], shape)
    for number in (1, 2, 3):
        fresh = status.Parsed(
            reports.where(run == number), nothing("provider_name string, device_id string, vehicle_id string, vehicle_type string"),
            nothing("vehicle_type_id string, vehicle_type string"),
            nothing("trip_id string, vehicle_id string, vehicle_type string, provider_name string, start_ts timestamp, end_ts timestamp, "
                    "start_lat double, start_lon double, end_lat double, end_lon double, load_ts timestamp"),
        )
        run_status(spark, fresh, f"{folder}/mart", f"{folder}/staging-{number}", f"{folder}/kept")
    return read_mart(spark, f"{folder}/mart").select(*STATUS_MART)


@query
def status_late_rows(spark, sf_dir):
    """How many reports are too old for the next slice."""
    reports = _typed_reports(spark, sf_dir)
    stored = reports.where(F.col("reported_at") < STORED_BEFORE)
    return late_rows(reports, "reported_at", stored, "reported_at")


@query
def incremental_rows(spark, sf_dir):
    """The slice itself."""
    reports = _typed_reports(spark, sf_dir)
    stored = reports.where(F.col("reported_at") < STORED_BEFORE)
    return incremental_slice(reports, "reported_at", stored, "reported_at").select("event_id", "vehicle_id", "reported_at")


@query
def status_priority_dedup(spark, sf_dir):
    """One report per vehicle and instant, trip events first."""
    best = best_report(frames.reports(spark, sf_dir))
    return best.select("vehicle_id", "provider_name", "reported_at", "vehicle_state", "event_type", "trip_id", "lat", "lon")


@query
def change_points_only(spark, sf_dir):
    """Reports that differ from the one before, with that one."""
    reports = frames.reports(spark, sf_dir).select(
        "vehicle_id", "provider_name", "reported_at", "vehicle_state", "event_type", "trip_id", "lat", "lon"
    )
    changed = change_points(best_report(reports).drop("trip_id"))
    return changed.select(
        "vehicle_id", "provider_name", "reported_at", "vehicle_state", "event_type", "lat", "lon",
        F.col("prev.vehicle_state").alias("prev_state"), F.col("prev.lat").alias("prev_lat"), F.col("prev.lon").alias("prev_lon"),
    )


@query
def validity_ends(spark, sf_dir):
    """The instant of the following report of each vehicle."""
    return validity_intervals(best_report(frames.reports(spark, sf_dir)).select("vehicle_id", "provider_name", "reported_at"))


@query
def trip_events_unpivot(spark, sf_dir):
    """Two reports per trip."""
    return unpivot_trips(frames.trips(spark, sf_dir).withColumnRenamed("device_id", "vehicle_id"))


@query
def battery_scale(spark, sf_dir):
    """Battery share as percent, instants an hour earlier."""
    return frames.reports(spark, sf_dir).select(
        "event_id", battery_percent(F.col("battery_pct")).alias("battery_percent"),
        (F.col("seen_at") - F.expr("INTERVAL 1 HOUR")).alias("hour_before"),
    )


# Trips


@query
def trips_latest(spark, sf_dir):
    """The newest record of each trip; a missing start counts as newest."""
    newest = latest_per_key(
        frames.trip_copies(spark, sf_dir), ["trip_id"], "start_ts", ties=["load_ts", "provider_name", "device_id"]
    )
    return newest.select("trip_id", "provider_name", "device_id", "start_ts", "load_ts")


@query
def trips_union(spark, sf_dir):
    """Provider branches under one row type, with the vehicle rules of each provider and no registry."""
    rows = frames.trips(spark, sf_dir).withColumn("trip_duration", F.col("duration"))
    branches = [rows.where(F.col("provider_name") == p).drop("vehicle_type") for p in ("Voi", "Dott", "Bolt")]
    poppy = rows.where("provider_name = 'Poppy'").withColumn("vehicle_id", F.col("device_id"))
    named = trips.name_vehicles(trips.union_trips(*branches, poppy), frames.registry(spark, sf_dir).where("false"))
    return named.select("trip_id", "vehicle_id", "vehicle_type", "provider_name", "start_ts", "end_ts", "trip_duration")


def _trip_devices(spark, sf_dir):
    return frames.trips(spark, sf_dir).select("trip_id", "device_id", "start_ts")


def _any_registry(spark, sf_dir):
    return frames.registry(spark, sf_dir).select("device_id", "vehicle_id", "vehicle_type")


@query
def trips_enriched(spark, sf_dir):
    """Registry columns per trip; a device registered twice gives two rows."""
    joined = with_registry(_trip_devices(spark, sf_dir), _any_registry(spark, sf_dir))
    return joined.select(
        "trip_id", F.coalesce("reg_vehicle_id", "device_id").alias("vehicle_id"),
        F.coalesce("reg_vehicle_type", F.lit("bicycle")).alias("vehicle_type"), "start_ts",
    )


@query
def trips_enriched_squashed(spark, sf_dir):
    """Registry columns per trip against one row per device."""
    joined = with_registry(_trip_devices(spark, sf_dir), squash_registry(_any_registry(spark, sf_dir)))
    return joined.select(
        "trip_id", F.coalesce("reg_vehicle_id", "device_id").alias("vehicle_id"),
        F.coalesce("reg_vehicle_type", F.lit("bicycle")).alias("vehicle_type"), "start_ts",
    )


@query
def type_lookup(spark, sf_dir):
    """Vehicle type by type id, car where unknown."""
    rows = frames.reports(spark, sf_dir).select("event_id", "device_id", "vehicle_type_id")
    return with_type_lookup(rows, frames.types(spark, sf_dir))


@query
def seed_patch(spark, sf_dir):
    """Vehicles corrected by trip."""
    rows = frames.trips(spark, sf_dir).selectExpr(
        "trip_id", "provider_name", "device_id AS vehicle_id", "nullif(vehicle_type, 'car') AS vehicle_type"
    )
    return patch_lost_vehicles(rows, frames.seeds(spark, sf_dir))


@query
def id_list_filter(spark, sf_dir):
    """Trips on a list of ids."""
    ids = frames.seeds(spark, sf_dir).select(F.col("TRIP_ID").alias("trip_id"))
    return only_ids(frames.trips(spark, sf_dir), ids, "trip_id").select("trip_id", "device_id", "start_ts", "distance")


@query
def upsert_trips(spark, sf_dir):
    """Delivered again trips replace stored ones, others stay."""
    rows = frames.trip_copies(spark, sf_dir).select("trip_id", "provider_name", "start_ts", "load_ts")
    first = F.lit(pages.LOADED).cast("timestamp")
    return upsert(rows.where(F.col("load_ts") <= first), rows.where(F.col("load_ts") > first), "trip_id")


# Routes


@query
def telemetry_route(spark, sf_dir):
    """The line of each trip's pings, as numbered points."""
    return points(line_agg(frames.pings(spark, sf_dir), ["trip_id"]), "line", "trip_id")


def _routes(spark, sf_dir) -> DataFrame:
    rows = frames.trips(spark, sf_dir).withColumn(
        "route_json",
        F.when(
            F.col("via_lat").isNotNull(),
            to_geojson(
                F.array_compact(
                    F.array(
                        point(F.col("start_lon"), F.col("start_lat")),
                        point(F.col("via_lon"), F.col("via_lat")),
                        point(F.col("end_lon"), F.col("end_lat")),
                    )
                )
            ),
        ),
    )
    return attach_routes(rows, trip_lines(frames.pings(spark, sf_dir)))


@query
def trip_route(spark, sf_dir):
    """The route of each trip by its provider's rule, as numbered points."""
    return points(_routes(spark, sf_dir), "route", "trip_id", "provider_name")


@query
def route_geojson(spark, sf_dir):
    """Routes written as GeoJSON and read back."""
    text = _routes(spark, sf_dir).select("trip_id", to_geojson(F.col("route")).alias("route"))
    back = text.select(
        "trip_id", F.get_json_object("route", "$.type").alias("kind"), from_geojson(F.col("route")).alias("line")
    )
    return points(back, "line", "trip_id", "kind")


# Pages and silver views


def _view(name: str, *columns: str) -> Query:
    def build(spark, sf_dir):
        return silver.VIEWS[f"stg_{name}"](pages.bronze(spark, sf_dir)).selectExpr(*columns)

    build.__name__, build.__doc__ = f"silver_{name}", f"The view stg_{name} over JSON pages."
    return query(build)


REGISTRY = ("device_id", "vehicle_id", "vehicle_type")
TRIP = ("trip_id", "vehicle_short_id", "vehicle_type", "provider_name", "start_ts", "end_ts", "trip_duration",
        "trip_distance_meters", "start_lat", "start_lon", "end_lat", "end_lon",
        "coalesce(size(route_geom), 0) AS n_points")
REPORT = ("device_id", "event_type", "vehicle_state", "trip_id", "lat", "lon", "reported_at")

_view("voi_vehicles", *REGISTRY)
_view("dott_vehicles", *REGISTRY)
_view("bolt_vehicles", *REGISTRY)
_view("poppy_vehicles", "vehicle_type_id", "vehicle_type")
_view("voi_trips", *TRIP)
_view("dott_trips", *TRIP)
_view("bolt_trips", "trip_id", "vehicle_short_id", "vehicle_type", "provider_name", "started_at", "ended_at", "duration",
      "distance", "start_lat", "start_lon", "end_lat", "end_lon")
_view("poppy_trips", *TRIP, "load_ts")
_view("voi_events", *REPORT, "provider_name")
_view("dott_events", *REPORT, "vehicle_short_id", "vehicle_type", "battery_percent", "provider_name")
_view("bolt_events", *REPORT)
_view("bolt_status_changes", *REPORT, "vehicle_id", "vehicle_type")
_view("voi_vehicles_status", *REPORT, "vehicle_short_id", "vehicle_type")
_view("dott_vehicles_status", *REPORT, "vehicle_short_id", "vehicle_type", "provider_name")
_view("poppy_vehicles_status", *REPORT, "vehicle_id", "vehicle_type", "provider_name")
_view("bolt_telemetry", "trip_id", "device_id", "lat", "lon", "reported_at")


@query
def silver_dott_telemetry(spark, sf_dir):
    """The view stg_dott_telemetry over JSON pages, as numbered points."""
    return points(silver.dott_telemetry(pages.bronze(spark, sf_dir)), "telemetry_route_geom", "trip_id")


@query
def events_unnest(spark, sf_dir):
    """Events of one provider out of pages that hold them under either path."""
    return silver.bolt_events(pages.mds_events(spark, sf_dir, "BOLT", None)).select(*REPORT)


@query
def gbfs_status(spark, sf_dir):
    """Snapshots timed by element, page or file, without the type lookup."""
    return poppy_bikes(pages.poppy_bikes(spark, sf_dir)).select("device_id", "vehicle_type_id", "lat", "lon", "reported_at")


@query
def poppy_latest_snapshot(spark, sf_dir):
    """The newest delivery of every trip out of bodies that are arrays; end points from the route."""
    rows = frames.trip_copies(spark, sf_dir)
    return silver.poppy_trips(pages.poppy_trips(spark, sf_dir, rows)).selectExpr(*TRIP, "load_ts")


@query
def page_quarantine(spark, sf_dir):
    """Reports without an item array under the paths of Voi events, one page per report."""
    rows = frames.reports(spark, sf_dir)
    event = F.array(F.struct("device_id"))
    body = (
        F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(event.alias("vehicles"))))
        .when(F.col("event_id") % 3 == 1, F.to_json(F.struct(F.struct(event.alias("events")).alias("data"))))
        .otherwise(F.to_json(F.struct(event.alias("events"))))
    )
    landed = rows.select(F.col("provider_name"), "event_id", body.alias("content"))
    return unreadable_pages(landed, ("data.events", "events"), ("provider_name", "event_id"))


@query
def quarantine_counts(spark, sf_dir):
    """Pages, items and routes that the feeds leave out, by kind and raw table."""
    name = F.lit("f").alias("filename")
    report, trip = F.struct("device_id", F.array("event_type").alias("event_types")), F.col("event_id") % 5
    events = frames.reports(spark, sf_dir).select(
        name,
        F.when(trip == 0, F.to_json(F.struct(F.array(report).alias("vehicles"))))
        .when(trip == 1, F.to_json(F.struct(F.array(F.col("device_id")).alias("events"))))
        .when(trip == 2, F.lit('{"events":[null,{"other":1}]}'))
        .otherwise(F.to_json(F.struct(F.array(report).alias("events")))).alias("content"),
    )
    route = F.struct(F.when(_trip_number() % 3 == 0, F.lit("Point")).otherwise(F.lit("LineString")).alias("type"), F.array(F.array("start_lon", "start_lat"), F.array("start_lat", "start_lon")).alias("coordinates"))
    sent = F.struct("trip_id", F.when(_trip_number() % 2 == 0, route).alias("route"))
    trips_ = frames.trips(spark, sf_dir).select(name, F.to_json(F.struct(F.array(sent).alias("trips"))).alias("content"))
    found = quarantine({"VOI_EVENTS": events, "DOTT_TRIPS": trips_}, (("VOI", "EVENTS"), ("DOTT", "TRIPS")))
    return found.groupBy("kind", "provider", "endpoint").agg(F.count("*").alias("found"))


# Marts


@query
def bronze_to_gold_trips(spark, sf_dir):
    """The trips mart over the pages of all providers, with corrections."""
    mart = trips.all_trips(pages.bronze(spark, sf_dir), frames.seeds(spark, sf_dir))
    return mart.select(
        "TRIP_ID", "VEHICLE_ID", "VEHICLE_TYPE", "PROVIDER_NAME", "START_TS", "END_TS", "TRIP_DURATION", "TRIP_DISTANCE",
        "START_LAT", "START_LON", "END_LAT", "END_LON", F.coalesce(F.size("GEOM"), F.lit(0)).alias("N_POINTS"),
        F.get_json_object("ROUTE", "$.type").alias("ROUTE_TYPE"),
    )


@query
def trips_delta_runs(spark, sf_dir):
    """The trips mart after three runs on a kept state, with the points of its routes. Pages of a trip, its pings and its vehicle
    come in different runs, corrections in the last."""
    folder = _shared_folder(spark, "trips_state")
    names = [f"{p}_{kind}" for kind in ("TRIPS", "VEHICLES") for p in ("VOI", "DOTT", "BOLT")]
    landed = _stored_bronze(spark, sf_dir, *names, "POPPY_TRIPS", "DOTT_TELEMETRY", "BOLT_TELEMETRY")
    run = F.pmod(F.xxhash64("filename"), F.lit(3))
    for number in range(3):
        append_pages(landed.where(run == number).drop("load_date"), f"{folder}/bronze")
        seeds = frames.seeds(spark, sf_dir) if number == 2 else None
        build_trips_state(spark, f"{folder}/bronze", f"{folder}/mart", f"{folder}/staging-{number}", f"{folder}/kept", seeds, checks=SEED_CHECKS, width=365)
    mart = read_mart(spark, f"{folder}/mart")
    return points(mart, "GEOM", "TRIP_ID", "VEHICLE_ID", "VEHICLE_TYPE", "PROVIDER_NAME", "START_TS", "END_TS", "TRIP_DURATION", "TRIP_DISTANCE")


@query
def bronze_to_gold_status(spark, sf_dir):
    """The status mart over the pages of all providers."""
    return status.vehicles_status(pages.bronze(spark, sf_dir))


# Landing


def _event_pages(spark, sf_dir) -> DataFrame:
    """One page per report, in arrival order; equal bodies come with their keys in either order."""
    rows = frames.reports(spark, sf_dir)
    plain = F.to_json(F.struct(F.col("event_type").alias("a"), F.col("vehicle_state").alias("b")))
    turned = F.to_json(F.struct(F.col("vehicle_state").alias("b"), F.col("event_type").alias("a")))
    content = F.when(F.col("event_id") % 2 == 0, plain).otherwise(turned)
    return rows.select(
        F.upper("provider_name").alias("provider"), F.lit("EVENTS").alias("endpoint"), content.alias("content"),
        F.concat(F.lit("page_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("filename"),
        F.col("seen_at").alias("load_ts"), content_hash(content).alias("md5_hash"),
    )


@query
def page_hash_last(spark, sf_dir):
    """Pages kept when each is compared with the page before it only."""
    arrived = _event_pages(spark, sf_dir)
    stored = arrived.where(F.col("load_ts") < HALF)
    return keep_if_changed(arrived.where(F.col("load_ts") >= HALF), stored).select("provider", "filename", "load_ts")


@query
def page_hash_last_stored(spark, sf_dir):
    """The page stored last per raw table."""
    return last_hashes(_event_pages(spark, sf_dir)).select("provider", "endpoint", "load_ts")


def _filled_or_empty_pages(spark, sf_dir) -> DataFrame:
    """One page per report; bodies of equal device, kind and clock are equal, those of one kind carry nothing."""
    rows = frames.reports(spark, sf_dir)
    event = F.struct("device_id", "event_type", F.col("clock").cast("string").alias("clock"))
    full = F.to_json(F.struct(F.struct(F.array(event).alias("events")).alias("data")))
    empty = F.lit('{"data":{"events":[]}}')
    content = F.when(F.col("event_type") == "maintenance_pick_up", empty).otherwise(full)
    return rows.select(
        F.upper("provider_name").alias("provider"), F.lit("EVENTS").alias("endpoint"), content.alias("content"),
        F.lit("events").alias("leaf"),
        F.concat(F.lit("page_"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("filename"),
        F.col("seen_at").alias("load_ts"), content_hash(content).alias("md5_hash"),
    )


@query
def page_hash_any(spark, sf_dir):
    """Pages kept when each is compared with everything stored, empty ones dropped."""
    arrived = _filled_or_empty_pages(spark, sf_dir)
    filled = drop_empty(arrived)
    stored, new = filled.where(F.col("load_ts") < HALF), filled.where(F.col("load_ts") >= HALF)
    return keep_if_unseen(new, stored).select("provider", "filename", "load_ts")


def _landed_in_batches(spark, arrived: DataFrame, rule: str) -> DataFrame:
    """Bronze after three batches in order of arrival, each decided on the kept state; the second is offered twice."""
    folder = _shared_folder(spark, "landed")
    filed = arrived.withColumn("file_ts", F.col("load_ts"))
    middle, last = F.col("load_ts") >= WEEK_BEFORE, F.col("load_ts") >= STORED_BEFORE
    for number, mine in ((0, ~middle), (1, middle & ~last), (1, middle & ~last), (2, last)):
        land(filed.where(mine), f"{folder}/bronze", f"{folder}/state", number, rule, ("load_ts", "filename"), PAGE_KEY)
    return read_bronze(spark, f"{folder}/bronze").select("provider", "filename", "file_ts")


@query
def page_hash_index(spark, sf_dir):
    """Pages stored when each batch is compared with the kept index of all hashes, empty ones dropped."""
    return _landed_in_batches(spark, drop_empty(_filled_or_empty_pages(spark, sf_dir)), "seen")


@query
def page_hash_last_runs(spark, sf_dir):
    """Pages stored when each is compared with the page before it only, over batches that keep the last hashes."""
    return _landed_in_batches(spark, _event_pages(spark, sf_dir), "changed")


@query
def page_hash_canonical(spark, sf_dir):
    """Hashes of pages that must agree (keys turned at every depth, white space) and of pages that must not (kinds exchanged)."""
    rows = frames.reports(spark, sf_dir)
    # A fourth of the events each: plain, turned, numbers as texts, nulls as texts.
    bodies = [
        '{{"a":null,"data":{{"events":[{{"id":{0},"place":{{"p":true,"q":[{0},"{0}"]}}}}],"n":1}}}}',
        '{{"data": {{"n": 1,\n "events": [{{"place": {{"q": [{0}, "{0}"], "p": true}}, "id": {0}}}]}}, "a": null}}',
        '{{"a":null,"data":{{"events":[{{"id":"{0}","place":{{"p":true,"q":["{0}",{0}]}}}}],"n":1}}}}',
        '{{"a":"null","data":{{"events":[{{"id":{0},"place":{{"p":"true","q":[{0},"{0}"]}}}}],"n":"1"}}}}',
    ]
    # The same number stands in all four bodies of neighbouring events.
    number = F.floor(F.col("event_id") / 4).cast("string")
    made = [F.concat(*[F.lit(part) if i % 2 == 0 else number for i, part in enumerate(_apart(body))]) for body in bodies]
    content = F.element_at(F.array(*made), (F.col("event_id") % 4 + 1).cast("int"))
    return rows.select("event_id", content_hash(content).alias("md5_hash"))


def _apart(body: str) -> list[str]:
    """Constant parts of a body with a number between each two."""
    parts = body.format("\0").split("\0")
    return [x for part in parts for x in (part, "")][:-1]


@query
def landing_parse(spark, sf_dir):
    """File names built from trips, parsed again; telemetry bodies wrapped."""
    rows = frames.trips(spark, sf_dir)
    day, hour = F.date_format("end_ts", "yyyyMMdd"), F.date_format("end_ts", "yyyy-MM-dd'T'HH")
    slug = F.when(F.col("via_lat").isNull(), F.lit("vehicles_status")).otherwise(F.lit("trips"))
    paged = page_filename(F.lower("provider_name"), slug, F.when(F.col("end_lat").isNull(), day).otherwise(hour), F.col("duration") + 1)
    merged = F.concat(F.lit("telemetry_"), hour, F.lit(".json"))
    named = rows.select(
        "trip_id",
        F.when(F.col("provider_name") == "Dott", merged).otherwise(paged).alias("filename"),
        F.to_json(F.array(F.struct("trip_id"))).alias("content"),
    )
    wrapped = named.withColumn("content", wrap_telemetry(F.col("content"), F.col("filename")))
    return parse_names(wrapped).select("trip_id", "filename", "provider", "slug", "page_no", "file_ts", "content")


@query
def page_merge(spark, sf_dir):
    """The pings of all telemetry pages of an hour as one list of rows."""
    landed = pages.dott_telemetry(spark, sf_dir).withColumns(
        {"page_no": F.lit(1), "page_time": F.col("file_ts")}
    )
    return merged_items(landed).select(
        "provider", "endpoint", "hour",
        F.get_json_object("item", "$.device_id").alias("device_id"),
        F.get_json_object("item", "$.timestamp").cast("bigint").alias("ping_ms"),
        F.get_json_object("item", "$.trip_ids[0]").alias("trip_id"),
    )


@query
def landing_windows(spark, sf_dir):
    """What every endpoint is asked for by the runs of each hour with events."""
    runs = frames.reports(spark, sf_dir).select(
        (F.col("reported_at") + F.expr("INTERVAL 90 SECOND")).alias("run_ts")
    ).distinct()
    asked = with_endpoints(runs).withColumn("w", request_window(F.col("provider"), F.col("endpoint"), F.col("run_ts")))
    return asked.select("run_ts", "provider", "endpoint", "raw_table", "lane", "cadence", "format_version", "w.*")


@query
def hour_grid(spark, sf_dir):
    """Hours and days to be landed between the first and the last event, by cadence; days include the end."""
    span = frames.reports(spark, sf_dir).agg(F.min("reported_at").alias("start"), F.max("reported_at").alias("end"))
    asked = with_endpoints(span)
    hours = expected_grid(asked.where("cadence = 'hourly'"), F.col("start"), F.col("end"))
    days = expected_grid(
        asked.where("cadence = 'daily'"), F.date_trunc("day", F.col("start")), F.date_trunc("day", F.col("end")), "day", True
    )
    return hours.unionByName(days).select("provider", "endpoint", "cadence", "slot")


def _backfill_gaps(spark, sf_dir):
    rows = frames.reports(spark, sf_dir)
    span = rows.agg(F.min("reported_at").alias("start"), F.max("reported_at").alias("end"))
    wanted = with_endpoints(span).where("in_backfill AND cadence = 'hourly'")
    landed = rows.select(
        F.lower("provider_name").alias("provider"),
        F.when(F.col("trip_id").isNotNull(), F.lit("trips")).otherwise(F.lit("events/historical")).alias("endpoint"),
        F.col("reported_at").alias("slot"),
    )
    return landing_gaps(expected_grid(wanted, F.col("start"), F.col("end"), inclusive=True), landed)


@query
def landing_gaps_hourly(spark, sf_dir):
    """Hours of the backfill endpoints without a landed report."""
    return _backfill_gaps(spark, sf_dir).select("provider", "endpoint", "slot")


@query
def page_gaps_by_run(spark, sf_dir):
    """Pages announced by the page before but never landed: line items as pages of their order."""
    link = F.when(F.col("l_linenumber") < 7, F.concat(F.lit("https://example.org/next/"), (F.col("l_linenumber") + 1).cast("string")))
    landed = frames.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("page_no"),
        F.to_json(F.struct(F.struct(link.alias("next")).alias("links"))).alias("content"),
    )
    return page_gaps(landed, run=("run",))


def _broken_runs(spark, sf_dir) -> DataFrame:
    """Line items as pages of their order; returned ones have not landed, and the last page of a run announces no other."""
    more = F.col("l_linenumber") < F.max("l_linenumber").over(Window.partitionBy("l_orderkey"))
    lines = frames.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", more.alias("more"))
    link = F.when(F.col("more"), F.lit("https://example.org/next"))
    return lines.where("l_returnflag <> 'R'").select(
        F.col("l_orderkey").alias("run"), F.col("l_linenumber").cast("bigint").alias("page_no"),
        F.to_json(F.struct(F.struct(link.alias("next")).alias("links"))).alias("content"),
    )


@query
def page_runs_by_run(spark, sf_dir):
    """How far each run of pages is unbroken, and whether it is whole."""
    return page_runs(_broken_runs(spark, sf_dir), run=("run",))


@query
def page_runs_used(spark, sf_dir):
    """Pages of each run up to the first one missing."""
    return unbroken_pages(_broken_runs(spark, sf_dir), run=("run",)).select("run", "page_no")


# Quality, files


@query
def dq_unique(spark, sf_dir):
    """Trips delivered more than once."""
    return duplicates(frames.trip_copies(spark, sf_dir), "trip_id")


@query
def dq_checks(spark, sf_dir):
    """All assertions of the trips mart on unreduced trips."""
    rows = frames.trip_copies(spark, sf_dir)
    return run_checks(
        rows,
        [Check("trip_id", "unique"), Check("trip_id", "not_null"), Check("device_id", "not_null"),
         Check("start_ts", "not_null"), Check("end_lat", "not_null")],
    )


@query
def csv_dump_import(spark, sf_dir):
    """Orders dumped to CSV, imported twice into a table that later gains a column."""
    folder = _shared_folder(spark, "dump")
    rows = frames.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "concat(o_orderpriority, ', \"', o_orderstatus, '\"') AS note"
    )
    rows.write.option("header", True).option("escape", '"').csv(f"{folder}/narrow")
    rows.withColumn("md5_hash", F.md5("note")).write.option("header", True).option("escape", '"').csv(f"{folder}/wide")
    narrow = "o_orderkey bigint, o_orderstatus string, note string"
    import_dump(spark, f"{folder}/narrow", narrow, f"{folder}/table")
    import_dump(spark, f"{folder}/wide", f"{narrow}, md5_hash string", f"{folder}/table")
    return read_table(spark, f"{folder}/table")


@query
def hourly_files(spark, sf_dir):
    """Merged items of every provider, three pages an hour, written in hour folders as JSON lines and read back."""
    folder = _shared_folder(spark, "hours")
    rows = frames.reports(spark, sf_dir)
    items = rows.select(
        F.col("reported_at").alias("hour"), F.upper("provider_name").alias("provider"), F.lit("TELEMETRY").alias("endpoint"),
        (F.col("event_id") % 3 + 1).cast("int").alias("page_no"), F.col("event_id").alias("pos"), F.col("device_id").alias("item"),
    )
    write_hours(items, folder)
    back = spark.read.schema("provider string, page_no int, item string, hour string").json(folder)
    return back.groupBy("hour", "provider", "page_no", "item").agg(F.count("*").alias("n_pings"))


# Stored tables: landing, bronze, publication


def _report_pages(spark, sf_dir) -> DataFrame:
    """One event page per report of every provider, landed at the instant it was seen."""
    rows = frames.reports(spark, sf_dir)
    content = F.to_json(F.struct(F.array(F.struct("device_id", "event_id")).alias("events")))
    return rows.select(
        F.upper("provider_name").alias("provider"), F.lit("EVENTS").alias("endpoint"), content.alias("content"),
        F.lit("same_name.json").alias("filename"), F.col("reported_at").alias("file_ts"), content_hash(content).alias("md5_hash"),
        F.col("reported_at").alias("load_ts"), "event_id",
    )


@query
def landing_envelope(spark, sf_dir):
    """Trips as page files under every form of name that lands; names of no endpoint keep their file time alone."""
    rows = frames.trips(spark, sf_dir)
    day, hour = F.date_format("end_ts", "yyyy-MM-dd"), F.date_format("end_ts", "yyyy-MM-dd'T'HH")
    number = (F.col("duration") + 1).cast("string")
    form = _trip_number() % 6
    name = (
        F.when(form == 0, F.concat(F.lit("poppy_trips_"), day, F.lit("_p"), number, F.lit(".json")))
        .when(form == 1, F.concat(F.lit("poppy_trips_brussels_"), F.date_format("end_ts", "yyyyMMdd"), F.lit("_p"), number, F.lit(".json")))
        .when(form == 2, F.concat(F.lit("voi_vehicles_status_"), hour, F.lit("_p"), number, F.lit(".json")))
        .when(form == 3, F.concat(F.lit("telemetry_"), hour, F.lit(".json")))
        .when(form == 4, F.concat(F.lit("bolt_events_historical_"), hour, F.lit("_p"), number, F.lit(".json")))
        .otherwise(F.concat(F.lit("voi_unheard_of_"), hour, F.lit("_p"), number, F.lit(".json")))
    )
    files = rows.select("trip_id", name.alias("filename"), F.to_json(F.array(F.struct("trip_id"))).alias("content"))
    return to_envelope(files).select("trip_id", "provider", "endpoint", "filename", "file_ts", "content")


@query
def page_hash_same_name(spark, sf_dir):
    """Every page lands twice under one name that all pages share: one of each body and instant stays."""
    landed = _report_pages(spark, sf_dir)
    kept = keep_if_unseen(landed.unionByName(landed).drop("event_id"))
    return kept.select("provider", "load_ts", F.get_json_object("content", "$.events[0].event_id").cast("bigint").alias("event_id"))


@query
def page_hash_unknown_table(spark, sf_dir):
    """Pages without an endpoint are a raw table like any other, in both filters."""
    landed = _report_pages(spark, sf_dir).withColumn("endpoint", F.when(F.col("event_id") % 2 == 0, F.col("endpoint")))
    kept = [
        f(landed, order=("load_ts", "event_id"), page_key=("provider", "endpoint", "event_id")).select(F.lit(name).alias("kind"), "provider", "endpoint")
        for name, f in (("changed", keep_if_changed), ("unseen", keep_if_unseen))
    ]
    return kept[0].unionByName(kept[1]).groupBy("kind", "provider", "endpoint").agg(F.count("*").alias("n_pages"))


@query
def route_rejects(spark, sf_dir):
    """Routes of Voi trips, a third of them delivered as several lines, which is no route, and a third not delivered."""
    rows = frames.trips(spark, sf_dir).where(F.col("end_lat").isNotNull())
    line = F.to_json(F.struct(F.lit("LineString").alias("type"), F.array(F.array("start_lon", "start_lat"), F.array("end_lon", "end_lat")).alias("coordinates")))
    many = F.concat(F.lit('{"type":"MultiLineString","coordinates":[['), F.get_json_object(line, "$.coordinates"), F.lit("]]}"))
    kind = _trip_number() % 3
    given = rows.withColumns({"provider_name": F.lit("Voi"), "route_json": F.when(kind == 0, line).when(kind == 1, many)})
    lines = trip_lines(frames.pings(spark, sf_dir).where("false"))
    routed = attach_routes(given, lines).select("trip_id", F.size("route").alias("n"))
    rejected = rejected_routes(given).select("trip_id", F.lit(True).alias("rejected"))
    return routed.join(rejected, "trip_id", "left").select(
        "trip_id", F.when(F.col("n") > 0, F.col("n")).alias("n_points"), F.coalesce("rejected", F.lit(False)).alias("rejected")
    )


@query
def refresh_late_pages(spark, sf_dir):
    """Parsed reports after two refreshes: pages of one load date come only after a later date was refreshed."""
    folder = _shared_folder(spark, "refresh")
    bronze = f"{folder}/bronze"
    rows = pages.mds_events(spark, sf_dir, "VOI", False)
    number = F.regexp_extract("filename", r"_p(\d+)", 1).cast("int")
    day = F.when(number % 3 == 1, F.lit("2024-02-02")).when(number % 3 == 2, F.lit("2024-02-04")).otherwise(F.lit("2024-02-01"))
    dated = rows.withColumn("load_ts", day.cast("timestamp"))
    append_pages(dated.where(number % 3 != 1), bronze)
    refresh_reports(spark, read_bronze(spark, bronze), f"{folder}/store")
    append_pages(dated.where(number % 3 == 1), bronze)
    parsed = refresh_reports(spark, read_bronze(spark, bronze), f"{folder}/store")
    return parsed.groupBy("device_id", "reported_at", "event_type").agg(F.count("*").alias("n_reports"))


@query
def publish_round_trip(spark, sf_dir):
    """A mart published from one half of the trips, then upserted with copies and the other half, checks included."""
    folder = _shared_folder(spark, "publish")
    rows = latest_per_key(
        frames.trip_copies(spark, sf_dir), ["trip_id"], "start_ts", ties=["load_ts", "provider_name", "device_id"]
    ).select("trip_id", "device_id", "start_ts")
    bucket = key_bucket(F.col("trip_id"), 8)
    checks = [Check("trip_id", "unique"), Check("trip_id", "not_null")]
    old = frames.trips(spark, sf_dir).where(_trip_number() % 2 == 0).select("trip_id", "device_id", "start_ts")
    publish(spark, old, f"{folder}/mart", f"{folder}/one", "trip_id", "bucket", bucket, checks)
    publish(spark, rows, f"{folder}/mart", f"{folder}/two", "trip_id", "bucket", bucket, checks)
    return read_mart(spark, f"{folder}/mart").select("trip_id", "device_id", "start_ts")


def _stored_bronze(spark, sf_dir, *names) -> DataFrame:
    path = _shared_folder(spark, "bronze")
    append_pages(pages.bronze_table(spark, sf_dir, *names), path)
    return read_bronze(spark, path)


@query
def bronze_views(spark, sf_dir):
    """Registry views registered over a stored, partitioned bronze table and read through SQL."""
    silver.register_views(spark, _stored_bronze(spark, sf_dir, "VOI_VEHICLES", "DOTT_VEHICLES", "BOLT_VEHICLES"))
    parts = [f"SELECT '{p}' AS provider, device_id, vehicle_id FROM stg_{p}_vehicles" for p in ("voi", "dott", "bolt")]
    return spark.sql(" UNION ALL ".join(parts))


@query
def bronze_gaps(spark, sf_dir):
    """Hours of the hourly endpoints for which bronze has no page, in the names of the catalogue."""
    landed = landed_hours(_report_pages(spark, sf_dir), endpoint_catalogue(spark).select("provider", "endpoint", "table_suffix"))
    span = frames.reports(spark, sf_dir).agg(F.min("reported_at").alias("start"), F.max("reported_at").alias("end"))
    wanted = with_endpoints(span).where("cadence = 'hourly'")
    return landing_gaps(expected_grid(wanted, F.col("start"), F.col("end"), inclusive=True), landed).select("provider", "endpoint", "slot")


@query
def bronze_page_gaps(spark, sf_dir):
    """Pages that stored pages announce and that are not stored: line items as pages of their order's hour."""
    folder = _shared_folder(spark, "paged")
    link = F.when(F.col("l_linenumber") < 7, F.lit("https://example.org/next"))
    landed = frames.table(spark, sf_dir, "lineitem").select(
        F.lit("VOI").alias("provider"), F.lit("TRIPS").alias("endpoint"),
        F.to_json(F.struct(F.struct(link.alias("next")).alias("links"))).alias("content"), F.lit("f").alias("filename"),
        F.lit(LOADED).cast("timestamp").alias("file_ts"), F.lit(LOADED).cast("timestamp").alias("load_ts"),
        F.col("l_linenumber").cast("int").alias("page_no"), F.timestamp_seconds(F.col("l_orderkey") * 3600).alias("page_time"),
    )
    append_pages(landed, folder)
    found = page_gaps(read_bronze(spark, folder))
    return found.select((F.unix_seconds("page_time") / 3600).cast("bigint").alias("run"), "missing_page")


@query
def hour_files_back(spark, sf_dir):
    """Telemetry pages merged by hour, written, read again, turned into pages and parsed by the view of the feed."""
    folder = _shared_folder(spark, "hours")
    landed = pages.dott_telemetry(spark, sf_dir).withColumns({"page_no": F.lit(1), "page_time": F.col("file_ts")})
    numbered = merged_items(landed).withColumn("pos", F.pmod(F.xxhash64("item"), F.lit(100_000)).cast("int"))
    write_hours(numbered, f"{folder}/hours")
    append_pages(hour_pages(read_hours(spark, f"{folder}/hours")), f"{folder}/bronze")
    pings = dott_pings(read_bronze(spark, f"{folder}/bronze"))
    return pings.groupBy("device_id", "trip_id", "ping_ms").agg(F.count("*").alias("n_pings"))


@query
def seed_files(spark, sf_dir):
    """Correction lists written as CSV, one per provider, and read back."""
    folder = _shared_folder(spark, "seeds")
    rows = frames.seeds(spark, sf_dir)
    lists = []
    for provider in ("Voi", "Dott", "Bolt"):
        mine = rows.where(F.col("provider_name") == provider).select("TRIP_ID", "VEHICLE_ID", "VEHICLE_TYPE")
        mine.write.option("header", True).csv(f"{folder}/{provider}")
        lists.append(read_seed(spark, f"{folder}/{provider}", provider))
    return lists[0].unionByName(lists[1]).unionByName(lists[2])
