"""The fleet frames packed into JSON pages, in the body shape of each provider."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.pages import content_hash
from workload import frames

PAGE_ROWS = 100
LOADED = "2024-02-01 00:00:00"


def _pack(rows: DataFrame, element: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """At most ``PAGE_ROWS`` elements per page: ``page_id``, ``keep`` columns and the array ``elements``."""
    numbered = rows.select(
        F.floor(F.monotonically_increasing_id() / PAGE_ROWS).alias("page_id"), *keep, element.alias("element")
    )
    return numbered.groupBy("page_id", *keep).agg(F.collect_list("element").alias("elements"))


def _page(packed: DataFrame, provider: str, endpoint: str, body: Column, load_ts: Column | None = None,
          file_ts: Column | None = None) -> DataFrame:
    content = F.to_json(body)
    loaded = F.lit(LOADED).cast("timestamp")
    return packed.select(
        F.lit(provider).alias("provider"),
        F.lit(endpoint).alias("endpoint"),
        content.alias("content"),
        F.concat(F.lit(f"{provider.lower()}_{endpoint.lower()}_20240201_p"), F.col("page_id").cast("string"), F.lit(".json")).alias("filename"),
        (file_ts if file_ts is not None else loaded).alias("file_ts"),
        content_hash(content).alias("md5_hash"),
        (load_ts if load_ts is not None else loaded).alias("load_ts"),
    )


def _under(name: str) -> Column:
    return F.struct(F.col("elements").alias(name))


def _data(name: str) -> Column:
    return F.struct(_under(name).alias("data"))


def _either(name: str) -> Column:
    """Every second page nests its array under ``data``."""
    nested = F.col("page_id") % 2 == 0
    return F.struct(
        F.when(nested, _under(name)).alias("data"), F.when(~nested, F.col("elements")).alias(name)
    )


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts))


def _latlng(lat: str, lon: str) -> Column:
    return F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lng"))


def _positions(*pairs: tuple[str, str]) -> Column:
    return F.array(*[F.array(F.col(lon), F.col(lat)) for lon, lat in pairs])


def _line(positions: Column) -> Column:
    return F.struct(F.lit("LineString").alias("type"), positions.alias("coordinates"))


START, VIA, END = ("start_lon", "start_lat"), ("via_lon", "via_lat"), ("end_lon", "end_lat")


def vehicles(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    """The registry, every page delivered twice."""
    rows = frames.registry(spark, sf_dir).where(F.col("provider_name") == provider.capitalize())
    packed = _pack(rows, F.struct("device_id", "vehicle_id", "vehicle_type"))
    body = {"VOI": _under, "DOTT": _data, "BOLT": _either}[provider]("vehicles")
    once = _page(packed, provider, "VEHICLES", body)
    return once.unionByName(once.withColumn("load_ts", F.expr("load_ts + INTERVAL 1 HOUR")))


def mds_trips(spark: SparkSession, sf_dir: str, provider: str) -> DataFrame:
    rows = frames.trips(spark, sf_dir).where(F.col("provider_name") == provider.capitalize())
    fields = [
        F.col("trip_id"),
        F.col("device_id"),
        _millis("start_ts").alias("start_time"),
        _millis("end_ts").alias("end_time"),
        F.col("duration"),
        F.col("distance"),
        _latlng("start_lat", "start_lon").alias("start_location"),
        _latlng("end_lat", "end_lon").alias("end_location"),
    ]
    if provider != "BOLT":
        whole = F.when(F.col("end_lat").isNotNull(), _positions(START, VIA, END)).otherwise(_positions(START, VIA))
        fields.append(F.when(F.col("via_lat").isNotNull(), _line(whole)).alias("route"))
    body = _either("trips") if provider == "BOLT" else _under("trips")
    return _page(_pack(rows, F.struct(*fields)), provider, "TRIPS", body)


def poppy_trips(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Bodies that are the array itself, delivered at ``load_ts``."""
    if rows is None:
        rows = frames.trip_copies(spark, sf_dir).where("provider_name = 'Poppy'")
    geometry = F.when(F.col("end_lat").isNotNull(), _line(_positions(START, END)))
    element = F.struct(
        F.col("trip_id"),
        F.col("device_id").alias("vehicle_id"),
        F.col("vehicle_type"),
        _millis("start_ts").alias("start_time"),
        _millis("end_ts").alias("end_time"),
        F.col("duration").alias("trip_duration"),
        F.col("distance").alias("trip_distance"),
        F.struct(F.array(F.struct(geometry.alias("geometry"))).alias("features")).alias("route"),
    )
    packed = _pack(rows, element, keep=("load_ts",))
    return _page(packed, "POPPY", "TRIPS", F.col("elements"), load_ts=F.col("load_ts"))


def _is_snapshot() -> Column:
    return F.col("event_type").isin("telemetry", "ping")


def _feed(spark: SparkSession, sf_dir: str, provider: str, snapshots: bool | None) -> DataFrame:
    rows = frames.reports(spark, sf_dir).where(F.col("provider_name") == provider.capitalize())
    if snapshots is None:
        return rows
    return rows.where(_is_snapshot() if snapshots else ~_is_snapshot())


def _ids(column: str) -> Column:
    return F.when(F.col(column).isNotNull(), F.array(column)).otherwise(F.array().cast("array<string>"))


def mds_events(spark: SparkSession, sf_dir: str, provider: str, snapshots: bool | None) -> DataFrame:
    """Voi and Bolt events; every page also holds a JSON null element."""
    element = F.struct(
        "device_id",
        F.array("event_type").alias("event_types"),
        "vehicle_state",
        _ids("trip_id").alias("trip_ids"),
        _latlng("lat", "lon").alias("location"),
        _millis("reported_at").alias("timestamp"),
    )
    packed = _pack(_feed(spark, sf_dir, provider, snapshots), element)
    holed = packed.withColumn("elements", F.array_append("elements", F.lit(None)))
    return _page(holed, provider, "EVENTS", _either("events"))


def status_changes(spark: SparkSession, sf_dir: str, provider: str, endpoint: str) -> DataFrame:
    element = F.struct(
        F.col("device_id"),
        F.col("vehicle_id"),
        F.when(F.col("clock") > 0, F.lit("moped")).alias("vehicle_type"),
        F.array("event_type").alias("event_types"),
        F.col("vehicle_state"),
        F.col("trip_id"),
        F.struct(F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry")).alias("event_location"),
        F.col("battery_pct"),
        _millis("reported_at").alias("event_time"),
    )
    body = _data("status_changes") if provider == "DOTT" else _either("status_changes")
    return _page(_pack(_feed(spark, sf_dir, provider, False), element), provider, endpoint, body)


def voi_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = F.struct(
        F.col("device_id"),
        F.struct("vehicle_state", F.array("event_type").alias("event_types"), _ids("trip_id").alias("trip_ids")).alias("last_event"),
        F.struct(_latlng("lat", "lon").alias("location"), _millis("reported_at").alias("timestamp")).alias("last_telemetry"),
    )
    return _page(_pack(_feed(spark, sf_dir, "VOI", True), element), "VOI", "VEHICLES_STATUS", _under("vehicles_status"))


def dott_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings come in the newer format with one time per page, telemetry in the older one under ``data``."""
    rows = _feed(spark, sf_dir, "DOTT", True)
    new = F.struct(
        F.col("device_id"),
        F.struct(
            F.col("vehicle_state"), F.array("event_type").alias("event_types"),
            F.array().cast("array<string>").alias("trip_ids"), _latlng("lat", "lon").alias("location"),
        ).alias("last_event"),
    )
    newer = _page(
        _pack(rows.where("event_type = 'ping'"), new, keep=("reported_at",)), "DOTT", "VEHICLES_STATUS",
        F.struct(_millis("reported_at").alias("last_updated"), F.col("elements").alias("vehicles")),
    )
    old = F.struct(
        F.col("device_id"),
        F.lit("moped").alias("vehicle_type"),
        F.col("vehicle_state").alias("last_vehicle_state"),
        F.array("event_type").alias("last_event_types"),
        F.struct(
            F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry"),
            F.struct(F.when(F.col("clock") > 0, _millis("reported_at")).alias("timestamp")).alias("properties"),
        ).alias("current_location"),
        _millis("reported_at").alias("last_event_time"),
    )
    older = _page(_pack(rows.where("event_type = 'telemetry'"), old), "DOTT", "VEHICLES_STATUS", _data("vehicles"))
    return newer.unionByName(older)


def dott_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned items carry no trip."""
    rows = frames.pings(spark, sf_dir).where("provider_name = 'Dott'")
    element = F.struct(
        F.col("device_id"),
        F.col("ping_ms").alias("timestamp"),
        _latlng("lat", "lon").alias("location"),
        F.when(F.col("l_returnflag") != "R", F.array("trip_id")).otherwise(F.array().cast("array<string>")).alias("trip_ids"),
    )
    return _page(_pack(rows, element), "DOTT", "TELEMETRY", _under("telemetry"))


def bolt_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames.pings(spark, sf_dir).where("provider_name = 'Bolt'")
    element = F.struct(
        F.col("trip_id"), F.col("device_id"), _latlng("lat", "lon").alias("location"), F.col("ping_ms").alias("timestamp")
    )
    return _page(_pack(rows, element), "BOLT", "TELEMETRY", _either("telemetry"))


def poppy_bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time is on the element, on the page or on the file, by ``clock``; always in seconds."""
    rows = _feed(spark, sf_dir, "POPPY", True)
    seconds = F.unix_seconds("reported_at")
    element = F.struct(
        F.col("device_id").alias("bike_id"), F.col("vehicle_type_id"), F.col("lat"), F.col("lon"),
        F.when(F.col("clock") == 0, seconds).alias("last_reported"),
    )
    packed = _pack(rows, element, keep=("reported_at", "clock"))
    body = F.struct(F.when(F.col("clock") == 1, seconds).alias("last_updated"), _under("bikes").alias("data"))
    return _page(packed, "POPPY", "FREE_BIKE_STATUS", body, file_ts=F.col("reported_at"))


def poppy_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = F.struct(F.col("vehicle_type_id"), F.col("vehicle_type").alias("form_factor"))
    return _page(_pack(frames.types(spark, sf_dir), element), "POPPY", "VEHICLE_TYPES", _data("vehicle_types"))


FEEDS = {
    **{f"{p}_VEHICLES": partial(vehicles, provider=p) for p in ("VOI", "DOTT", "BOLT")},
    **{f"{p}_TRIPS": partial(mds_trips, provider=p) for p in ("VOI", "DOTT", "BOLT")},
    "VOI_EVENTS": partial(mds_events, provider="VOI", snapshots=False),
    "VOI_VEHICLES_STATUS": voi_status,
    "DOTT_EVENTS": partial(status_changes, provider="DOTT", endpoint="EVENTS"),
    "DOTT_VEHICLES_STATUS": dott_status,
    "DOTT_TELEMETRY": dott_telemetry,
    "BOLT_EVENTS": partial(mds_events, provider="BOLT", snapshots=True),
    "BOLT_STATUS_CHANGES": partial(status_changes, provider="BOLT", endpoint="STATUS_CHANGES"),
    "BOLT_TELEMETRY": bolt_telemetry,
    "POPPY_TRIPS": poppy_trips,
    "POPPY_FREE_BIKE_STATUS": poppy_bikes,
    "POPPY_VEHICLE_TYPES": poppy_types,
}


class RawTables(dict):
    """Raw table names to their pages, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._source = (spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = FEEDS[name](*self._source)
        return self[name]


def bronze(spark: SparkSession, sf_dir: str) -> RawTables:
    """The pages of all providers by raw table."""
    return RawTables(spark, sf_dir)


def bronze_table(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """The pages of the named raw tables as one bronze frame."""
    return reduce(DataFrame.unionByName, [FEEDS[name](spark, sf_dir) for name in names])
