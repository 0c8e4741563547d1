"""The vehicle status mart: change points of every vehicle with their validity interval."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.labels import plain_scooter, status_uid
from kerbside.operators.enrich import squash_registry, unpivot_trips, with_registry
from kerbside.operators.latest import STATUS_TIES, best_report, latest_per_key
from kerbside.operators.timeline import change_intervals, last_reports
from kerbside.operators.upsert import DAY_LOOKBACK, slice_start
from kerbside.plans import feeds
from kerbside.schemas import STATUS_MART, conform, typed_null
from kerbside.sources.bronze import Bronze

VEHICLE = ("vehicle_id", "provider_name")
TIES = (*STATUS_TIES, "vehicle_type")
MART_SOURCE = (
    "vehicle_id", "vehicle_type", "provider_name", "vehicle_state", "event_type", "lat", "lon", "trip_id", "reported_at",
)
REPORT_ROW = {
    "provider_name": "string", "device_id": "string", "own_type": "string", "vehicle_state": "string",
    "event_type": "string", "lat": "double", "lon": "double", "trip_id": "string", "reported_at": "timestamp",
    "vehicle_type_id": "string",
}


def _side(name: str, df: DataFrame, own_type: Column, keep: Sequence[str] = ()) -> DataFrame:
    typed = df.withColumns({"provider_name": F.lit(name), "own_type": own_type})
    return conform(typed, {**REPORT_ROW, **{column: dict(df.dtypes)[column] for column in keep}})


def page_reports(bronze: Bronze, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Events and snapshots of all providers by device. ``own_type`` is the type to use where no registry names one.

    Each row depends on its page alone, so the result may be stored page by page. Dott snapshots lose
    their trip.
    """

    def typed(default: str) -> Column:
        return F.coalesce("vehicle_type", F.lit(default))

    bikes = feeds.poppy_bikes(bronze, strict, keep)
    parts = [
        _side("Voi", feeds.mds_events(bronze, "VOI", strict, keep), F.lit("bicycle"), keep),
        _side("Voi", feeds.voi_status(bronze, strict, keep), F.lit("bicycle"), keep),
        _side("Dott", feeds.status_changes(bronze, "DOTT", "EVENTS", strict, keep), typed("bicycle"), keep),
        _side("Dott", feeds.dott_status(bronze, strict, keep).drop("trip_id"), typed("scooter"), keep),
        _side("Bolt", feeds.mds_events(bronze, "BOLT", strict, keep), F.lit("scooter"), keep),
        _side("Bolt", feeds.status_changes(bronze, "BOLT", "STATUS_CHANGES", strict, keep), typed("scooter"), keep),
        _side("Poppy", bikes, typed_null(), keep),
    ]
    return reduce(DataFrame.unionByName, parts)


def page_registry(bronze: Bronze, keep: Sequence[str] = ()) -> DataFrame:
    """Registry entries of all providers, every delivered copy."""
    sides = [feeds.registry(bronze, code, keep).withColumn("provider_name", F.lit(code.capitalize())) for code in ("VOI", "DOTT", "BOLT")]
    return reduce(DataFrame.unionByName, sides)


@dataclass(frozen=True)
class Parsed:
    """What the status mart takes from pages. Each row depends on its page alone, so all of it may be stored page by page."""

    reports: DataFrame
    registry: DataFrame
    types: DataFrame
    trips: DataFrame


def parse_pages(bronze: Bronze, strict: bool = True, keep: Sequence[str] = ()) -> Parsed:
    """Reports and registries of all providers, vehicle types and trips (without routes) of Poppy."""
    return Parsed(
        page_reports(bronze, strict, keep), page_registry(bronze, keep), feeds.poppy_types(bronze, keep),
        feeds.poppy_trips(bronze, strict, keep).drop("route_json"),
    )


def complete_reports(parsed: Parsed) -> DataFrame:
    """Page reports with what other pages decide: Poppy's vehicle types, and two reports per newest Poppy trip."""
    reports = parsed.reports
    is_poppy = F.col("provider_name") == "Poppy"
    types = parsed.types.select("vehicle_type_id", F.col("vehicle_type").alias("_form")).distinct()
    # Only Poppy has type ids: the reports of the others would all meet at one NULL key.
    bikes = reports.where(is_poppy).join(types, "vehicle_type_id", "left").withColumn("own_type", F.coalesce("_form", F.lit("car")))
    ties = [c for c in parsed.trips.columns if c not in ("trip_id", "load_ts", "load_date")]
    trips = latest_per_key(parsed.trips, ["trip_id"], "load_ts", ties)
    ends = unpivot_trips(trips).withColumnRenamed("vehicle_id", "device_id")
    parts = [conform(reports.where(~is_poppy), REPORT_ROW), conform(bikes, REPORT_ROW), _side("Poppy", ends, F.col("vehicle_type"))]
    return reduce(DataFrame.unionByName, parts)


def union_reports(bronze: Bronze, strict: bool = True) -> DataFrame:
    """All reports of all providers by device, straight from the pages."""
    return complete_reports(parse_pages(bronze, strict))


def status_registry(entries: DataFrame, squash: bool = False) -> DataFrame:
    """One row per entry of ``page_registry``. Unless squashed, a device registered twice reports as two vehicles."""
    whole = entries.select("provider_name", "device_id", "vehicle_id", "vehicle_type")
    return squash_registry(whole, ["provider_name", "device_id"]) if squash else whole.distinct()


def name_vehicles(reports: DataFrame, registry: DataFrame) -> DataFrame:
    """Vehicle id and type of each report; reports without any vehicle are dropped, those without a device at once."""
    joined = with_registry(reports.where(F.col("device_id").isNotNull()), registry, ["provider_name", "device_id"])
    kind = F.coalesce("reg_vehicle_type", "own_type")
    return joined.select(
        F.coalesce("reg_vehicle_id", "device_id").alias("vehicle_id"),
        F.when(F.col("provider_name") == "Bolt", plain_scooter(kind)).otherwise(kind).alias("vehicle_type"),
        "provider_name", "vehicle_state", "event_type", "lat", "lon", "trip_id", "reported_at",
    ).where(F.col("vehicle_id").isNotNull())


def to_mart(intervals: DataFrame) -> DataFrame:
    return intervals.select(
        status_uid(F.col("vehicle_id"), F.col("reported_at")).alias("UID"),
        F.col("vehicle_id").alias("VEHICLE_ID"),
        F.col("vehicle_type").alias("VEHICLE_TYPE"),
        F.col("provider_name").alias("PROVIDER_NAME"),
        F.col("vehicle_state").alias("VEHICLE_STATE"),
        F.col("event_type").alias("EVENT_TYPE"),
        F.col("lat").alias("LAT"),
        F.col("lon").alias("LON"),
        F.col("trip_id").alias("TRIP_ID"),
        F.col("reported_at").alias("VALID_FROM_TS"),
        F.col("valid_to").alias("VALID_TO_TS"),
    ).select(*STATUS_MART)


def assemble_status(reports: DataFrame, target: DataFrame | None = None, lookback: str = DAY_LOOKBACK,
                    ties=TIES) -> DataFrame:
    """Named reports to mart rows: all of them, or the slice that follows an existing ``target``.

    The slice is compared with the last report before it. That history is only aggregated to one report
    per vehicle; it is neither sorted nor reduced report by report. The result is the same as that of a
    run over the full history cut to the slice, before validity ends are set.
    """
    # Exactly the columns of the mart: the summary packs whole rows, and only then both readers share one shuffle.
    reports = reports.select(*MART_SOURCE)
    if target is None:
        return to_mart(change_intervals(best_report(reports, VEHICLE, ties=ties)))
    start = slice_start(target, "VALID_FROM_TS", lookback)
    recent = reports.where(start.isNull() | (F.col("reported_at") >= start))
    earlier = reports.where(F.col("reported_at") < start)
    return to_mart(
        change_intervals(best_report(recent, VEHICLE, ties=ties), before=last_reports(earlier, VEHICLE, ties=ties))
    )


def vehicles_status(bronze: Bronze, target: DataFrame | None = None, lookback: str = DAY_LOOKBACK,
                    squash: bool = False, strict: bool = True, parsed: Parsed | None = None) -> DataFrame:
    """The status mart, or its next batch, from bronze pages.

    ``parsed`` are the stored pages of ``build.refresh``: with them no page is parsed again.
    """
    parsed = parsed or parse_pages(bronze, strict)
    return assemble_status(name_vehicles(complete_reports(parsed), status_registry(parsed.registry, squash)), target, lookback)
