"""Vehicle types, event classes and row identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event types by class, in the order of importance.
TRIP_EVENTS = ("trip_start", "trip_end", "user_pick_up", "user_drop_off")
MAINTENANCE_EVENTS = ("maintenance_drop_off", "maintenance_pick_up")
# Event types that do not by themselves mark a change.
NOISE_EVENTS = ("telemetry", "ping", "location_update", "unspecified")


def event_priority(event_type: Column) -> Column:
    """1 for trip events, 2 for maintenance, 3 for everything else, NULL included."""
    return (
        F.when(event_type.isin(*TRIP_EVENTS), F.lit(1))
        .when(event_type.isin(*MAINTENANCE_EVENTS), F.lit(2))
        .otherwise(F.lit(3))
    )


def plain_scooter(vehicle_type: Column) -> Column:
    """Fold standing scooters into scooters."""
    return F.when(vehicle_type == "scooter_standing", F.lit("scooter")).otherwise(vehicle_type)


def status_uid(vehicle_id: Column, reported_at: Column) -> Column:
    """Lower-case vehicle id and instant to the millisecond; NULL when either is NULL."""
    return F.concat(F.lower(vehicle_id), F.lit("_"), F.date_format(reported_at, "yyyyMMdd_HHmmssSSS"))


def battery_percent(fraction: Column) -> Column:
    return fraction * F.lit(100.0)
