"""Joins with vehicle registries, type tables and correction lists.

No side is broadcast by force: registries grow with the fleets. Spark broadcasts them while its size
check allows it and shuffles with skew splitting beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def squash_registry(registry: DataFrame, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    """One row per device; each attribute is the greatest value seen for the device."""
    return registry.groupBy(*keys).agg(F.max("vehicle_id").alias("vehicle_id"), F.max("vehicle_type").alias("vehicle_type"))


def one_registry_row(registry: DataFrame, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    """One existing row per device: the smallest by (vehicle id, type), missing values last."""
    order = F.struct(
        F.col("vehicle_id").isNull().alias("a"), F.col("vehicle_id").alias("b"),
        F.col("vehicle_type").isNull().alias("c"), F.col("vehicle_type").alias("d"),
    )
    picked = registry.groupBy(*keys).agg(F.min_by(F.struct("vehicle_id", "vehicle_type"), order).alias("row"))
    return picked.select(*keys, "row.*")


def with_registry(df: DataFrame, registry: DataFrame, keys: Sequence[str] = ("device_id",)) -> DataFrame:
    """Left join adding ``reg_vehicle_id`` and ``reg_vehicle_type``; a device with two entries gives two rows."""
    side = registry.select(
        *keys, F.col("vehicle_id").alias("reg_vehicle_id"), F.col("vehicle_type").alias("reg_vehicle_type")
    )
    return df.join(side, list(keys), "left")


def with_type_lookup(df: DataFrame, types: DataFrame, default: str = "car", into: str = "vehicle_type") -> DataFrame:
    """Replace ``vehicle_type_id`` by the type it stands for, or the default."""
    side = types.select("vehicle_type_id", F.col("vehicle_type").alias("_type"))
    joined = df.join(side, "vehicle_type_id", "left")
    return joined.withColumn(into, F.coalesce("_type", F.lit(default))).drop("_type", "vehicle_type_id")


def seed_rows(seeds: DataFrame) -> DataFrame:
    """``trip_id, fixes``: the corrections of a trip by provider, one each should a list name a trip twice."""
    picked = seeds.where(F.col("provider_name").isNotNull() & F.col("TRIP_ID").isNotNull()).groupBy("provider_name", F.col("TRIP_ID").alias("trip_id"))
    fixed = picked.agg(F.min(F.struct("VEHICLE_ID", "VEHICLE_TYPE")).alias("fix"))
    return fixed.groupBy("trip_id").agg(F.map_from_entries(F.collect_list(F.struct("provider_name", "fix"))).alias("fixes"))


def patch_lost_vehicles(trips: DataFrame, seeds: DataFrame) -> DataFrame:
    """Correct vehicles by trip: the list wins for the id, the trip wins for the type (Voi only).

    ``seeds``: ``provider_name, TRIP_ID, VEHICLE_ID, VEHICLE_TYPE``. The join is by trip alone, so that trips which are
    laid out by trip, or will be, are not shuffled for it.
    """
    joined = trips.join(seed_rows(seeds), "trip_id", "left")
    fix = F.try_element_at("fixes", "provider_name")
    kind = F.when(F.col("provider_name") == "Voi", F.coalesce("vehicle_type", fix["VEHICLE_TYPE"])).otherwise(F.col("vehicle_type"))
    return joined.withColumns({"vehicle_id": F.coalesce(fix["VEHICLE_ID"], "vehicle_id"), "vehicle_type": kind}).select(*trips.columns)


def only_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is on a list of ids, however long the list is."""
    return df.join(ids.select(key), key, "left_semi")


def unpivot_trips(trips: DataFrame) -> DataFrame:
    """Two status reports per trip, its start and its end, from one scan."""

    def report(state: str, event: str, lat: str, lon: str, ts: str):
        return F.struct(
            F.lit(state).alias("vehicle_state"), F.lit(event).alias("event_type"),
            F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.col(ts).alias("reported_at"),
        )

    both = F.array(
        report("reserved", "trip_start", "start_lat", "start_lon", "start_ts"),
        report("available", "trip_end", "end_lat", "end_lon", "end_ts"),
    )
    return trips.withColumn("_report", F.explode(both)).select(
        "provider_name", "vehicle_id", "vehicle_type", "trip_id", "_report.*"
    )
