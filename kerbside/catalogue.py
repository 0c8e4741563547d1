"""The endpoints each provider offers, the raw table each fills, and how often it is asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Provider, endpoint, raw table suffix, cadence.
ENDPOINTS = (
    ("voi", "vehicles", "VEHICLES", "hourly"),
    ("voi", "trips", "TRIPS", "hourly"),
    ("voi", "vehicles/status", "VEHICLES_STATUS", "hourly"),
    ("voi", "events/historical", "EVENTS", "hourly"),
    ("dott", "vehicles", "VEHICLES", "hourly"),
    ("dott", "trips", "TRIPS", "hourly"),
    ("dott", "vehicles/status", "VEHICLES_STATUS", "hourly"),
    ("dott", "events", "EVENTS", "hourly"),
    ("dott", "telemetry", "TELEMETRY", "hourly"),
    ("bolt", "vehicles", "VEHICLES", "hourly"),
    ("bolt", "trips", "TRIPS", "hourly"),
    ("bolt", "events/historical", "EVENTS", "hourly"),
    ("bolt", "status_changes", "STATUS_CHANGES", "hourly"),
    ("bolt", "telemetry", "TELEMETRY", "hourly"),
    ("poppy", "free_bike_status", "FREE_BIKE_STATUS", "hourly"),
    ("poppy", "trips/brussels", "TRIPS", "daily"),
    ("poppy", "vehicle_types", "VEHICLE_TYPES", "daily"),
    ("poppy", "system_information", "SYSTEM_INFORMATION", "daily"),
)

# Endpoints the hourly and the daily backfill ask for.
BACKFILL = (
    ("voi", "trips"),
    ("voi", "events/historical"),
    ("dott", "trips"),
    ("dott", "events"),
    ("bolt", "trips"),
    ("bolt", "status_changes"),
    ("poppy", "trips/brussels"),
)

# Other names under which the files of an endpoint land.
ALIASES = (("poppy", "trips", "trips/brussels"),)

# Endpoints still served in the older format version.
OLD_VERSION = (("dott", "vehicles"), ("dott", "events"), ("bolt", "status_changes"))


def format_version(provider: Column, endpoint: Column) -> Column:
    """1.2 for the endpoints that are still old, else 2.0."""
    old = [(provider == p) & (endpoint == e) for p, e in OLD_VERSION]
    any_old = old[0] | old[1] | old[2]
    return F.when(any_old, F.lit("1.2")).otherwise(F.lit("2.0"))


def endpoint_slug(endpoint: Column) -> Column:
    """The endpoint as it appears in file names."""
    return F.replace(endpoint, F.lit("/"), F.lit("_"))


def _derived(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "raw_table": F.concat(F.upper("provider"), F.lit("_"), F.col("table_suffix")),
            "slug": endpoint_slug(F.col("endpoint")),
            "format_version": format_version(F.col("provider"), F.col("endpoint")),
            "lane": F.initcap("provider"),
        }
    )


def endpoint_catalogue(spark: SparkSession) -> DataFrame:
    """One row per endpoint. The list is fixed, so it is safe to broadcast."""
    rows = [(p, e, t, c, (p, e) in BACKFILL) for p, e, t, c in ENDPOINTS]
    base = spark.createDataFrame(
        rows, "provider string, endpoint string, table_suffix string, cadence string, in_backfill boolean"
    )
    return _derived(base)


def file_slugs(spark: SparkSession) -> DataFrame:
    """``provider, slug, endpoint, table_suffix`` of every name that files of an endpoint bear. A fixed list."""
    suffix = {(p, e): t for p, e, t, _ in ENDPOINTS}
    rows = [(p, e.replace("/", "_"), e, t) for p, e, t, _ in ENDPOINTS] + [(p, slug, e, suffix[p, e]) for p, slug, e in ALIASES]
    return spark.createDataFrame(rows, "provider string, slug string, endpoint string, table_suffix string")


def with_endpoints(df: DataFrame) -> DataFrame:
    """Every row of ``df`` once per catalogue endpoint. The list is part of the plan, so nothing is joined."""
    endpoints = F.array(
        *[
            F.struct(
                F.lit(p).alias("provider"), F.lit(e).alias("endpoint"), F.lit(t).alias("table_suffix"),
                F.lit(c).alias("cadence"), F.lit((p, e) in BACKFILL).alias("in_backfill"),
            )
            for p, e, t, c in ENDPOINTS
        ]
    )
    return _derived(df.withColumn("_endpoint", F.explode(endpoints)).select(*df.columns, "_endpoint.*"))
