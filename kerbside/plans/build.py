"""Build the marts on stored tables: bronze to checked gold."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.quality import SEED_CHECKS, STATUS_CHECKS, TRIPS_CHECKS, require
from kerbside.operators.upsert import DAY_LOOKBACK, exists, in_values, key_bucket, key_date, late_rows, publish, read_mart
from kerbside.plans.quarantine import quarantine
from kerbside.plans.silver import register_views
from kerbside.plans.status import Parsed, complete_reports, parse_pages, vehicles_status
from kerbside.plans.trips import all_trips
from kerbside.sources.bronze import Bronze, read_bronze

TRIP_BUCKETS = 256


def build_trips(spark: SparkSession, bronze: Bronze, mart: str, staging: str, seeds: DataFrame | None = None,
                strict: bool = True, buckets: int = TRIP_BUCKETS) -> None:
    """Upsert all trips by TRIP_ID. Trips gone from bronze stay in the mart."""
    if seeds is not None:
        for (provider,) in [("Voi",), ("Dott",), ("Bolt",)]:
            require(seeds.where(F.col("provider_name") == provider), SEED_CHECKS)
    batch = all_trips(bronze, seeds, strict)
    publish(spark, batch, mart, staging, "TRIP_ID", "trip_bucket", key_bucket(F.col("TRIP_ID"), buckets), TRIPS_CHECKS)


def refresh(spark: SparkSession, bronze: DataFrame, store: str, strict: bool = True) -> Parsed:
    """Parse the pages of every load date that has changed since the last refresh into ``store`` and return all of it.

    The pages of each load date are counted and their names and times hashed, in slim columns; a date that differs
    from what was noted beside the store is parsed again, whenever its pages came. Dates are as many as days. Reports
    lie in ``store``, registries and Poppy's types and trips beside it.
    """
    page = F.xxhash64("provider", "endpoint", "filename", "load_ts", "md5_hash")
    marks = bronze.groupBy("load_date").agg(F.count("*").alias("pages"), F.bit_xor(page).alias("mark")).collect()
    noted_at = f"{store}_pages"
    places = {f.name: store if f.name == "reports" else f"{store}_{f.name}" for f in fields(Parsed)}
    noted = read_mart(spark, noted_at) if all(exists(spark, place) for place in places.values()) else None
    known = set() if noted is None else {tuple(r) for r in noted.select("load_date", "pages", "mark").collect()}
    stale = [r.load_date for r in marks if tuple(r) not in known]
    parts = parse_pages(in_values(bronze, "load_date", stale), strict, keep=("load_date",))
    for name, place in places.items():
        if stale or noted is None:
            part = getattr(parts, name)
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_date").parquet(place)
    spark.createDataFrame(marks, "load_date date, pages long, mark long").coalesce(1).write.mode("overwrite").parquet(noted_at)
    return Parsed(**{name: spark.read.schema(getattr(parts, name).schema).parquet(place) for name, place in places.items()})


def refresh_reports(spark: SparkSession, bronze: DataFrame, store: str, strict: bool = True) -> DataFrame:
    """The reports of ``refresh``."""
    return refresh(spark, bronze, store, strict).reports


def build_status(spark: SparkSession, bronze: Bronze, mart: str, staging: str, lookback: str = DAY_LOOKBACK,
                 squash: bool = False, strict: bool = True, reports: str | None = None) -> DataFrame | None:
    """Add the newest status slice by UID. Stored intervals before the slice keep their end.

    Returns the count of reports that were too old for the slice when the run began (``late_rows``), None at the first.
    ``reports`` is the folder that keeps parsed pages between runs; ``bronze`` must be the stored table then.
    """
    parsed = parse_pages(bronze, strict) if reports is None else refresh(spark, bronze, reports, strict)
    stored = read_mart(spark, mart)
    late = None
    if stored is not None:
        (counted,) = late_rows(complete_reports(parsed), "reported_at", stored, "VALID_FROM_TS", lookback).first()
        late = spark.range(1).select(F.lit(counted).alias("late_rows"))
    batch = vehicles_status(bronze, stored, lookback, squash, strict, parsed)
    publish(spark, batch, mart, staging, "UID", "valid_date", key_date(F.col("VALID_FROM_TS")), STATUS_CHECKS)
    return late


def build_all(spark: SparkSession, bronze_path: str, gold_path: str, staging: str, seeds: DataFrame | None = None,
              strict: bool = True) -> None:
    """Silver views, both marts and the quarantine report. ``staging`` is a new folder for each run."""
    bronze = read_bronze(spark, bronze_path)
    register_views(spark, bronze, strict)
    build_trips(spark, bronze, f"{gold_path}/fct_all_trips", f"{staging}/trips", seeds, strict)
    build_status(
        spark, bronze, f"{gold_path}/fct_vehicles_status", f"{staging}/status", strict=strict, reports=f"{gold_path}/parsed_reports"
    )
    quarantine(bronze).write.mode("overwrite").parquet(f"{gold_path}/quarantine")
    for name in ("fct_all_trips", "fct_vehicles_status"):
        read_mart(spark, f"{gold_path}/{name}").createOrReplaceTempView(name)
