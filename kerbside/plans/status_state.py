"""The status mart run by run on a kept state, so that a run costs its new pages and the state, not the history.

The state is what a later slice can still need of everything seen: all reports from the start of the next slice on, the
last report before it of each device, Poppy's trips that reach into it, registries and vehicle types, and the names of the
bronze files taken up. Reports are kept by device, as pages name them: a registry entry that comes later renames them as a
full run would. Taking a page up twice changes nothing, so files may be compacted and runs repeated.

Each run writes a new version beside the old one and marks it when it is whole; a run that dies leaves the version before
it, whose successor takes the same pages up again. One version before the newest is kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.labels import event_priority
from kerbside.operators.enrich import unpivot_trips
from kerbside.operators.latest import STATUS_TIES, latest_per_key
from kerbside.operators.quality import STATUS_CHECKS
from kerbside.operators.upsert import DAY_LOOKBACK, drop, exists, key_date, publish, read_mart
from kerbside.plans.status import REPORT_ROW, Parsed, parse_pages, vehicles_status
from kerbside.schemas import conform
from kerbside.sources.bronze import new_files, read_bronze

DEVICE = ("provider_name", "device_id")
NEWEST = "VALID_FROM_TS timestamp"  # all that the next slice's start follows from


def _newest_trips(trips: DataFrame) -> DataFrame:
    return latest_per_key(trips, ["trip_id"], "load_ts", [c for c in trips.columns if c not in ("trip_id", "load_ts")])


def _last_per_device(reports: DataFrame) -> DataFrame:
    """The report of each device that ``last_reports`` would take: an aggregate, no sort of the history."""
    ties = [c for name in STATUS_TIES for c in (F.col(name).isNull().alias(f"{name}_null"), F.col(name).alias(name))]
    rank = F.struct((-F.unix_micros("reported_at")).alias("age"), event_priority(F.col("event_type")).alias("priority"), *ties)
    return reports.groupBy(*DEVICE).agg(F.min_by(F.struct(*REPORT_ROW), rank).alias("last")).select("last.*")


def fold(parsed: Parsed, start: Column) -> Parsed:
    """What slices from ``start`` on can need of ``parsed``. Reports without device or time are in no slice."""
    trips = _newest_trips(parsed.trips)
    open_ = F.coalesce(F.greatest("start_ts", "end_ts") >= start, F.lit(False))
    ends = unpivot_trips(trips.where(~open_)).withColumnRenamed("vehicle_id", "device_id").withColumnRenamed("vehicle_type", "own_type")
    reports = conform(parsed.reports, REPORT_ROW).unionByName(conform(ends, REPORT_ROW))
    known = reports.where(F.col("device_id").isNotNull())
    earlier = _last_per_device(known.where(F.col("reported_at") < start))
    return Parsed(
        known.where(F.col("reported_at") >= start).distinct().unionByName(earlier), parsed.registry.distinct(), parsed.types.distinct(),
        trips.where(open_),
    )


def _joined(one: Parsed, two: Parsed) -> Parsed:
    pairs = {f.name: (getattr(one, f.name), getattr(two, f.name)) for f in fields(Parsed)}
    return Parsed(**{name: a.unionByName(b.select(*a.columns)) for name, (a, b) in pairs.items()})


def _newest(spark: SparkSession, state: str) -> tuple[int, datetime] | None:
    """Number and slice start of the newest whole version."""
    if not exists(spark, f"{state}/whole"):
        return None
    marks = spark.read.schema("start timestamp, run int").parquet(f"{state}/whole")
    return marks.agg(F.max(F.struct("run", "start")).alias("m")).select("m.*").first()


def _read(spark: SparkSession, place: str, shape: Parsed) -> Parsed:
    parts = {f.name: getattr(shape, f.name).schema for f in fields(Parsed)}
    return Parsed(**{name: spark.read.schema(schema).parquet(f"{place}/{name}") for name, schema in parts.items()})


def _write(parsed: Parsed, place: str) -> None:
    for f in fields(Parsed):
        getattr(parsed, f.name).write.mode("overwrite").parquet(f"{place}/{f.name}")


def late_reports(parsed: Parsed, start: Column) -> int:
    """How many of ``complete_reports`` are older than ``start``. Reports of a type id are counted before they meet its types."""
    late, is_poppy = F.col("reported_at") < start, F.col("provider_name") == "Poppy"
    old = parsed.reports.where(late & is_poppy.isNotNull()).groupBy(F.when(is_poppy, F.col("vehicle_type_id")).alias("vehicle_type_id"))
    forms = parsed.types.select("vehicle_type_id", "vehicle_type").distinct().groupBy("vehicle_type_id").agg(F.count("*").alias("forms"))
    counted = old.agg(F.count("*").alias("n")).join(forms, "vehicle_type_id", "left").select((F.col("n") * F.coalesce("forms", F.lit(1))).alias("n"))
    ends = unpivot_trips(_newest_trips(parsed.trips)).where(late).select(F.lit(1).cast("bigint").alias("n"))
    return counted.unionByName(ends).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n


def _start(mart: DataFrame, lookback: str) -> datetime | None:
    return mart.agg((F.max("VALID_FROM_TS") - F.expr(lookback)).alias("start")).first()["start"]


def run_status(spark: SparkSession, fresh: Parsed, mart: str, staging: str, state: str, lookback: str = DAY_LOOKBACK,
               squash: bool = False, files: Sequence[str] = ()) -> int:
    """Publish the slice that follows from the state and from ``fresh``, and keep the next state.

    Returns how many fresh reports were too old for the slice; they still count as the last report of their device.
    ``fresh`` is written to ``staging`` and read from there; ``files`` are noted as taken up. A mart that has been set back
    to before the state cannot be continued.
    """
    fresh = replace(fresh, reports=conform(fresh.reports, REPORT_ROW))
    stored = read_mart(spark, mart, NEWEST)
    start = None if stored is None else _start(stored, lookback)
    newest = _newest(spark, state)
    if newest is not None and (start is None or start < newest.start):
        raise ValueError(f"the mart ends before the state in {state}: give a new folder and all pages")
    # Several plans follow: each would parse the pages again.
    _write(fresh, f"{staging}/fresh")
    fresh = _read(spark, f"{staging}/fresh", fresh)
    seen = fresh if newest is None else _joined(_read(spark, f"{state}/run={newest.run}", fresh), fresh)
    late = 0
    if start is not None:
        late = late_reports(fresh, F.lit(start).cast("timestamp"))
    batch = vehicles_status({}, stored, lookback, squash, parsed=seen)
    publish(spark, batch, mart, staging, "UID", "valid_date", key_date(F.col("VALID_FROM_TS")), STATUS_CHECKS)

    run = 0 if newest is None else newest.run + 1
    place = f"{state}/run={run}"
    after = _start(read_mart(spark, mart, NEWEST), lookback)
    kept = fold(seen, F.lit(after).cast("timestamp")) if after is not None else seen
    _write(kept, place)
    noted = spark.createDataFrame([(name,) for name in files], "file string")
    if newest is not None:
        noted = spark.read.schema("file string").parquet(f"{state}/run={newest.run}/files").unionByName(noted)
    noted.write.mode("overwrite").parquet(f"{place}/files")
    spark.range(1).select(F.lit(after).cast("timestamp").alias("start")).coalesce(1).write.mode("overwrite").parquet(f"{state}/whole/run={run}")
    for part in ("whole/", ""):
        drop(spark, f"{state}/{part}run={run - 2}")
    return late


def build_status_state(spark: SparkSession, bronze: str, mart: str, staging: str, state: str, lookback: str = DAY_LOOKBACK,
                       squash: bool = False, strict: bool = True) -> int:
    """``run_status`` on the bronze files that the state does not name: pages land in new files, whatever their load date.

    Only these files are opened. Their names pass the driver, as Spark's own listing of the table does.
    """
    table = read_bronze(spark, bronze)
    files = table.inputFiles()
    newest = _newest(spark, state)
    if newest is not None:
        noted = spark.read.schema("file string").parquet(f"{state}/run={newest.run}/files")
        files = new_files(spark, table, noted)
    pages = spark.read.schema(table.schema).option("basePath", bronze).parquet(*files) if files else table.limit(0)
    return run_status(spark, parse_pages(pages, strict), mart, staging, state, lookback, squash, files)
