"""The trips mart run by run: a run rebuilds the trips that its new pages touch, and these alone.

A trip is touched by a new copy of it, a new ping, a registry entry that changes the vehicle of its device, or a correction
that comes, changes or goes. The kept state is a log: each run adds its typed trips and pings by day, an index from trips to
those days, an index from devices to trips, and the registry rows it has not seen. The slim indexes tell which days hold
something of the touched trips; only these days of the log and only the mart's dates of these trips are opened.

A run counts once it is marked whole; what a dead run wrote is overwritten by the next, which takes the same pages up again.
``compact`` folds the log into one run. Bolt's lines keep repeated pings, so a page must be taken up once: bronze files that
vanish may have come back under another name, and are refused.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.latest import latest_per_key
from kerbside.operators.quality import SEED_CHECKS, TRIPS_CHECKS, Check, require
from kerbside.operators.upsert import drop, exists, in_values, key_bucket, key_date, publish
from kerbside.plans import feeds
from kerbside.plans.trips import TRIP_ROW, assemble_trips, trip_registry
from kerbside.schemas import conform
from kerbside.sources.bronze import Bronze, new_files, read_bronze

DAY_MS = 86_400_000
# Days outside are put together, so that wild clocks make no folders of their own.
FIRST_DAY, LAST_DAY = 0, 40_000
BUCKETS = 16

COPY = {**TRIP_ROW, "load_ts": "timestamp"}
PING = {"provider_name": "string", "trip_id": "string", "ping_ms": "bigint", "lon": "double", "lat": "double"}
DEVICE = {"provider_name": "string", "device_id": "string", "vehicle_id": "string", "vehicle_type": "string"}
FIX = {"provider_name": "string", "TRIP_ID": "string", "VEHICLE_ID": "string", "VEHICLE_TYPE": "string"}
# What a run adds: the columns of each part, and the one that its folders are named by.
PARTS = {
    "trips": (COPY, "day"), "pings": (PING, "day"), "registry": (DEVICE, None), "seeds": (FIX, None), "files": ({"file": "string"}, None),
    "days": ({"trip_id": "string", "kind": "string", "day": "bigint"}, "bucket"),
    "devices": ({"provider_name": "string", "device_id": "string", "trip_id": "string"}, "bucket"),
}


@dataclass(frozen=True)
class TripPages:
    """``trips`` as ``COPY`` (``load_ts`` of Poppy alone), ``pings`` as ``PING``, ``registry`` as ``DEVICE``."""

    trips: DataFrame
    pings: DataFrame
    registry: DataFrame


def parse_trip_pages(bronze: Bronze, strict: bool = True) -> TripPages:
    """Everything in the pages that the trips mart is made of."""
    trips = conform(feeds.poppy_trips(bronze, strict), COPY).withColumn("device_id", F.col("vehicle_id"))
    registry = None
    for provider in ("VOI", "DOTT", "BOLT"):
        trips = trips.unionByName(conform(feeds.mds_trips(bronze, provider, strict), COPY))
        rows = conform(feeds.registry(bronze, provider).withColumn("provider_name", F.lit(provider.capitalize())), DEVICE)
        registry = rows if registry is None else registry.unionByName(rows)
    dott = feeds.dott_pings(bronze, strict).withColumn("provider_name", F.lit("Dott"))
    bolt = feeds.bolt_pings(bronze, strict).withColumn("provider_name", F.lit("Bolt"))
    return TripPages(trips, conform(dott, PING).unionByName(conform(bolt, PING)), registry)


def newest_copies(copies: DataFrame) -> DataFrame:
    """Poppy's newest delivery of each trip, and every copy of the others: what ``assemble_trips`` picks from."""
    poppy = F.col("provider_name") == "Poppy"
    newest = latest_per_key(copies.where(poppy), ["trip_id"], "load_ts", [c for c in TRIP_ROW if c != "trip_id"])
    return copies.where(~poppy).unionByName(newest)


def _day(ms: Column, width: int = 1) -> Column:
    """The day of an instant, or the first of its ``width`` days; NULL counts as the first of all."""
    day = F.greatest(F.lit(FIRST_DAY), F.least(F.lit(LAST_DAY), F.coalesce(F.floor(ms / DAY_MS), F.lit(FIRST_DAY)))).cast("bigint")
    return day - day % width


def _start_date(ts: Column, width: int) -> Column:
    """The mart's partition: the start date, or the first of its ``width`` dates."""
    day = F.unix_date(F.to_date(ts))
    return key_date(F.date_from_unix_date(day - F.pmod(day, F.lit(width))))


def _columns(part: str) -> str:
    shape, by = PARTS[part]
    kinds = shape if by is None else {**shape, by: "bigint" if by == "day" else "int"}
    return ", ".join(f"{name} {kind}" for name, kind in {**kinds, "run": "int"}.items())


class Log:
    """The state folder: the whole runs of its log since the last compaction."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.base, self.newest, self.width = spark, path, 0, -1, None
        if exists(spark, f"{path}/whole"):
            marks = spark.read.schema("base int, width int, run int").parquet(f"{path}/whole")
            mark = marks.agg(F.max(F.struct("run", "base", "width")).alias("m")).select("m.*").first()
            if mark.run is not None:
                self.base, self.newest, self.width = mark.base, mark.run, mark.width

    def read(self, part: str, last: int | None = None, first: int | None = None) -> DataFrame:
        """Rows of the whole runs, or of the runs from ``first`` to ``last``."""
        first, last = self.base if first is None else first, self.newest if last is None else last
        if not exists(self.spark, f"{self.path}/{part}"):
            return self.spark.createDataFrame([], _columns(part)).drop("run")
        rows = self.spark.read.schema(_columns(part)).parquet(f"{self.path}/{part}")
        return rows.where(F.col("run").between(first, last)).drop("run")

    def write(self, part: str, run: int, rows: DataFrame) -> None:
        """A run's share of a part; what a dead run left there goes."""
        shape, by = PARTS[part]
        if by == "bucket":
            rows = rows.withColumn("bucket", key_bucket(F.col(next(c for c in ("device_id", "trip_id") if c in shape)), BUCKETS))
        out = rows.hint("rebalance", by) if by else rows
        out = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (out.partitionBy(by) if by else out).parquet(f"{self.path}/{part}/run={run}")

    def mark(self, run: int, base: int, width: int) -> None:
        self.spark.range(1).select(F.lit(base).alias("base"), F.lit(width).alias("width")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/whole/run={run}")
        self.base, self.newest, self.width = base, run, width


def picked_vehicles(registry: DataFrame) -> DataFrame:
    """The registry row of each device that its trips are named by."""
    side = lambda name: registry.where(F.col("provider_name") == name)
    return trip_registry(side("Voi"), side("Dott"), side("Bolt")).select(*DEVICE)


def _corrections(seeds: DataFrame) -> DataFrame:
    rows = seeds.where(F.col("provider_name").isNotNull() & F.col("TRIP_ID").isNotNull())
    return rows.groupBy("provider_name", F.col("TRIP_ID").alias("trip_id")).agg(F.min(F.struct("VEHICLE_ID", "VEHICLE_TYPE")).alias("fix"))


def _values(rows: DataFrame, column: str) -> list:
    return [r[0] for r in rows.select(column).distinct().collect()]


def touched_trips(log: Log, run: int, registry: DataFrame, seeds: DataFrame) -> DataFrame:
    """Ids of the trips that run ``run``, already written, can change."""
    ids = log.read("days", run, run).select("trip_id")
    moved = picked_vehicles(registry).subtract(picked_vehicles(log.read("registry"))).select("provider_name", "device_id")
    buckets = _values(moved.select(key_bucket(F.col("device_id"), BUCKETS).alias("bucket")), "bucket")
    theirs = in_values(log.read("devices"), "bucket", buckets).join(moved, ["provider_name", "device_id"], "left_semi").select("trip_id")
    old, new = _corrections(log.read("seeds", first=log.newest)), _corrections(seeds)
    fixed = new.subtract(old).unionByName(old.subtract(new)).select("trip_id")
    return ids.unionByName(theirs).unionByName(fixed).where(F.col("trip_id").isNotNull()).distinct()


def run_trips(spark: SparkSession, fresh: TripPages, mart: str, staging: str, state: str, seeds: DataFrame | None = None,
              files: Sequence[str] = (), checks: Sequence[Check] = TRIPS_CHECKS, width: int = 1) -> list:
    """Add ``fresh`` to the state, rebuild the touched trips and publish them by start date. Returns the dates rewritten.

    ``seeds`` is the whole correction list of this run (``patch_lost_vehicles``), None for none; ``files`` are noted as
    taken up. The mart equals that of a full build over all pages so far. A trip without id or start fails the run,
    as it fails the full build. ``width`` is the number of days that share a folder of log and mart: one where a day fills
    files, more for small or long histories. It stays as the state began.
    """
    log = Log(spark, state)
    if log.width not in (None, width):
        raise ValueError(f"the state in {state} has folders of {log.width} days")
    if log.newest >= 0 and not exists(spark, mart):
        raise ValueError(f"the state in {state} has no mart: give a new folder and all pages")
    run = log.newest + 1
    fixes = conform(seeds, FIX) if seeds is not None else spark.createDataFrame([], _columns("seeds")).drop("run")
    known = log.read("registry")
    log.write("trips", run, conform(fresh.trips, COPY).withColumn("day", _day(F.unix_millis("start_ts"), width)))
    log.write("pings", run, conform(fresh.pings, PING).where(F.col("trip_id").isNotNull()).withColumn("day", _day(F.col("ping_ms"), width)))
    log.write("registry", run, conform(fresh.registry, DEVICE).subtract(known.select(*DEVICE)))
    log.write("seeds", run, fixes)
    log.write("files", run, spark.createDataFrame([(name,) for name in files], "file string"))
    trips, pings = log.read("trips", run, run), log.read("pings", run, run)
    require(trips, [Check("trip_id", "not_null")])
    where = [rows.select("trip_id", F.lit(kind).alias("kind"), "day") for kind, rows in (("trips", trips), ("pings", pings))]
    log.write("days", run, where[0].unionByName(where[1]).distinct())
    devices = trips.where(F.col("device_id").isNotNull() & (F.col("provider_name") != "Poppy"))
    log.write("devices", run, devices.select("provider_name", "device_id", "trip_id").distinct())

    registry, seen_fixes = log.read("registry", run), log.read("seeds", run, run)
    touched_trips(log, run, registry, seen_fixes).write.mode("overwrite").parquet(f"{staging}/touched")
    touched = spark.read.schema("trip_id string").parquet(f"{staging}/touched")
    buckets = _values(touched.select(key_bucket(F.col("trip_id"), BUCKETS).alias("bucket")), "bucket")
    held = in_values(log.read("days", run), "bucket", buckets).join(touched, "trip_id", "left_semi")
    days = [(r.kind, r.day) for r in held.select("kind", "day").distinct().collect()]  # no more than there are days

    def of_touched(part: str) -> DataFrame:
        rows = in_values(log.read(part, run), "day", [day for kind, day in days if kind == part])
        return rows.drop("day").join(touched, "trip_id", "left_semi")

    copies = of_touched("trips")
    # A trip lies under the start of one of its copies, before this run and after it, also when an earlier try died.
    dates = _values(copies.select(_start_date(F.col("start_ts"), width).alias("date")), "date")
    if dates:
        batch = assemble_trips(newest_copies(copies).drop("load_ts"), of_touched("pings"), picked_vehicles(registry), seen_fixes)
        publish(spark, batch, mart, staging, "TRIP_ID", "start_date", _start_date(F.col("START_TS"), width), checks, also=dates)
    log.mark(run, log.base, width)
    return sorted(dates)


def build_trips_state(spark: SparkSession, bronze: str, mart: str, staging: str, state: str, seeds: DataFrame | None = None,
                      strict: bool = True, checks: Sequence[Check] = TRIPS_CHECKS, width: int = 1) -> list:
    """``run_trips`` on the bronze files that the state does not name, whatever their load date. Only these are opened."""
    if seeds is not None:
        for (provider,) in [("Voi",), ("Dott",), ("Bolt",)]:
            require(seeds.where(F.col("provider_name") == provider), SEED_CHECKS)
    table = read_bronze(spark, bronze)
    noted = Log(spark, state).read("files")
    there = spark.createDataFrame([(f,) for f in table.inputFiles()], "file string")
    gone = noted.join(there, "file", "left_anti").count()
    if gone:
        raise ValueError(f"{gone} bronze files of earlier runs are gone: give a new state folder and all pages")
    files = new_files(spark, table, noted)
    pages = spark.read.schema(table.schema).option("basePath", bronze).parquet(*files) if files else table.limit(0)
    return run_trips(spark, parse_trip_pages(pages, strict), mart, staging, state, seeds, files, checks, width)


def compact(spark: SparkSession, state: str) -> None:
    """Fold the log into one run, between runs: few files again, superseded copies of trips gone."""
    log = Log(spark, state)
    if log.newest <= log.base:
        return
    run, base = log.newest + 1, log.base
    copies = newest_copies(log.read("trips"))
    others = copies.where(F.col("provider_name") != "Poppy").drop("load_ts", "day").withColumn("_route", F.xxhash64("route_json"))
    ties = [c for c in TRIP_ROW if c not in ("trip_id", "start_ts", "route_json")]
    newest = conform(latest_per_key(others, ["trip_id"], "start_ts", [*ties, "_route"]), COPY)
    kept = newest.unionByName(copies.where(F.col("provider_name") == "Poppy").drop("day")).withColumn("day", _day(F.unix_millis("start_ts"), log.width))
    log.write("trips", run, kept)
    for part in ("pings", "registry", "files"):
        log.write(part, run, log.read(part))
    log.write("seeds", run, log.read("seeds", first=log.newest))
    for part in ("days", "devices"):
        log.write(part, run, log.read(part).drop("bucket").distinct())
    log.mark(run, run, log.width)
    for number in range(base, run):
        for part in [*PARTS, "whole"]:
            drop(spark, f"{state}/{part}/run={number}")
