"""Expected against landed: hour grids, missing hours, incomplete page runs and how far they can be used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.pages import next_link

STEPS = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY"}


def expected_grid(catalogue: DataFrame, start: Column, end: Column, step: str = "hour", inclusive: bool = False,
                  into: str = "slot") -> DataFrame:
    """One row per catalogue row and step of ``[start, end)``, or ``[start, end]`` when inclusive."""
    every = F.expr(STEPS[step])
    slots = F.sequence(start.cast("timestamp"), end.cast("timestamp"), every)
    grid = catalogue.withColumn(into, F.explode(F.when(end >= start, slots)))
    return grid if inclusive else grid.where(F.col(into) < end.cast("timestamp"))


def landing_gaps(grid: DataFrame, landed: DataFrame, keys: Sequence[str] = ("provider", "endpoint", "slot")) -> DataFrame:
    """Grid rows for which nothing has landed: the backfill work list."""
    return grid.join(landed.select(*keys), list(keys), "left_anti")


def landed_hours(pages: DataFrame, names: DataFrame) -> DataFrame:
    """``provider, endpoint, slot`` of bronze pages, in the names that the catalogue uses.

    ``names``: catalogue rows ``provider, endpoint, table_suffix``, a fixed list.
    """
    raw = F.broadcast(names.select(F.upper("provider").alias("raw"), "table_suffix", F.col("provider").alias("p"), F.col("endpoint").alias("e")))
    known = pages.join(raw, (F.col("provider") == F.col("raw")) & (F.col("endpoint") == F.col("table_suffix")))
    return known.select(F.col("p").alias("provider"), F.col("e").alias("endpoint"), F.date_trunc("hour", "file_ts").alias("slot"))


def page_gaps(pages: DataFrame, run: Sequence[str] = ("provider", "endpoint", "page_time"), number: str = "page_no") -> DataFrame:
    """Pages that announce a following page which has not landed."""
    ahead = pages.where(next_link(F.col("content")).isNotNull()).select(*run, (F.col(number) + 1).alias(number))
    missing = ahead.join(pages.select(*run, number), [*run, number], "left_anti").distinct()
    return missing.select(*run, F.col(number).alias("missing_page"))


def page_runs(pages: DataFrame, run: Sequence[str] = ("provider", "endpoint", "page_time"), number: str = "page_no") -> DataFrame:
    """How far each run of pages is unbroken: ``run, n_pages, last_page, unbroken, whole``.

    ``unbroken`` is the length of the stretch that begins at page 1, 0 where that page is missing; a run is ``whole`` when
    it holds all its pages and the last announces no other. Copies count once; rows without a number are not counted. A
    page ends a stretch when its follower is not there, which is asked by run and number, so a long run is no single group.
    """
    place, more = F.col(number).cast("bigint"), next_link(F.col("content")).isNotNull()
    itself = F.struct(place.alias("n"), F.lit(True).alias("here"), more.alias("more"))
    follows = F.struct((place - 1).alias("n"), F.lit(False).alias("here"), F.lit(False).alias("more"))
    told = pages.where(place >= 1).select(F.struct(*run).alias("_run"), F.explode(F.array(itself, follows)).alias("p")).select("_run", "p.*")
    per_page = told.groupBy("_run", "n").agg(F.max("here").alias("here"), F.min("here").alias("last"), F.max("more").alias("more")).where("here")
    # ``last``: no row says that a page follows.
    per_run = per_page.groupBy("_run").agg(
        F.count("*").alias("n_pages"), F.max("n").alias("last_page"), F.min("n").alias("first"), F.min(F.when(F.col("last"), F.col("n"))).alias("end"),
        F.max_by("more", "n").alias("more"),
    )
    unbroken = F.when(F.col("first") == 1, F.col("end")).otherwise(F.lit(0))
    return per_run.select("_run.*", "n_pages", "last_page", unbroken.alias("unbroken"), ((unbroken == F.col("last_page")) & ~F.col("more")).alias("whole"))


def unbroken_pages(pages: DataFrame, run: Sequence[str] = ("provider", "endpoint", "page_time"), number: str = "page_no") -> DataFrame:
    """The pages of each run up to the first one missing, copies included: what may be used while the rest is fetched again."""
    reach = page_runs(pages, run, number).where("unbroken > 0").select(F.struct(*run).alias("_run"), F.col("unbroken").alias("_reach"))
    return pages.withColumn("_run", F.struct(*run)).join(reach, "_run").where(F.col(number).between(F.lit(1), F.col("_reach"))).drop("_run", "_reach")
