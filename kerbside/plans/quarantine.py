"""What the feeds leave out: pages without items, items of the wrong shape, routes that are no line."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside import schemas as S
from kerbside.functions.pages import unreadable_items, unreadable_pages
from kerbside.operators.routes import rejected_routes
from kerbside.plans.feeds import items
from kerbside.schemas import ITEM_PATHS, typed_null
from kerbside.sources.bronze import Bronze, scan

ITEM_SHAPES = {
    ("VOI", "VEHICLES"): S.VEHICLE, ("DOTT", "VEHICLES"): S.VEHICLE, ("BOLT", "VEHICLES"): S.VEHICLE,
    ("VOI", "TRIPS"): S.TRIP, ("DOTT", "TRIPS"): S.TRIP, ("BOLT", "TRIPS"): S.TRIP,
    ("VOI", "EVENTS"): S.EVENT, ("BOLT", "EVENTS"): S.EVENT,
    ("DOTT", "EVENTS"): S.STATUS_CHANGE, ("BOLT", "STATUS_CHANGES"): S.STATUS_CHANGE,
    ("VOI", "VEHICLES_STATUS"): S.VOI_STATUS, ("DOTT", "VEHICLES_STATUS"): S.DOTT_STATUS,
    ("DOTT", "TELEMETRY"): S.DOTT_PING, ("BOLT", "TELEMETRY"): S.BOLT_PING,
    ("POPPY", "TRIPS"): S.POPPY_TRIP, ("POPPY", "FREE_BIKE_STATUS"): S.POPPY_BIKE, ("POPPY", "VEHICLE_TYPES"): S.POPPY_TYPE,
}
ROUTED = (("VOI", "TRIPS"), ("DOTT", "TRIPS"))


def quarantine(bronze: Bronze, tables: Iterable[tuple[str, str]] = tuple(ITEM_PATHS)) -> DataFrame:
    """``kind`` (page, item, route), ``provider, endpoint, filename`` and ``detail``, the text in question but for pages."""
    parts = []

    def add(kind: str, table: tuple[str, str], rows: DataFrame, detail: Column) -> None:
        named = [F.lit(kind).alias("kind"), F.lit(table[0]).alias("provider"), F.lit(table[1]).alias("endpoint")]
        parts.append(rows.select(*named, "filename", detail.alias("detail")))

    for table in tables:
        pages, paths, shape = scan(bronze, *table), ITEM_PATHS[table], ITEM_SHAPES[table]
        add("page", table, unreadable_pages(pages, paths), typed_null())
        add("item", table, unreadable_items(pages, paths, shape), F.col("item"))
        if table in ROUTED:
            trips = items(bronze, *table, shape, keep=("filename",))
            add("route", table, rejected_routes(trips, "item.route"), F.col("item.route"))
    return reduce(DataFrame.unionByName, parts)
