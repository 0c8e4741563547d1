"""Route lines from telemetry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.lines import delivered_line, drop_repeats, from_geojson, point, stitch, straight_line

HOUR_MS = 3_600_000


def lines_agg(pings: DataFrame, keys: Sequence[str], line: Column, copies: dict[str, bool], ping_ms: str = "ping_ms",
              lon: str = "lon", lat: str = "lat", chunk_ms: int = HOUR_MS) -> DataFrame:
    """One row per key with a line for each name in ``copies``; ``line`` names the one a ping belongs to.

    Points come in time order, ties by lon, lat; pings without a point are skipped and a line without
    points is NULL. Lines are built from sorted hourly pieces: collecting and sorting the pings of a busy
    key is spread over its hours, and only finished pieces, which are points without times, meet in the row
    that has to hold the line anyway. Where ``copies`` is false equal pings are merged before the shuffle,
    which changes nothing where repeated points are removed later on.
    """
    # Both kinds share one set per piece: the number of a ping that may be a copy makes it differ from the others.
    repeated = [name for name, kept in copies.items() if kept]
    numbered = pings.select(
        *keys,
        line.alias("_line"),
        F.coalesce(F.floor(F.col(ping_ms) / F.lit(chunk_ms)), F.lit(2**62)).cast("bigint").alias("_hour"),
        F.when(
            F.col(lon).isNotNull() & F.col(lat).isNotNull(),
            F.struct(
                F.col(ping_ms).alias("ms"),  # NULL in all pings of a piece or in none
                F.col(lon).alias("lon"),
                F.col(lat).alias("lat"),
                F.when(line.isin(repeated), F.monotonically_increasing_id()).alias("copy"),
            ),
        ).alias("_ping"),
    )
    in_order = F.transform(F.sort_array(F.collect_set("_ping")), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    pieces = numbered.groupBy(*keys, "_hour", "_line").agg(in_order.alias("_points"))
    ordered = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_hour", "_line", "_points"))).alias("_pieces"))

    def points(name: str) -> Column:
        return F.flatten(F.transform(F.filter("_pieces", lambda piece: piece["_line"] == name), lambda piece: piece["_points"]))

    flat = ordered.select(*keys, *[points(name).alias(name) for name in copies])
    return flat.select(*keys, *[F.when(F.size(name) > 0, F.col(name)).alias(name) for name in copies])


def line_agg(pings: DataFrame, keys: Sequence[str], into: str = "line", copies: bool = True, **columns) -> DataFrame:
    """One line per key, see ``lines_agg``."""
    return lines_agg(pings, keys, F.lit(into), {into: copies}, **columns)


def trip_lines(pings: DataFrame) -> DataFrame:
    """Lines of Dott and Bolt trips side by side: ``(trip_id, dott_line, bolt_line)``.

    ``pings``: ``provider_name, trip_id, ping_ms, lon, lat``. Both providers share one aggregation by
    trip, so the join with the trips needs no further shuffle of either side.
    """
    provider = F.col("provider_name")
    return lines_agg(
        pings.where(F.col("trip_id").isNotNull()),
        ["trip_id"],
        F.when(provider == "Dott", "dott_line").when(provider == "Bolt", "bolt_line"),
        {"dott_line": False, "bolt_line": True},
    )


def provider_route(provider: Column, start: Column, end: Column, geojson: Column, dott_line: Column, bolt_line: Column) -> Column:
    """The route of a trip by the rule of its provider.

    Voi: the delivered route, the straight line where none came. Dott: telemetry between the two end points when
    there is any (no route at all if an end point is missing), else as Voi; repeated points removed.
    Bolt: telemetry, else the straight line. Poppy: the delivered route only. A delivered geometry that is no line
    gives no route (``rejected_routes`` names it).
    """
    direct = straight_line(start, end)
    delivered = from_geojson(geojson)
    given = delivered_line(geojson, direct)
    dott = F.when(dott_line.isNotNull(), stitch(start, dott_line, end)).otherwise(given)
    return (
        F.when(provider == "Voi", given)
        .when(provider == "Dott", drop_repeats(dott))
        .when(provider == "Bolt", F.coalesce(bolt_line, direct))
        .when(provider == "Poppy", delivered)
    )


def rejected_routes(trips: DataFrame, geometry: str = "route_json") -> DataFrame:
    """Trips whose delivered geometry is no line: the quarantine report of routes."""
    return trips.where(F.col(geometry).isNotNull() & from_geojson(F.col(geometry)).isNull())


def attach_routes(trips: DataFrame, lines: DataFrame, into: str = "route") -> DataFrame:
    """Left join of trips and their telemetry lines, then the provider rule.

    ``trips`` needs ``trip_id, provider_name, start_lat, start_lon, end_lat, end_lon, route_json``.
    """
    joined = trips.join(lines, "trip_id", "left")
    route = provider_route(
        F.col("provider_name"),
        point(F.col("start_lon"), F.col("start_lat")),
        point(F.col("end_lon"), F.col("end_lat")),
        F.col("route_json"),
        F.col("dott_line"),
        F.col("bolt_line"),
    )
    return joined.withColumn(into, route).drop("dott_line", "bolt_line", "route_json")
