"""Route lines: arrays of (lon, lat) structs in WGS 84, NULL where there is no route."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.pages import once

POINT_TYPE = "struct<lon:double,lat:double>"
LINE_TYPE = f"array<{POINT_TYPE}>"
GEOJSON_DIGITS = 9  # fixed value: decimal digits of GeoJSON output


def point(lon: Column, lat: Column) -> Column:
    """A point, NULL when a coordinate is NULL."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def straight_line(start: Column, end: Column) -> Column:
    """Line of two points, NULL when either is NULL."""
    return F.when(start.isNotNull() & end.isNotNull(), F.array(start, end))


def stitch(start: Column, line: Column, end: Column) -> Column:
    """Line with a point put before and one after; NULL when any part is NULL."""
    whole = start.isNotNull() & line.isNotNull() & end.isNotNull()
    return F.when(whole, F.concat(F.array(start), line, F.array(end)))


def from_geojson(text: Column) -> Column:
    """Line of a GeoJSON LineString; any other geometry or a broken position gives NULL."""

    def vertex(position: Column) -> Column:
        lon, lat = F.get(position, F.lit(0)), F.get(position, F.lit(1))
        return F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))

    def line(shape: Column) -> Column:
        vertices = F.transform(shape["coordinates"], vertex)
        return F.when(
            shape["type"] == "LineString",
            once(vertices, lambda v: F.when(F.forall(v, lambda p: p.isNotNull()), v)),
        )

    return once(F.from_json(text, "struct<type:string,coordinates:array<array<double>>>"), line)


def delivered_line(geojson: Column, direct: Column) -> Column:
    """The delivered line; ``direct`` only where nothing was delivered."""
    return F.when(geojson.isNull(), direct).otherwise(from_geojson(geojson))


def drop_repeats(line: Column) -> Column:
    """Remove points equal to the one before; a line of two or more points keeps at least two."""

    def reduced(whole: Column) -> Column:
        kept = F.filter(whole, lambda p, i: (i == 0) | (p != F.get(whole, i - 1)))
        flat = F.slice(whole, 1, 2)  # all points equal: any two of them
        return once(kept, lambda k: F.when((F.size(k) < 2) & (F.size(whole) >= 2), flat).otherwise(k))

    return once(line, reduced)


def line_start(line: Column) -> Column:
    return F.get(line, F.lit(0))


def line_end(line: Column) -> Column:
    return F.try_element_at(line, F.lit(-1))


def to_geojson(line: Column) -> Column:
    """GeoJSON text of a line, NULL for a NULL line."""
    positions = F.transform(line, lambda p: F.array(F.round(p["lon"], GEOJSON_DIGITS), F.round(p["lat"], GEOJSON_DIGITS)))
    document = F.to_json(F.struct(F.lit("LineString").alias("type"), positions.alias("coordinates")))
    return F.when(line.isNotNull(), document)
