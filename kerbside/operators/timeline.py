"""Ordered neighbours, change points and validity intervals.

A plain window over one vehicle puts its whole history into one task. Here each history is cut into
time chunks that are windowed on their own; what a chunk needs from its neighbours is one summary row
per chunk, and only these summaries are ordered over the whole history. After the reduction to one
report per instant a chunk of a day holds at most one row per instant of that day, and a history has
one summary per day, so neither side grows with the number of reports a vehicle sends.

Keys must not be NULL. Select the columns you need before, not after: then the rows and their summaries
share one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.clock import time_chunk
from kerbside.functions.labels import NOISE_EVENTS

DAY = 86_400
MOVE_DEGREES = 0.0005  # fixed value: a larger step in either coordinate is a move


def _ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in order]


def _whole(df: DataFrame) -> Column:
    # Summaries pick whole rows: both uses of the chunked rows then read the same shuffle files.
    return F.struct(*[F.col(name) for name in df.columns])


def lag_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, values: Sequence[str],
           into: str = "prev") -> DataFrame:
    """Add struct column ``into``: ``values`` of the row before, NULL on the first row of a key.

    ``chunk`` must not decrease along ``order``.
    """
    return _neighbour(df, keys, order, chunk, values, into, ahead=False)


def lead_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, values: Sequence[str],
            into: str = "next") -> DataFrame:
    """Add struct column ``into``: ``values`` of the row after, NULL on the last row of a key."""
    return _neighbour(df, keys, order, chunk, values, into, ahead=True)


def _neighbour(df, keys, order, chunk, values, into, ahead):
    step, back = (F.lead, F.lag) if ahead else (F.lag, F.lead)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*_ascending(order))
    near = (
        df.withColumn("_chunk", chunk)
        .withColumn("_near", step(F.struct(*values)).over(inside))
        .withColumn("_outer", back(F.lit(True)).over(inside).isNull())
    )

    # The outermost row of each chunk: the last one looking back, the first one looking ahead.
    across = Window.partitionBy(*keys).orderBy("_chunk")
    edges = (
        near.where("_outer")
        .groupBy(*keys, "_chunk")
        .agg(F.first(_whole(near)).alias("_row"))
        .select(*keys, "_chunk", F.struct(*[F.col("_row")[name].alias(name) for name in values]).alias("_edge"))
        .select(*keys, "_chunk", step("_edge").over(across).alias("_far"))
    )
    return (
        near.join(edges, [*keys, "_chunk"])
        .withColumn(into, F.coalesce("_near", "_far"))
        .select(*df.columns, into)
    )


def is_change(state: Column, lat: Column, lon: Column, event: Column, prev: Column,
              move: float = MOVE_DEGREES, noise: Sequence[str] = NOISE_EVENTS) -> Column:
    """Whether a report differs from the one before it (fields ``vehicle_state``, ``lat``, ``lon`` of ``prev``).

    Unknown comparisons do not make a change, except that a missing previous state does.
    """
    changed = (
        prev["vehicle_state"].isNull()
        | (state != prev["vehicle_state"])
        | (F.abs(lat - prev["lat"]) > F.lit(move))
        | (F.abs(lon - prev["lon"]) > F.lit(move))
        | ~event.isin(*noise)
    )
    return F.coalesce(changed, F.lit(False))


REPORT = ("vehicle_state", "lat", "lon")


def change_points(df: DataFrame, keys: Sequence[str] = ("vehicle_id", "provider_name"), ts: str = "reported_at",
                  move: float = MOVE_DEGREES, noise: Sequence[str] = NOISE_EVENTS, chunk_seconds: int = DAY) -> DataFrame:
    """Reports that differ from the report before them, with that report as struct ``prev``."""
    lagged = lag_by(df, keys, [ts], time_chunk(F.col(ts), chunk_seconds), REPORT)
    return lagged.where(
        is_change(F.col("vehicle_state"), F.col("lat"), F.col("lon"), F.col("event_type"), F.col("prev"), move, noise)
    )


def validity_intervals(df: DataFrame, keys: Sequence[str] = ("vehicle_id", "provider_name"), ts: str = "reported_at",
                       into: str = "valid_to", chunk_seconds: int = DAY) -> DataFrame:
    """Add the instant of the following row of the same key; NULL while the row is still valid."""
    led = lead_by(df, keys, [ts], time_chunk(F.col(ts), chunk_seconds), [ts], into="_next")
    return led.withColumn(into, F.col("_next")[ts]).drop("_next")


def change_intervals(df: DataFrame, keys: Sequence[str] = ("vehicle_id", "provider_name"), ts: str = "reported_at",
                     move: float = MOVE_DEGREES, noise: Sequence[str] = NOISE_EVENTS, chunk_seconds: int = DAY,
                     before: DataFrame | None = None) -> DataFrame:
    """Change points with their validity end, ``change_points`` and ``validity_intervals`` in one pass.

    Inside a chunk only its first row needs the chunk before, and no row needs to know whether that
    first row is kept, so one summary row per chunk settles both directions at once.

    ``before`` holds one earlier report per key (the keys and ``vehicle_state``, ``lat``, ``lon``): the
    first row of a key is compared with it. It is never part of the result.
    """
    def changed(prev: Column, row: Column | None = None) -> Column:
        at = (lambda name: row[name]) if row is not None else F.col
        return is_change(at("vehicle_state"), at("lat"), at("lon"), at("event_type"), prev, move, noise)

    report = F.struct(*REPORT)
    chunked = df.withColumn("_chunk", time_chunk(F.col(ts), chunk_seconds))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(F.col(ts).asc_nulls_last())
    marked = (
        chunked.withColumn("_prev", F.lag(report).over(inside))
        .withColumn("_inner", F.col("_prev").isNotNull() & changed(F.col("_prev")))
    )

    summary = (
        marked.groupBy(*keys, "_chunk")
        .agg(
            F.min(ts).alias("_first_ts"),
            F.min_by(_whole(df), ts).alias("_first"),
            F.max_by(report, ts).alias("_last"),
            F.min(F.when(F.col("_inner"), F.col(ts))).alias("_inner_ts"),
        )
    )
    if before is not None:
        earlier = before.select(
            *keys, F.lit(-(2**62)).cast("bigint").alias("_chunk"), report.alias("_last")
        )
        summary = summary.unionByName(earlier, allowMissingColumns=True)

    across = Window.partitionBy(*keys).orderBy("_chunk")
    first_kept = F.when(
        F.col("_first").isNotNull() & changed(F.col("_carry"), F.col("_first")), F.col("_first_ts")
    ).otherwise(F.col("_inner_ts"))
    carried = (
        summary.withColumn("_carry", F.lag("_last").over(across))
        .withColumn("_kept_ts", first_kept)
        .withColumn("_after", F.expr("lead(_kept_ts) IGNORE NULLS").over(across))
        .select(*keys, "_chunk", "_carry", "_after")
    )

    after_inside = F.expr(f"lead(CASE WHEN _inner THEN `{ts}` END) IGNORE NULLS").over(inside)
    keep = F.when(F.col("_prev").isNull(), changed(F.col("_carry"))).otherwise(F.col("_inner"))
    return (
        marked.withColumn("_next", after_inside)
        .join(carried, [*keys, "_chunk"])
        .where(keep)
        .withColumn("valid_to", F.coalesce("_next", "_after"))
        .select(*df.columns, "valid_to")
    )


def last_reports(df: DataFrame, keys: Sequence[str] = ("vehicle_id", "provider_name"), ts: str = "reported_at",
                 ties: Sequence[str] = ()) -> DataFrame:
    """The last report per key as keys, ``vehicle_state``, ``lat``, ``lon``: an aggregate, no sort of the history."""
    from kerbside.operators.latest import STATUS_TIES
    from kerbside.functions.labels import event_priority

    ties = ties or STATUS_TIES
    rank = F.struct(
        (-F.unix_micros(ts)).alias("age"),
        event_priority(F.col("event_type")).alias("priority"),
        *[c for name in ties for c in (F.col(name).isNull().alias(f"{name}_null"), F.col(name).alias(name))],
    )
    best = df.where(F.col(ts).isNotNull()).groupBy(*keys).agg(F.min_by(F.struct(*REPORT), rank).alias("last"))
    return best.select(*keys, "last.*")
