"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.labels import event_priority


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: Sequence[str] = ()) -> DataFrame:
    """The first row of each key under ``order``; remaining ties are settled by the columns ``ties``.

    NULL keys form one group. The rank filter lets Spark cut every map-side partition down to one row
    per key before the shuffle, so a key that holds most of the rows does not weigh on one task.
    """
    total = [*order, *[F.col(name).asc_nulls_last() for name in ties]]
    window = Window.partitionBy(*keys).orderBy(*total)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``ts`` per key; a NULL ``ts`` counts as the greatest."""
    if ties is None:
        ties = [name for name in df.columns if name not in {*keys, ts}]
    return first_per_key(df, keys, [F.col(ts).desc_nulls_first()], ties)


STATUS_TIES = ("event_type", "vehicle_state", "trip_id", "lat", "lon")


def best_report(df: DataFrame, keys: Sequence[str] = ("vehicle_id", "provider_name"), ts: str = "reported_at",
                event: str = "event_type", ties: Sequence[str] = STATUS_TIES) -> DataFrame:
    """One report per vehicle and instant: trip events before maintenance before the rest."""
    return first_per_key(df, [*keys, ts], [event_priority(F.col(event)).asc()], ties)
