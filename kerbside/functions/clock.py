"""Epoch numbers, fallback chains and request windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.pages import convert

FAR_FUTURE_CHUNK = 2**62  # chunk of rows without a time: NULL times sort last


def ts_millis(text: Column, strict: bool = True) -> Column:
    """Epoch milliseconds as text to a timestamp."""
    return F.timestamp_millis(convert(text, "bigint", strict))


def ts_seconds(text: Column, strict: bool = True) -> Column:
    """Epoch seconds as text to a timestamp."""
    return F.timestamp_seconds(convert(text, "bigint", strict))


def time_chunk(ts: Column, seconds: int) -> Column:
    """Number of the fixed-width time chunk that holds ``ts``."""
    return F.coalesce(F.floor(F.unix_seconds(ts) / F.lit(seconds)), F.lit(FAR_FUTURE_CHUNK)).cast("bigint")


def delay_hours(endpoint: Column) -> Column:
    """Hours a provider needs before the data of an hour is complete."""
    slow = endpoint.contains("historical") | endpoint.contains("trips") | endpoint.contains("status_changes")
    return F.when(slow, F.lit(4)).otherwise(F.lit(1))


def target_hour(endpoint: Column, run_ts: Column) -> Column:
    """The hour a run at ``run_ts`` asks for."""
    shifted = F.timestamp_seconds(F.unix_seconds(run_ts) - delay_hours(endpoint) * 3600)
    return F.date_trunc("hour", shifted)


def request_window(provider: Column, endpoint: Column, run_ts: Column) -> Column:
    """Struct ``(kind, window_start, window_end)`` of what one run should deliver.

    ``kind`` names the request parameter style; it is NULL where the endpoint takes no window. The
    first rule that fits wins. The millisecond window of live events is not truncated to the hour.
    """
    hour = target_hour(endpoint, run_ts)
    exact = F.timestamp_seconds(F.unix_seconds(run_ts) - delay_hours(endpoint) * 3600)
    day = F.date_trunc("day", run_ts)
    none = F.lit(None).cast("timestamp")

    def window(kind: str, start: Column, end: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), start.alias("window_start"), end.alias("window_end"))

    return (
        F.when((provider == "poppy") & endpoint.contains("trips"), window("days", day - F.expr("INTERVAL 1 DAY"), day))
        .when(endpoint.contains("historical") | (endpoint == "status_changes"), window("event_time", hour, hour))
        .when(endpoint.contains("telemetry"), window("telemetry_time", hour, hour))
        .when(endpoint.contains("trips"), window("end_time", hour, hour))
        .when(endpoint.contains("recent") | (endpoint == "events"), window("millis", exact - F.expr("INTERVAL 1 HOUR"), exact))
        .otherwise(F.struct(F.lit(None).cast("string").alias("kind"), none.alias("window_start"), none.alias("window_end")))
    )
