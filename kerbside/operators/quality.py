"""Data assertions: unique and not-null columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    column: str
    kind: str  # "unique" or "not_null"


class QualityError(ValueError):
    """Raised when an assertion does not hold."""


TRIPS_CHECKS = (
    Check("TRIP_ID", "unique"), Check("TRIP_ID", "not_null"),
    Check("VEHICLE_ID", "not_null"), Check("START_TS", "not_null"),
)
STATUS_CHECKS = (Check("UID", "unique"), Check("UID", "not_null"), Check("VEHICLE_ID", "not_null"))
SEED_CHECKS = (Check("TRIP_ID", "unique"), Check("TRIP_ID", "not_null"))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count. NULL is no value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``(column_name, failures)`` per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.inline(pairs))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row ``(column_name, check_kind, failures)`` per assertion; 0 failures means it holds."""
    parts = []
    filled = [c.column for c in checks if c.kind == "not_null"]
    if filled:
        parts.append(missing(df, filled).select("column_name", F.lit("not_null").alias("check_kind"), "failures"))
    for check in checks:
        if check.kind == "unique":
            parts.append(
                duplicates(df, check.column)
                .agg(F.count("*").alias("failures"))
                .select(F.lit(check.column).alias("column_name"), F.lit("unique").alias("check_kind"), "failures")
            )
    return reduce(DataFrame.unionByName, parts)


def require(df: DataFrame, checks: Sequence[Check]) -> None:
    """Raise ``QualityError`` naming every assertion that fails. The report has one row per assertion."""
    if not checks:
        return
    failed = run_checks(df, checks).where("failures > 0").collect()
    if failed:
        told = ", ".join(f"{r.check_kind}({r.column_name}): {r.failures}" for r in failed)
        raise QualityError(told)
