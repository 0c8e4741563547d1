"""Correction lists and table dumps in CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schemas import SEED


def read_seed(spark: SparkSession, path: str, provider: str) -> DataFrame:
    """A list of lost vehicles: ``provider_name, TRIP_ID, VEHICLE_ID, VEHICLE_TYPE``."""
    rows = spark.read.schema(SEED).option("header", True).option("quote", '"').csv(path)
    return rows.select(F.lit(provider).alias("provider_name"), "TRIP_ID", "VEHICLE_ID", "VEHICLE_TYPE")


def import_dump(spark: SparkSession, source: str, schema: str, target: str, multi_line: bool = False) -> None:
    """Append a CSV dump to a Parquet table. A row that does not fit fails the import before anything is added.

    Files are read in splits; ``multi_line`` allows line breaks inside quotes, at one task per file.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(source)
    )
    rows.write.mode("append").parquet(target)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table whose older files may lack newer columns; these are NULL there."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)
