"""The bronze table: landed pages in one envelope, partitioned by provider, endpoint and load date."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schemas import BRONZE

PARTITIONS = ("provider", "endpoint", "load_date")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The stored pages. Files written before a column existed show it as NULL."""
    schema = f"{BRONZE}, load_date date"
    return spark.read.schema(schema).parquet(path)


Bronze = DataFrame | Mapping[str, DataFrame]


def scan(bronze: Bronze, provider: str, endpoint: str) -> DataFrame:
    """Pages of one raw table.

    ``bronze`` is the stored table, which is pruned to the partitions of the raw table, or a mapping
    from raw table names such as ``VOI_TRIPS`` to their pages.
    """
    if isinstance(bronze, Mapping):
        return bronze[f"{provider}_{endpoint}"]
    return bronze.where((F.col("provider") == provider) & (F.col("endpoint") == endpoint))


def new_files(spark: SparkSession, table: DataFrame, noted: DataFrame) -> list[str]:
    """Files of a stored table that ``noted`` (``file``) does not name. Names pass the driver, as Spark's own listing does."""
    there = spark.createDataFrame([(name,) for name in table.inputFiles()], "file string")
    return [r.file for r in there.join(noted, "file", "left_anti").collect()]


def append_pages(pages: DataFrame, path: str, load_ts: Column | None = None) -> None:
    """Append pages. ``load_ts`` defaults to the current time for pages that have none."""
    now = load_ts if load_ts is not None else F.current_timestamp()
    stamped = pages.withColumn("load_ts", F.coalesce("load_ts", now) if "load_ts" in pages.columns else now)
    if "md5_hash" not in stamped.columns:
        stamped = stamped.withColumn("md5_hash", F.lit(None).cast("string"))
    for column, kind in (("page_no", "int"), ("page_time", "timestamp")):
        if column not in stamped.columns:
            stamped = stamped.withColumn(column, F.lit(None).cast(kind))
    (
        stamped.select("provider", "endpoint", "content", "filename", "file_ts", "md5_hash", "load_ts", "page_no", "page_time")
        .withColumn("load_date", F.to_date("load_ts"))
        .write.mode("append")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
