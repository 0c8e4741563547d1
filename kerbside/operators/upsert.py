"""Incremental marts: slices, keyed upserts and checked publication on Parquet."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.quality import Check, require

DAY_LOOKBACK = "INTERVAL 1 DAY"


def slice_start(target: DataFrame, ts: str, lookback: str = DAY_LOOKBACK) -> Column:
    """Start of the incremental slice: the newest stored instant less the look-back, NULL for an empty target."""
    return target.agg((F.max(ts) - F.expr(lookback)).alias("start")).scalar()


def incremental_slice(df: DataFrame, ts: str, target: DataFrame | None, target_ts: str, lookback: str = DAY_LOOKBACK) -> DataFrame:
    """Rows from the slice start on; everything when there is no target or it is empty."""
    if target is None:
        return df
    start = slice_start(target, target_ts, lookback)
    return df.where(start.isNull() | (F.col(ts) >= start))


def late_rows(df: DataFrame, ts: str, target: DataFrame, target_ts: str, lookback: str = DAY_LOOKBACK) -> DataFrame:
    """One row with the number of rows too old for the slice: they never reach the target."""
    start = slice_start(target, target_ts, lookback)
    return df.where(F.col(ts) < start).agg(F.count("*").alias("late_rows"))


def upsert(existing: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key the batch does not name, and the batch. NULL keys never match."""
    if existing is None:
        return batch
    return unnamed(existing, batch, key).unionByName(batch, allowMissingColumns=True)


def unnamed(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key the batch does not name."""
    return existing.join(batch.select(key), key, "left_anti").select(*existing.columns)


def key_bucket(key: Column, buckets: int) -> Column:
    """Partition number that depends on the key alone, so a key never moves between partitions."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def key_date(ts: Column) -> Column:
    """Partition date of rows whose key contains the instant."""
    return F.coalesce(F.to_date(ts), F.lit("9999-12-31").cast("date"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at ``path``, asked of the file system alone."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def drop(spark: SparkSession, path: str) -> None:
    """Remove what lies at ``path``, if anything."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_mart(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The stored mart, None before its first load. Older files may lack newer columns.

    With ``schema`` no file is opened to learn the columns.
    """
    if not exists(spark, path):
        return None
    return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.option("mergeSchema", "true").parquet(path)


def in_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose ``column`` is among a few ``values``, NULL included: literals, so that partitions are pruned."""
    wanted = F.col(column).isin([v for v in values if v is not None])
    return df.where(wanted | F.col(column).isNull() if None in values else wanted)


def _mart_schema(spark: SparkSession, mart: str) -> T.StructType:
    """All columns of the mart, as ``publish`` notes them; marts without a note are asked file by file."""
    if exists(spark, f"{mart}/_columns"):
        return T.StructType.fromJson(json.loads(spark.read.text(f"{mart}/_columns", wholetext=True).first()[0]))
    return read_mart(spark, mart).schema


def _note_schema(spark: SparkSession, mart: str, schema: T.StructType) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{mart}/_columns")


def merged_schema(stored: T.StructType, batch: T.StructType) -> T.StructType:
    """The batch's columns, then those that only the mart has. A column of two types is refused."""
    known = {f.name.lower(): f for f in batch.fields}
    for f in stored.fields:
        mine = known.get(f.name.lower())
        if mine is not None and mine.dataType.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name}: {mine.dataType.simpleString()} in the batch, {f.dataType.simpleString()} in the mart")
    return T.StructType([*batch.fields, *[f for f in stored.fields if f.name.lower() not in known]])


def publish(spark: SparkSession, batch: DataFrame, mart: str, staging: str, key: str, partition: str,
            partition_value: Column, checks: Sequence[Check] = (), also: Sequence = ()) -> None:
    """Upsert ``batch`` into the Parquet mart, after its checks have passed.

    ``partition_value`` must follow from the key, or ``also`` must name every other partition that can hold a row of the
    batch's keys: then only these partitions are read and rewritten, whatever the size of the mart, and no partition is
    ever left with stale rows. Their values, no more than the mart has partitions, become literals of the scan. Columns
    that only one side has are kept, NULL on the other; one of two types is refused. The batch and the stored rows
    beside it are written to ``staging`` (a new folder per run) once each, checked there together and then swapped in with
    one dynamic partition overwrite; partitions that have lost all rows are removed after it. When a check fails the
    mart is untouched.
    """
    batch_path, kept_path = f"{staging}/batch", f"{staging}/kept"
    batch = batch.withColumn(partition, partition_value)
    batch.write.mode("overwrite").parquet(batch_path)
    staged = spark.read.schema(batch.schema).parquet(batch_path)

    ready, noted, schema = staged, None, staged.schema
    named = _partitions(staged, partition)
    if exists(spark, mart):
        noted = _mart_schema(spark, mart)
        # The type of a partition column is guessed from folder names where it is not noted.
        schema = merged_schema(T.StructType([f for f in noted.fields if f.name != partition]), staged.schema)
        stored = in_values(read_mart(spark, mart, schema), partition, list({*named, *also}))
        unnamed(stored, staged, key).write.mode("overwrite").parquet(kept_path)
        kept = spark.read.schema(stored.schema).parquet(kept_path)
        ready = kept.unionByName(staged, allowMissingColumns=True)
    require(ready, checks)
    same = noted is not None and {f.name for f in noted.fields} == {f.name for f in schema.fields}
    if noted is not None and not same:
        _note_schema(spark, mart, schema)
    (
        # Few files per partition, and a partition that holds most of the rows is split among tasks.
        ready.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(mart)
    )
    if noted is None:
        _note_schema(spark, mart, schema)
    emptied = set(also) - set(named)
    for value in emptied and emptied - set(_partitions(ready, partition)):
        drop(spark, f"{mart}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")


def _partitions(df: DataFrame, partition: str) -> list:
    return [r[0] for r in df.select(partition).distinct().collect()]
