"""What the landing remembers of stored pages, so that a batch is decided without a scan of bronze.

Below one folder lie

* ``seen/gen=G``: every hash stored, partitioned by raw table and the first digits of the hash. A batch opens only the
  partitions that its own hashes name, by literals of the scan;
* ``last/batch=N``: the hash of the page offered last in each raw table, after batch N;
* ``begun/batch=N``: the instant that batch N stamps its pages with, noted before any page is stored;
* ``whole/batch=N``: marks of the batches that are done, batch -1 being what bronze held before the first.

A batch that died is repeated under its number: it decides on the state before it and leaves out the pages that bronze
already holds under its own instant. A batch that is done is skipped. One writer per state folder.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.operators.page_dedupe import TABLE, keep_if_changed, keep_if_unseen, last_hashes
from kerbside.operators.upsert import drop, exists
from kerbside.sources.bronze import append_pages, read_bronze

DIGITS = 2
INDEX = "md5_hash string, provider string, endpoint string, prefix string"
LAST = "provider string, endpoint string, load_ts timestamp, md5_hash string"
RULES = ("seen", "changed")
STORED_PAGE = (*TABLE, "filename", "md5_hash")


def _prefix() -> Column:
    return F.substring("md5_hash", 1, DIGITS)


def _write_index(rows: DataFrame, place: str, mode: str) -> None:
    # Rows of a partition are brought together, so a task writes few files; a partition with most of the rows is split.
    spread = rows.distinct().withColumn("prefix", _prefix()).hint("rebalance", *TABLE, "prefix")
    spread.sortWithinPartitions(*TABLE, "prefix", "md5_hash").write.mode(mode).partitionBy(*TABLE, "prefix").parquet(place)


def _newest(spark: SparkSession, marks: str, column: str) -> int | None:
    if not exists(spark, marks):
        return None
    return spark.read.schema(f"done boolean, {column} int").parquet(marks).agg(F.max(column)).first()[0]


def _mark(spark: SparkSession, place: str) -> None:
    spark.range(1).select(F.lit(True).alias("done")).coalesce(1).write.mode("overwrite").parquet(place)


def _index_place(spark: SparkSession, state: str) -> str:
    return f"{state}/seen/gen={_newest(spark, f'{state}/folded', 'gen') or 0}"


def add_hashes(pages: DataFrame, state: str) -> None:
    """Add the hashes of ``pages`` to the index. A hash that is added twice does no harm."""
    known = pages.where(F.col("md5_hash").isNotNull()).select(*TABLE, "md5_hash")
    _write_index(known, _index_place(pages.sparkSession, state), "append")


def seen_hashes(pages: DataFrame, state: str) -> DataFrame | None:
    """The part of the index that can hold hashes of ``pages``: ``provider, endpoint, md5_hash``; None before the first.

    The partitions are named by literals, no more than raw tables times ``16 ** DIGITS``.
    """
    spark = pages.sparkSession
    place = _index_place(spark, state)
    if not exists(spark, place):
        return None
    named = pages.where(F.col("md5_hash").isNotNull()).groupBy(*TABLE).agg(F.collect_set(_prefix()).alias("prefixes")).collect()
    table = [(F.col("provider").eqNullSafe(r.provider) & F.col("endpoint").eqNullSafe(r.endpoint), r.prefixes) for r in named]
    wanted = reduce(or_, [one & F.col("prefix").isin(prefixes) for one, prefixes in table], F.lit(False))
    return spark.read.schema(INDEX).parquet(place).where(wanted).select(*TABLE, "md5_hash")


def compact(spark: SparkSession, state: str) -> None:
    """Fold the small files of the index into a new generation, which counts once it is whole. Between batches only."""
    gen = _newest(spark, f"{state}/folded", "gen") or 0
    old, new = (f"{state}/seen/gen={n}" for n in (gen, gen + 1))
    if exists(spark, old):
        _write_index(spark.read.schema(INDEX).parquet(old).select(*TABLE, "md5_hash"), new, "overwrite")
        _mark(spark, f"{state}/folded/gen={gen + 1}")
        drop(spark, old)


def _write_last(last: DataFrame, state: str, batch: int) -> None:
    last.select("provider", "endpoint", "load_ts", "md5_hash").coalesce(1).write.mode("overwrite").parquet(f"{state}/last/batch={batch}")


def _read_last(spark: SparkSession, state: str, batch: int) -> DataFrame:
    return spark.read.schema(LAST).parquet(f"{state}/last/batch={batch}")


def _prepare(spark: SparkSession, bronze: str, state: str) -> int:
    """Number of the last batch that is done. A new state takes up what bronze already holds, in slim columns and once."""
    done = _newest(spark, f"{state}/whole", "batch")
    if done is not None:
        return done
    if exists(spark, bronze):
        stored = read_bronze(spark, bronze)
        add_hashes(stored, state)
        _write_last(last_hashes(stored), state, -1)
    else:
        _write_last(spark.createDataFrame([], LAST), state, -1)
    _mark(spark, f"{state}/whole/batch=-1")
    return -1


def _instant(spark: SparkSession, state: str, batch: int) -> tuple[Column, bool]:
    """The instant of a batch, and whether the batch had begun before."""
    place = f"{state}/begun/batch={batch}"
    noted = spark.read.schema("at long").parquet(place).first() if exists(spark, place) else None
    if noted is not None:
        return F.timestamp_micros(F.lit(noted.at)), True
    at = spark.range(1).select(F.unix_micros(F.current_timestamp()).alias("at")).first().at
    spark.createDataFrame([(at,)], "at long").coalesce(1).write.mode("overwrite").parquet(place)
    return F.timestamp_micros(F.lit(at)), False


def _stamped(spark: SparkSession, bronze: str, instant: Column) -> DataFrame:
    """Pages that bronze holds under an instant: one load date is opened."""
    return read_bronze(spark, bronze).where((F.col("load_date") == F.to_date(instant)) & (F.col("load_ts") == instant))


def _without(pages: DataFrame, stored: DataFrame, order: Sequence[str]) -> DataFrame:
    """Pages less those stored, copy for copy: pages of one name and hash are interchangeable."""
    key = F.struct(*STORED_PAGE)
    counted = pages.withColumn("_key", key).withColumn("_copy", F.row_number().over(Window.partitionBy("_key").orderBy(*order)))
    there = stored.select(key.alias("_key")).withColumn("_copy", F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0))))
    return counted.join(there, ["_key", "_copy"], "left_anti").drop("_key", "_copy")


def land(pages: DataFrame, bronze: str, state: str, batch: int, rule: str = "seen",
         order: Sequence[str] = ("landed_at", "path"), page_key: Sequence[str] = ("path",)) -> bool:
    """Append the pages of batch number ``batch`` that are new by ``rule`` and keep the state; False for a batch already done.

    ``seen``: pages whose hash was never stored in their raw table. ``changed``: pages that differ from the page before
    them there, so A, B, A keeps all three. Both sides of the state are kept, so the rule may change between batches. A
    missing hash equals nothing. ``pages`` need ``md5_hash`` and come after those of earlier batches.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule}: one of {RULES}")
    spark = pages.sparkSession
    done = _prepare(spark, bronze, state)
    if batch <= done:
        return False
    instant, repeated = _instant(spark, state, batch)
    last = _read_last(spark, state, done)
    # Hashes are worked out once; a lost executor's part is worked out again.
    offered = pages.persist()
    try:
        # The only job over the batch as it comes: those that follow find its pages held, also where they run side by side.
        rank = F.struct(*[c for name in order for c in (F.col(name).isNull().alias(f"{name}_null"), F.col(name).alias(name))], "md5_hash")
        mine = offered.groupBy(*TABLE).agg(F.max_by("md5_hash", rank).alias("md5_hash")).select(*TABLE, instant.alias("load_ts"), "md5_hash")
        both = last.withColumn("n", F.lit(0)).unionByName(mine.withColumn("n", F.lit(1)))
        newest = both.groupBy(*TABLE).agg(F.max_by(F.struct("load_ts", "md5_hash"), "n").alias("kept")).select(*TABLE, "kept.*")
        _write_last(newest, state, batch)
        if rule == "seen":
            kept = keep_if_unseen(offered, seen_hashes(offered, state), order, page_key)
        else:
            kept = keep_if_changed(offered, last, order, page_key)
        if repeated and exists(spark, bronze):
            kept = _without(kept, _stamped(spark, bronze, instant), order)
        append_pages(kept.withColumn("load_ts", instant), bronze)
        add_hashes(_stamped(spark, bronze, instant), state)
    finally:
        offered.unpersist()
    _mark(spark, f"{state}/whole/batch={batch}")
    # The newest mark stays, and the state it stands for.
    for part in ("whole", "last", "begun"):
        drop(spark, f"{state}/{part}/batch={done}")
    return True
