"""Landed JSON page files, one document per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.catalogue import file_slugs
from kerbside.functions.pages import content_hash

# File names of pages and of merged telemetry hours.
PAGE_NAME = r"^([a-z]+)_(.+)_(\d{4}-\d{2}-\d{2}T\d{2}|\d{4}-\d{2}-\d{2}|\d{8})_p(\d+)\.json$"
TELEMETRY_NAME = r"^telemetry_(\d{4}-\d{2}-\d{2}T\d{2})\.json$"
HOUR_FORMAT = "yyyy-MM-dd'T'HH"


def page_filename(provider: Column, slug: Column, time: Column, page_no: Column) -> Column:
    """``{provider}_{endpoint}_{time}_p{n}.json``"""
    return F.concat(provider, F.lit("_"), slug, F.lit("_"), time, F.lit("_p"), page_no.cast("string"), F.lit(".json"))


def name_time(text: Column) -> Column:
    """Time part of a file name (hour, day or compact day) as a timestamp, NULL if it is none of these."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(HOUR_FORMAT)),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(text, F.lit("yyyyMMdd")),
    )


def parse_names(files: DataFrame, now: Column | None = None) -> DataFrame:
    """Add ``provider, slug, page_no, page_time, file_ts`` taken from ``filename``.

    Merged telemetry hours belong to Dott. A name without a readable time gets the current time as
    ``file_ts``; a name that fits no pattern keeps a NULL provider.
    """
    name = F.col("filename")
    is_telemetry = name.startswith("telemetry_")

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(name, PAGE_NAME, i), F.lit(""))

    hour = F.nullif(F.regexp_extract(name, TELEMETRY_NAME, 1), F.lit(""))
    time = F.when(is_telemetry, hour).otherwise(part(3))
    return files.withColumns(
        {
            "provider": F.when(is_telemetry, F.lit("dott")).otherwise(part(1)),
            "slug": F.when(is_telemetry, F.lit("telemetry")).otherwise(part(2)),
            "page_no": F.when(is_telemetry, F.lit(1)).otherwise(part(4).try_cast("int")),
            "page_time": name_time(time),
            "file_ts": F.coalesce(name_time(time), now if now is not None else F.current_timestamp()),
        }
    )


def wrap_telemetry(content: Column, filename: Column) -> Column:
    """Put a bare telemetry array under a ``telemetry`` key; other bodies stay as they are."""
    bare = filename.startswith("telemetry_") & F.ltrim(content).startswith("[")
    return F.when(bare, F.concat(F.lit('{"telemetry":'), content, F.lit("}"))).otherwise(content)


def to_envelope(files: DataFrame, now: Column | None = None) -> DataFrame:
    """Files ``(content, filename)`` as bronze rows plus ``page_no, page_time, leaf``.

    Rows whose name belongs to no catalogue endpoint keep a NULL ``endpoint``. ``leaf`` is the payload
    key under ``data``.
    """
    named = parse_names(files, now)
    spark = files.sparkSession
    known = file_slugs(spark).select(
        "provider", "slug", F.col("table_suffix"), F.element_at(F.split("endpoint", "/"), -1).alias("leaf")
    )
    # The list of names is fixed and short.
    joined = named.join(F.broadcast(known), ["provider", "slug"], "left")
    content = wrap_telemetry(F.col("content"), F.col("filename"))
    return joined.select(
        F.upper("provider").alias("provider"),
        F.col("table_suffix").alias("endpoint"),
        content.alias("content"),
        "filename",
        "file_ts",
        content_hash(content).alias("md5_hash"),
        *[c for c in files.columns if c not in ("content", "filename")],
        "page_no",
        "page_time",
        "leaf",
    )


def read_pages(spark: SparkSession, path: str, now: Column | None = None) -> DataFrame:
    """Bronze rows of all page files under ``path``, with the full ``path`` as a unique page key."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    named = files.select(
        F.col("value").alias("content"),
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
    )
    return to_envelope(named, now)


def merged_items(pages: DataFrame, path: str = "telemetry") -> DataFrame:
    """The items of all pages of an hour as one list of rows: ``provider, endpoint, hour, page_no, pos, item``.

    The list stays rows, in page order by ``(page_no, pos)``: an hour may be larger than one value.
    """
    items = F.from_json("content", f"struct<{path}:array<string>>")[path]
    return pages.select(
        "provider", "endpoint", F.date_trunc("hour", "page_time").alias("hour"), "page_no", F.posexplode(items).alias("pos", "item")
    )


def hour_pages(items: DataFrame, path: str = "telemetry", size: int = 1000) -> DataFrame:
    """Merged items as pages again, at most ``size`` items each, with the name of their hour's file.

    Pages delivered under one number hold items of one place: the first of each place go together, then the second ones.
    """
    hour = F.date_format("hour", HOUR_FORMAT)
    place = Window.partitionBy("provider", "endpoint", "hour", "page_no", "pos").orderBy("item")
    told = items.withColumn("copy", F.row_number().over(place))
    packed = told.groupBy("provider", "endpoint", "hour", "page_no", F.floor(F.col("pos") / size).alias("part"), "copy").agg(
        F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("sorted")
    )
    body = F.concat(F.lit(f'{{"{path}":['), F.array_join(F.transform("sorted", lambda s: s["item"]), ","), F.lit("]}"))
    return packed.select(
        "provider", "endpoint", body.alias("content"), F.concat(F.lit(f"{path}_"), hour, F.lit(".json")).alias("filename"),
        F.col("hour").alias("file_ts"), content_hash(body).alias("md5_hash"), "page_no", F.col("hour").alias("page_time"),
    )


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The merged items that ``write_hours`` has written."""
    lines = "provider string, endpoint string, page_no int, pos int, item string, hour string"
    return spark.read.schema(lines).json(path).withColumn("hour", F.to_timestamp("hour", HOUR_FORMAT))


def write_hours(items: DataFrame, path: str) -> None:
    """Write merged items as JSON lines, one folder per hour.

    Rows of an hour are brought together, so a task writes few folders; an hour that holds most of the
    rows is split among tasks.
    """
    hour = F.date_format("hour", HOUR_FORMAT)
    (
        items.select(hour.alias("hour"), "provider", "endpoint", "page_no", "pos", "item")
        .hint("rebalance", "hour")
        .write.mode("append")
        .partitionBy("hour")
        .json(path)
    )
