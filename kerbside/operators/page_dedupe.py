"""Which landed pages are new.

Each filter decides once. ``keep_if_changed`` decides on slim rows (page, hash, order) and lets the bodies pass a semi join;
``keep_if_unseen`` groups the batch by hash and joins the slim history in the same layout. Both cut each map-side partition
to one body per page or hash before bodies move. Raw tables and pages are compared as structs, so an unknown provider or
endpoint is a raw table like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.clock import time_chunk
from kerbside.functions.pages import content_hash
from kerbside.operators.latest import first_per_key
from kerbside.operators.timeline import lag_by

TABLE = ("provider", "endpoint")
PAGE_KEY = ("provider", "endpoint", "filename")
HOUR = 3600


def with_hash(pages: DataFrame) -> DataFrame:
    """Pages with ``md5_hash`` filled from their content."""
    return pages.withColumn("md5_hash", content_hash(F.col("content")))


def _identified(pages: DataFrame, page_key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``_page`` tells pages apart: a name may come again, with another body or at another time."""
    parts = list(dict.fromkeys([*page_key, *order, "md5_hash"]))
    return pages.withColumn("_page", F.struct(*parts)).withColumn("_table", F.struct(*TABLE))


def _first_known(pages: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first page of each key; pages without a hash are keys of their own and all stay."""
    own = F.when(F.col("md5_hash").isNull(), F.monotonically_increasing_id())
    ranked = [F.col(name).asc_nulls_last() for name in order]
    return first_per_key(pages.withColumn("_own", own), [*keys, "_own"], ranked, ["_page"]).drop("_own")


def last_hashes(stored: DataFrame) -> DataFrame:
    """Hash of the page stored last in each raw table: ``provider, endpoint, load_ts, md5_hash``.

    A NULL load time counts as the newest.
    """
    newest = F.max(F.struct(F.col("load_ts").isNull().alias("open"), F.col("load_ts").alias("load_ts"), F.col("md5_hash").alias("md5_hash")))
    return stored.groupBy(*TABLE).agg(newest.alias("last")).select(*TABLE, "last.load_ts", "last.md5_hash")


def keep_if_changed(new: DataFrame, stored: DataFrame | None = None, order: Sequence[str] = ("load_ts", "filename"),
                    page_key: Sequence[str] = PAGE_KEY, chunk_seconds: int = HOUR) -> DataFrame:
    """New pages whose hash differs from the page before them in the same raw table.

    The page before the first new one is the page stored last. The sequence A, B, A keeps all three. A
    missing hash equals nothing. ``new`` must come after ``stored`` and needs ``md5_hash``. The first ``order``
    column is a timestamp that spreads the pages over time; pages of one instant go on in the order of the others.
    """
    pages = _identified(new, page_key, order)
    # A copy equals the one before it, so copies need not be merged here: their page is decided by the first of them.
    slim = pages.select("_page", "_table", *order, "md5_hash", F.lit(True).alias("_new"))
    if stored is not None:
        # The stored page gets an order before every new page and its own, earliest chunk.
        seed = last_hashes(stored).select(F.struct(*TABLE).alias("_table"), "md5_hash", F.lit(False).alias("_new"))
        slim = slim.unionByName(seed, allowMissingColumns=True)
    chunk = F.when(F.col("_new"), time_chunk(F.col(order[0]), chunk_seconds)).otherwise(F.lit(-(2**62)).cast("bigint"))
    told = lag_by(slim, ["_table"], [*order, "md5_hash"], chunk, ["md5_hash"])
    repeated = F.coalesce(F.col("prev")["md5_hash"] == F.col("md5_hash"), F.lit(False))
    kept = told.where(F.col("_new") & ~repeated).select("_page")
    # Copies that agree in name, order and hash are one page.
    return _first_known(pages.join(kept, "_page", "left_semi"), ["_page"], ()).drop("_page", "_table")


def keep_if_unseen(new: DataFrame, stored: DataFrame | None = None, order: Sequence[str] = ("load_ts", "filename"),
                   page_key: Sequence[str] = PAGE_KEY) -> DataFrame:
    """New pages whose hash was never stored in the same raw table; of equal new pages the first stays.

    A missing hash was never seen.
    """
    firsts = _first_known(_identified(new, page_key, order), ["_table", "md5_hash"], order)
    if stored is not None:
        # A hash that is NULL equals nothing. The history arrives in the layout that the batch already has.
        seen = stored.select(F.struct(*TABLE).alias("_table"), "md5_hash").where(F.col("md5_hash").isNotNull())
        firsts = firsts.join(seen, ["_table", "md5_hash"], "left_anti")
    return firsts.drop("_page", "_table")


def drop_empty(pages: DataFrame, leaf: str = "leaf") -> DataFrame:
    """Drop pages without payload.

    The payload is ``data.<leaf>`` where the page has that key, else the whole body. It is empty when it
    is null, an empty array, object or string, zero or false.
    """
    data = F.get_json_object("content", "$.data")
    named = F.coalesce(F.array_contains(F.json_object_keys(data), F.col(leaf)), F.lit(False))
    inner = F.expr(f"get_json_object(content, concat('$.data.', `{leaf}`))")
    body = F.when(named, inner).otherwise(F.trim("content"))
    return pages.where(~F.coalesce(body, F.lit("null")).rlike(r'^(\[\s*\]|\{\s*\}|null|false|0|0\.0|""|)$'))
