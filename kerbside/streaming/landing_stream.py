"""Take up newly landed page files with a file stream.

Each trigger handles the files that arrived since the last one and appends the new pages to bronze, by one of the rules
of ``page_state.land``. The stream's own checkpoint remembers the files, a folder in it the hashes: bronze is not read
to decide, but for one slim pass when the folder is new. A batch that died is repeated without storing a page twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.operators.page_dedupe import drop_empty
from kerbside.sources.landing import to_envelope
from kerbside.sources.page_state import land

FILE_SCHEMA = "value string"


def take_up(spark: SparkSession, landing: str, bronze: str, checkpoint: str, quarantine: str | None = None,
            rule: str = "seen") -> StreamingQuery:
    """Start a stream that drains ``landing`` once and stops.

    ``rule`` ``seen`` keeps pages whose hash was never stored, ``changed`` those that differ from the page before them.
    Pages without payload are dropped; files of unknown name go to ``quarantine`` (by default beside the bronze table).
    """
    files = (
        spark.readStream.schema(FILE_SCHEMA)
        .text(landing, wholetext=True, recursiveFileLookup=True)
        .select(
            F.col("value").alias("content"),
            F.col("_metadata.file_name").alias("filename"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_modification_time").alias("landed_at"),
        )
    )

    def append_new(batch: DataFrame, batch_id: int) -> None:
        named = to_envelope(batch)
        # A file of unknown name is kept with its body: the checkpoint will not offer it again.
        unknown = named.where(F.col("endpoint").isNull())
        unknown.select("path", "filename", "content", "landed_at").write.mode("append").parquet(quarantine or f"{bronze}_unknown")
        pages = drop_empty(named.where(F.col("endpoint").isNotNull()))
        land(pages, bronze, f"{checkpoint}/pages", batch_id, rule)

    return (
        files.writeStream.foreachBatch(append_new)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
