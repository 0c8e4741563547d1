"""What the operators share: the cluster's shared folder, tables written there, and Arrow maps over whole texts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts are handed to numpy in slices of about this many bytes, so that its work arrays stay small; one text is never cut.
SLICE_BYTES = 2 << 20

_own_folder: str | None = None


_shipped_to: str | None = None


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python, once per application."""
    global _shipped_to
    context = spark.sparkContext
    if _shipped_to == context.applicationId:
        return
    package = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp(prefix="kerbside-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in [package / "__init__.py", package / "session.py", *sorted(Path(__file__).parent.glob("*.py"))]:
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped_to = context.applicationId


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Local mode, as in tests, can do without."""
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = "file://" + tempfile.mkdtemp(prefix="kerbside-")
    return _own_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lost executors then cost no recomputation of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(column: str = "text"):
    """A hash of the text; with doc_id it tells rows apart where an id is repeated."""
    return F.xxhash64(F.col(column))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_texts(
    docs: DataFrame,
    make: Callable[[pa.Array], list],
    fields: list[T.StructField],
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per row of ``docs``: its ``keep`` columns and the columns that ``make`` derives from a slice of texts.

    ``make`` gets the texts as an Arrow array and returns one list or array per field. No shuffle; other columns of
    ``docs`` are not read.
    """
    schema = T.StructType([docs.schema[k] for k in keep] + fields)
    arrow = {f.name: arrow_type(f.dataType) for f in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = make(part.column("text"))
                columns = [part.column(k) for k in keep]
                columns += [pa.array(x, type=t) for x, t in zip(made, arrow.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *arrow])

    ship(docs.sparkSession)
    return docs.select(*[F.col(k) for k in keep if k != "text"], "text").mapInArrow(run, schema)


def filter_texts(docs: DataFrame, keeps: Callable[[pa.Array], list[bool]]) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text ``keeps`` says yes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(keeps(part.column("text")), pa.bool_()))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return {
        "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "boolean": pa.bool_(), "binary": pa.binary(),
    }[kind.simpleString()]


def field(name: str, kind: str) -> T.StructField:
    """A nullable field; ``[kind]`` is an array."""
    return T.StructField(name, _SIMPLE[kind])


_SIMPLE = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "float": T.FloatType(), "boolean": T.BooleanType(), "binary": T.BinaryType(),
}
_SIMPLE |= {f"[{k}]": T.ArrayType(v) for k, v in list(_SIMPLE.items())}
