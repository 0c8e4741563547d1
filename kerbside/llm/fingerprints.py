"""Document fingerprints: threshold-scaled sketches of word shingles.

``docs`` needs doc_id and text; other columns are not read. A null text counts as empty: its fingerprint is the empty
string, and two empty fingerprints are alike (1.0), an empty and another one not (0.0). Repeated rows and ids are
sketched each. An empty table gives an empty table.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so sketches of unequal texts share one
threshold: they merge by union, and containment and likeness are plain set ratios. A text none of whose hashes lies
below it keeps its smallest hash alone; a merged sketch drops such hashes as soon as it has one below the threshold.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import SLICE_BYTES, arrow_type, field, map_texts, ship, slices, text_bytes, text_key

SHINGLE = 5
# One shingle hash in so many is kept.
SCALE = 4
# Rows of a range of ids that are put in order together; the number of ranges follows from it.
RANGE_ROWS = 4000
# No more ranges than this, as their bounds and opening rows (some 40 bytes each) are sent to all; beyond, ranges grow.
MAX_RANGES = 1 << 16

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_LETTER = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown as needed and kept by the worker."""
    if len(_known[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _known[i] = np.cumprod(factors, dtype=np.uint64)
    return _known[0][:n], _known[1][:n]


_known = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketches(texts: list[bytes], shingle: int = SHINGLE, scale: int = SCALE) -> list[np.ndarray]:
    """The sorted distinct hashes that each text keeps. Words end at ASCII white space, A-Z count as a-z."""
    joined = b" ".join(texts).translate(_LOWER) + b" "
    raw = np.frombuffer(joined, np.uint8)
    up, down = _powers(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * up, dtype=np.uint64)])
    letter = np.concatenate([[False], _LETTER[raw], [False]])
    starts = np.flatnonzero(letter[1:] & ~letter[:-1])
    ends = np.flatnonzero(letter[:-1] & ~letter[1:])
    words = _stir((total[ends] - total[starts]) * down[starts])
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    first = np.searchsorted(starts, bounds)
    limit = np.uint64((1 << 64) // scale)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        n = int(b - a)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        width = min(shingle, n)
        mixed = np.zeros(n - width + 1, np.uint64)
        for i in range(width):
            mixed = mixed * _MIX + words[a + i : b - width + i + 1]
        hashes = _stir(mixed)
        kept = hashes[hashes < limit]
        out.append(np.unique(kept) if len(kept) else hashes.min(keepdims=True))
    return out


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8")


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of two texts together."""
    both = np.union1d(a, b)
    below = both[both < np.uint64((1 << 64) // scale)]
    return below if len(below) else both[:1]


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard likeness of the shingle sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    shared = _shared(a, b)
    return shared / (len(a) + len(b) - shared)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has too; b may be far longer."""
    return _shared(a, b) / len(a) if len(a) else 1.0


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """doc_id and fingerprint of every row."""

    def make(texts: pa.Array) -> list:
        return [[encode(s) for s in sketches(text_bytes(texts), shingle, scale)]]

    return map_texts(docs, make, [field("fingerprint", "string")])


def with_next(docs: DataFrame, rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text and next_text, the text of the next row by ascending doc_id (ties by text); after the last, the first.

    Rows are dealt into ranges of ids, each put in order by itself; the first row of a range is also sent to the range
    before it. Null ids come last. The driver holds the bounds of the ranges.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spark = docs.sparkSession
    count = docs.count()
    parts = min(MAX_RANGES, -(-count // rows))
    ids = docs.select(F.col("doc_id").cast("double").alias("id")).filter("id IS NOT NULL")
    cuts = sorted(set(ids.approxQuantile("id", [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []
    cutter = Bucketizer(splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="id", outputCol="range", handleInvalid="keep")
    dealt = cutter.transform(docs.withColumn("id", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan"))))).withColumn("range", F.col("range").cast("int")).drop("id")
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), text_key().alias("k"))
    firsts = dealt.groupBy("range").agg(F.min(place).alias("f")).orderBy("range").select("range", "f.doc_id", "f.k").collect()
    if not firsts:
        return docs.withColumn("next_text", F.lit(None).cast("string"))
    # the row that opens a range closes the range before it; the very first row closes the last range
    before = {r["range"]: firsts[i - 1]["range"] for i, r in enumerate(firsts)}
    opening = spark.createDataFrame(
        [(r["range"], r["doc_id"], r["k"], before[r["range"]]) for r in firsts],
        T.StructType([T.StructField("o_range", T.IntegerType()), T.StructField("o_id", docs.schema["doc_id"].dataType), T.StructField("o_key", T.LongType()), T.StructField("o_before", T.IntegerType())]),
    )
    key = text_key()
    opens = (F.col("range") == F.col("o_range")) & F.col("doc_id").eqNullSafe(F.col("o_id")) & (key == F.col("o_key"))
    marked = dealt.join(F.broadcast(opening), opens, "left")  # MAX_RANGES slim rows at most
    place_in = lambda closing, at: F.struct(F.lit(closing).alias("closing"), F.col(at).alias("range"))
    own = F.array(place_in(False, "range"))
    spread = F.when(F.col("o_before").isNull(), own).otherwise(F.array_append(own, place_in(True, "o_before")))
    sent = marked.select("doc_id", "text", F.explode(spread).alias("s")).select("doc_id", "text", "s.closing", "s.range")
    line = Window.partitionBy("range").orderBy("closing", F.col("doc_id").isNull(), "doc_id", text_key())
    return sent.withColumn("next_text", F.lead("text").over(line)).filter("NOT closing").select("doc_id", "text", "next_text")


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    part = len(text) // 4
    return text[: len(text) - part] + following[:part]


def compare_edits(docs: DataFrame, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness, also to the next text's."""
    fields = [
        field("n_chars", "bigint"), field("edited_sha256", "string"), field("fingerprint", "string"), field("edited_fingerprint", "string"),
        field("near_edited", "double"), field("near_next", "double"),
    ]

    def rows(own: list[str], following: list[str]) -> list:
        n = len(own)
        changed = [edited(a, b) for a, b in zip(own, following, strict=True)]
        # the next text is mostly the next row, and sketched there
        apart = [i for i in range(n) if i + 1 == n or following[i] != own[i + 1]]
        raw = [t.encode() for t in own + changed + [following[i] for i in apart]]
        prints = sketches(raw, shingle, scale)
        mine, theirs = prints[:n], prints[n : 2 * n]
        others = [*mine[1:], mine[0]] if n else []
        for i, sketch in zip(apart, prints[2 * n :], strict=True):
            others[i] = sketch
        return [
            [len(t) for t in own], [hashlib.sha256(t).hexdigest() for t in raw[n : 2 * n]], list(map(encode, mine)), list(map(encode, theirs)),
            list(map(likeness, mine, theirs)), list(map(likeness, mine, others)),
        ]

    paired = with_next(docs)
    schema = T.StructType([paired.schema["doc_id"], *fields])
    types = [arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES // 2):
                own, following = (part.column(c).to_pylist() for c in ("text", "next_text"))
                made = rows(own, [t or "" for t in following])
                columns = [part.column("doc_id"), *(pa.array(x, t) for x, t in zip(made, types, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    ship(docs.sparkSession)
    return paired.mapInArrow(run, schema)
