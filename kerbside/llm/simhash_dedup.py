"""SimHash near-duplicates: 64-bit fingerprints, linked within a Hamming radius by BK-trees, joined into components.

``docs`` needs doc_id and text; other columns are not read. Null and empty texts have no words: fingerprint zero,
linked like any other. Repeated rows and ids each give a row. A null id never becomes a component id unless the
component has no other. An empty table gives an empty table.

Trees are cut into shards by 48 of the 64 bits: two fingerprints that differ in at most two bits agree on at least six
of their eight bytes, so every link lies within the shard of one of 28 byte choices, and a shard holds at most 2**16
distinct fingerprints, whatever the number of documents. The probes are sent to the shard's tree rather than all trees
to all executors, since those grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import field, map_texts, ship, text_bytes, written

SHINGLE = 3
SEED = 42
RADIUS = 2
BYTES = 8


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; 0 for a text without words."""
    words = text.lower().split()  # ASCII letters and ASCII white space only, as these are bytes
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.dtype("<u8"), n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 4096):
        part = hashes[start : start + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``bits``, the fingerprint as a signed long, of every row."""

    def make(texts: pa.Array) -> list:
        values = np.array([fingerprint(t, shingle) for t in text_bytes(texts)], np.uint64)
        return [values.view(np.int64)]

    return map_texts(docs, make, [field("bits", "bigint")], keep)


class Tree:
    """A BK-tree of 64-bit values: each child hangs at its Hamming distance to the parent."""

    def __init__(self, value: int):
        self.root = (value, {})

    def add(self, value: int) -> None:
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            if distance not in node[1]:
                node[1][distance] = (value, {})
                return
            node = node[1][distance]

    def within(self, value: int, radius: int) -> list[int]:
        """Values at most ``radius`` bits away; only edges that can lead there are followed."""
        found, open_nodes = [], [self.root]
        while open_nodes:
            node, children = open_nodes.pop()
            distance = (node ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            open_nodes += [child for edge, child in children.items() if abs(edge - distance) <= radius]
        return found


def tree_links(values: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect all of a shard's distinct values which the radius connects: at most one less than values."""
    parent = {v: v for v in values}

    def top(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    tree = Tree(values[0])
    for value in values[1:]:
        for near in tree.within(value, radius):
            a, b = top(value), top(near)
            if a != b:
                parent[a] = b
                yield value, near
        tree.add(value)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between the distinct ``bits`` of a frame: enough to connect what the radius connects.

    Radii up to 2 use shards that agree on six bytes; a wider radius needs fewer agreeing bytes and gives larger shards.
    """
    agreed = BYTES - radius
    if not 0 < agreed < BYTES:
        raise ValueError("the radius must lie between 1 and 7")
    masks = [sum(0xFF << (8 * b) for b in chosen) for chosen in combinations(range(BYTES), agreed)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    shards = distinct.select(
        "bits", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("bits").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(signed)])).alias("shard")
    ).select("shard.i", "shard.v", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            i, v, bits = (np.concatenate([old, c.to_numpy(zero_copy_only=False)]) for old, c in zip(left, batch.columns, strict=True))
            cuts = np.flatnonzero((i[1:] != i[:-1]) | (v[1:] != v[:-1])) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            yield from pairs(bits[:last], cuts[:-1])
            left = (i[last:], v[last:], bits[last:])
        yield from pairs(left[2], np.zeros(0, np.int64))

    def pairs(bits: np.ndarray, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(bits)]])
        found: list[tuple[int, int]] = []
        for start, end in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
            found += tree_links(bits[start:end].view(np.uint64).tolist(), radius)
        if found:
            both = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    ship(distinct.sparkSession)
    dealt = shards.repartition("i", "v").sortWithinPartitions("i", "v")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): nodes of one component, and no others, have the same root.

    Each round gives every node the neighbour that is first in an order drawn anew, and merges it into that one; what
    remains are the edges between merged nodes. Only pairs are shuffled, the driver sees a count per round.
    """
    roots = None
    turn = 0
    edges = written(edges.filter("a <> b"), "edges")
    while edges.take(1):
        order = lambda c, t=turn: F.xxhash64(F.col(c), F.lit(t))
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min_by("b", F.struct(order("b"), F.col("b"))).alias("b"))
        step = F.when(F.struct(order("b"), F.col("b")) < F.struct(order("a"), F.col("a")), F.col("b")).otherwise(F.col("a"))
        merged = written(best.select(F.col("a").alias("node"), step.alias("root")), "merged")
        to = lambda side: merged.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root"))
        moved = edges.join(to("a"), "a").join(to("b"), "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        less, more = F.least("a", "b"), F.greatest("a", "b")
        edges = written(moved.filter("a <> b").select(less.alias("a"), more.alias("b")).distinct(), "edges")
        if roots is None:
            roots = merged
        else:
            onward = merged.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = written(roots.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        turn += 1
    if roots is None:
        roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _row_keys() -> dict:
    """Two hashes that tell rows of other ids or texts apart and agree on repeated rows; never null."""
    return {"dedup__a": F.xxhash64("doc_id", "text"), "dedup__b": F.xxhash64("text", "doc_id", F.lit("b"))}


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, row keys, bits, root and component_id (the smallest doc_id reachable by links) of every row of ``docs``."""
    keyed = docs.select("doc_id", "text").withColumns(_row_keys())
    prints = written(fingerprints(keyed, shingle, ("doc_id", *_row_keys())), "prints")
    first = prints.groupBy("bits").agg(F.min("doc_id").alias("first"))
    roots = components(links(first.select("bits"), radius))
    rooted = first.join(roots.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("bits", "root").join(smallest, "root").select("bits", "root", "component_id")
    return prints.join(named, "bits")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with all their columns, one per component: that of the smallest doc_id.

    Of repeated rows one stays; among rows of one id but other texts, that of the smallest hash. Texts are shuffled
    once: the join and the removal of repeated rows share their keys.
    """
    keys = list(_row_keys())
    found = near_duplicates(docs, shingle, radius)
    rank = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *keys)
    kept = found.groupBy("root").agg(F.min(rank).alias("kept")).select(*[f"kept.{k}" for k in keys])
    chosen = docs.withColumns(_row_keys()).join(written(kept, "kept"), keys, "left_semi")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[0]))
    return chosen.withColumn("dedup__n", number).filter("dedup__n = 1").select(*docs.columns)
