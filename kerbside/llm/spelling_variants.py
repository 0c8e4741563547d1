"""Spelling variants: words one edit apart, found by walking a trie of all words level by level.

``docs`` needs doc_id and text; other columns are not read. A null text has no words; a null id counts as the empty
string; repeated rows count each; an empty table gives an empty table. Texts and words may have any length.

The trie is a distributed table of edges. A state of the frontier is (place in a word, node, edits): the place is the node
that the word's own first letters lead to, so all words that begin alike share their states. States without an edit are
the nodes themselves, place and node being one. At each node they spawn the one-edit states: a letter replaced (two
children of the node) or dropped (a child and the node; the inserted letter of the other word). A one-edit state goes on
by letters that both sides have, so every level joins the frontier with the edges of that level twice, once for the
place and once for the node; states without a common next letter are never made. Where both sides end, two words are
neighbours. A dropped letter is the last of its run, so no pair is found twice.

Nodes are named by a hash of their letters: a collision could only add pairs, and these fail the exact check at the end.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import field, shared_folder, ship, slices, written

LEAST_LETTERS = 5
LEAST_COUNT = 3
# A word in so many (by hash of document and word) loses a letter.
NOISE = 97
# A form is so many times as frequent as its variant.
FORM_FACTOR = 2
# Levels of the trie. Longer words have neighbours of their own length only, found by ``_long_pairs``.
LEVELS = 64
# Rows that a long word gives at a time.
LONG_ROWS = 1 << 16
# Counts that a task holds before it passes them on.
HELD = 1 << 17

RUN = re.compile("[A-Za-zÀ-ÿ]+")
END = -1  # the letter that stands for the end of a word
EDGES = "node bigint, ch int, child bigint, word string, letters array<int>, depth int"
STATES = "place bigint, node bigint, common array<int>, word string, other string"


def _noisy(run: str, doc_id: bytes) -> str:
    """The run, without one letter where the hash of document and run says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(doc_id))
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_runs(texts: list[str | None], ids: list) -> Counter:
    """How often the texts hold each word of LEAST_LETTERS or more, after noise."""
    total: Counter = Counter()
    for text, doc_id in zip(texts, ids, strict=True):
        if not text:
            continue
        lowered = text.encode().lower().decode()  # bytes: A-Z alone
        prefix = b":" if doc_id is None else f"{doc_id}:".encode()
        for run, n in Counter(RUN.findall(lowered)).items():
            if len(run) >= LEAST_LETTERS:
                total[_noisy(run, prefix)] += n
    return total


def words(docs: DataFrame) -> DataFrame:
    """word and n of all words with LEAST_LETTERS letters and LEAST_COUNT occurrences.

    Tasks count before the shuffle, so a frequent word reaches it a few times per task.
    """
    schema = T.StructType([field("word", "string"), field("n", "bigint")])

    def passed_on(counts: Counter) -> pa.RecordBatch:
        kept = {w: n for w, n in counts.items() if len(w) >= LEAST_LETTERS}
        return pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in slices(batch):
                held.update(count_runs(part.column("text").to_pylist(), part.column("doc_id").to_pylist()))
                if len(held) >= HELD:
                    yield passed_on(held)
                    held = Counter()
        yield passed_on(held)

    ship(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def trie(vocabulary: DataFrame) -> DataFrame:
    """Edges (depth, node, ch, child, word, letters): ``letters`` are the child's next letters.

    A word ends in an edge of the letter END, which has no child but the word. ``depth`` is the node's.
    """
    word = F.col("word")
    letter = lambda d: F.when(d < F.length(word), F.ascii(F.substring(word, d + 1, F.lit(1)))).otherwise(END)
    edge = lambda d: F.struct(
        d.alias("depth"), F.xxhash64(F.substring(word, F.lit(1), d)).alias("node"), letter(d).alias("ch"),
        F.when(d < F.length(word), F.xxhash64(F.substring(word, F.lit(1), d + 1))).alias("child"),
        F.when(d == F.length(word), word).alias("word"),
    )
    spread = vocabulary.select(F.explode(F.transform(F.sequence(F.lit(0), F.length(word)), edge)).alias("e")).select("e.*")
    one = lambda name: F.max(name).alias(name)
    edges = spread.groupBy("depth", "node", "ch").agg(one("child"), one("word"))
    # A node has no more letters than the alphabet, so neither side of this join grows with the words.
    below = edges.groupBy(F.col("node").alias("child")).agg(F.collect_list("ch").alias("letters"))
    return edges.where(F.col("ch") != END).join(below, "child").unionByName(edges.where(F.col("ch") == END), allowMissingColumns=True)


def _spawned(edges: DataFrame) -> DataFrame:
    """One-edit states that begin at the nodes of ``edges``: (place, node, common), ``common`` the letters to go on by.

    Children of one node meet each other here, so no more than the alphabet's pairs.
    """
    child = F.struct("ch", "child", "letters")
    nodes = edges.groupBy("node").agg(F.array_sort(F.collect_list(child)).alias("kids"))
    state = lambda place, node, common: F.struct(place.alias("place"), node.alias("node"), common.alias("common"))
    real = F.filter("kids", lambda a: a["ch"] != END)
    replaced = F.flatten(F.transform(real, lambda a: F.transform(
        F.filter(real, lambda b: (b["ch"] > a["ch"]) & F.arrays_overlap(a["letters"], b["letters"])),
        lambda b: state(a["child"], b["child"], F.array_intersect(a["letters"], b["letters"])),
    )))
    # After a dropped letter comes another letter: it is the last of its run.
    here = F.transform("kids", lambda k: k["ch"])
    dropped = F.transform(real, lambda a: state(a["child"], F.col("node"), F.array_remove(F.array_intersect(a["letters"], here), a["ch"])))
    states = nodes.select(F.explode(F.concat(replaced, dropped)).alias("s")).select("s.*")
    return states.where(F.size("common") > 0)


def _walked(states: DataFrame, at: DataFrame, node: DataFrame) -> DataFrame:
    """States one letter on, and the pairs of words that end there: (place, node, common, word, other)."""
    steps = states.select("place", "node", F.explode("common").alias("ch"))
    mine = at.select(F.col("node").alias("place"), "ch", F.col("child").alias("to_place"), "word", F.col("letters").alias("next"))
    theirs = node.select("node", "ch", F.col("child").alias("to_node"), F.col("word").alias("other"), F.col("letters").alias("others"))
    moved = steps.join(mine, ["place", "ch"]).drop("place").join(theirs, ["node", "ch"])
    common = F.array_intersect("next", "others")
    moved = moved.select(F.col("to_place").alias("place"), F.col("to_node").alias("node"), common.alias("common"), "word", "other")
    return moved.where(F.col("word").isNotNull() | (F.size("common") > 0))


def _edges_at(edges: DataFrame, *depths: int) -> DataFrame:
    return edges.where(F.col("depth").isin(*depths)).drop("depth")


def _trie_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs (word, other) of words of at most LEVELS letters that are one edit apart, each once.

    Every level is written before the next is joined, and holds the pairs that end there.
    """
    spark = vocabulary.sparkSession
    short = vocabulary.where(F.length("word") <= LEVELS).select("word")
    deepest = short.agg(F.max(F.length("word"))).first()[0] or 0
    place = f"{shared_folder(spark)}/spelling-{uuid.uuid4().hex}"
    trie(short).hint("rebalance", "depth").write.partitionBy("depth").parquet(f"{place}/edges")
    edges = spark.read.schema(EDGES).parquet(f"{place}/edges")
    spark.createDataFrame([], STATES).write.parquet(f"{place}/states/level=0")
    for level in range(1, deepest + 1):
        states = _spawned(_edges_at(edges, level - 1))
        if level > 1:
            before = spark.read.schema(STATES).parquet(f"{place}/states/level={level - 1}")
            states = states.unionByName(before.where(F.col("word").isNull()).select("place", "node", "common"))
        # The place is ``level`` letters deep; the node too, or one less where a letter was dropped.
        moved = _walked(states, _edges_at(edges, level), _edges_at(edges, level - 1, level))
        moved.write.parquet(f"{place}/states/level={level}")
    return spark.read.schema(STATES).parquet(f"{place}/states").where(F.col("word").isNotNull()).select("word", "other")


_BASE = 0x100000001B3


def _powers(n: int) -> np.ndarray:
    factors = np.full(n, _BASE, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def _without_each(codes: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """Hash of the word without its i-th letter, for each i, and of the whole word."""
    letters = codes.astype(np.uint64) + np.uint64(1)
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * _powers(len(codes)), dtype=np.uint64)])
    after = before[-1] - before[1:]
    return before[:-1] + after * np.uint64(pow(_BASE, -1, 1 << 64)), before[-1]


def _long_pairs(vocabulary: DataFrame) -> DataFrame:
    """Pairs (word, other), of which one has more than LEVELS letters, that can be one edit apart.

    Each word gives a hash for each letter it can lose, so as many rows as it has letters. Words that differ in one
    letter agree when both lose it: no more of them share a key than there are letters in the alphabet. A word with a
    letter more agrees with the whole hash of the other.
    """
    names = ["id", "size", "at", "key", "last"]
    schema = T.StructType([*[field(name, "bigint") for name in names[:-1]], field("last", "boolean")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
                codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                lost, whole = _without_each(codes)
                # The whole word stands at -1. Of a run of one letter the last stands for all where the lengths differ.
                at = np.append(np.arange(len(codes)), -1)
                keys = np.append(lost, whole).view(np.int64)
                last = np.append(np.append(codes[1:] != codes[:-1], True), False)
                for rows in (slice(i, i + LONG_ROWS) for i in range(0, len(at), LONG_ROWS)):
                    n = len(at[rows])
                    made = [np.full(n, name, np.int64), np.full(n, len(codes), np.int64), at[rows], keys[rows], last[rows]]
                    yield pa.RecordBatch.from_arrays([pa.array(column) for column in made], names)

    long = vocabulary.where(F.length("word") >= LEVELS).select(F.xxhash64("word").alias("id"), "word")
    ship(vocabulary.sparkSession)
    lost = written(long.mapInArrow(run, schema), "lost-letters")
    one, two = lost.where(F.col("at") >= 0), lost.select(F.col("id").alias("other_id"), "size", "at", "key")
    replaced = one.join(two, ["size", "at", "key"]).where(F.col("id") < F.col("other_id")).select("id", "other_id")
    shorter = two.where(F.col("at") < 0).select("other_id", "key", (F.col("size") + 1).alias("size"))
    dropped = one.where("last").join(shorter, ["size", "key"]).select("id", "other_id")
    pairs = replaced.unionByName(dropped)
    others = long.select(F.col("id").alias("other_id"), F.col("word").alias("other"))
    found = pairs.join(long, "id").join(others, "other_id").select("word", "other")
    return found.where(F.greatest(F.length("word"), F.length("other")) > LEVELS)


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, other) for each two words that are exactly one edit apart, in both directions."""
    pairs = _trie_pairs(vocabulary)
    if vocabulary.where(F.length("word") > LEVELS).limit(1).count():
        pairs = pairs.unionByName(_long_pairs(vocabulary))
    near = pairs.where(F.levenshtein("word", "other", 1) == 1)
    return near.unionByName(near.select(F.col("other").alias("word"), F.col("word").alias("other")))


def _rooted(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) of words with a form: each round doubles how far a word sees.

    ``n`` grows by FORM_FACTOR at each step, so ``most`` bounds the length of a chain.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    steps = max(1, math.ceil(math.log(max(most, FORM_FACTOR), FORM_FACTOR)))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = written(roots.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")
    return roots


def variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of each word of the corpus.

    The form is the near word of largest n (of equal ones the smallest by code points) if that is FORM_FACTOR times the
    word's n or more; the root follows forms to the last.
    """
    vocabulary = written(words(docs), "words")
    counts = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), "other")).alias("best")
    near = neighbours(vocabulary).join(counts, "other").groupBy("word").agg(F.count("*").alias("n_near"), best)
    other_n = -F.col("best")["rank"]
    is_form = other_n >= FORM_FACTOR * F.col("n")
    told = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, F.col("best")["other"]).alias("form"), F.when(is_form, other_n).alias("form_n"),
    )
    told = written(told, "forms")
    forms = told.where(F.col("form").isNotNull())
    roots = _rooted(forms, forms.agg(F.max("form_n")).first()[0] or 0)
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
