"""Benchmark decontamination: a prefix-filtered set join of documents with the word windows of benchmark items.

``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are not read. Null and empty texts have
no words and no hits; an item without words has no window; null ids are kept on documents. The words of an item without
an id are hit like any other's, but it is not counted or named among the items. Repeated items count once by id. Empty tables on either side give no hits.

A window is contained in a document only if its rarest shingle is. So shingles of the benchmark are counted over all
documents, each window is indexed by its rarest one alone, and a document position that holds it is a candidate, subject
to the position of the shingle in the window and the length of the document. Candidates are compared word by word.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import field, filter_texts, map_texts, ship, slices, text_bytes, written

WINDOW = 13
SHINGLE = 3
# An index is broadcast for about this many bytes of benchmark text. More text means more shards, each with a pass of
# its own over the documents, so that a task never holds two; their hits are joined by row.
SHARD_BYTES = 8 << 20

# Letters a-z (A-Z lower-cased), digits and all bytes beyond ASCII make words.
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words; of fewer words, each word."""
    if size == 1 or len(words) < size:
        return words
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def shards(benchmark: DataFrame, shard_bytes: int) -> Iterator[list[tuple]]:
    """The items in lists of about ``shard_bytes`` of text, read one list at a time; repeated rows once."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // shard_bytes)
    for number in range(count):
        mine = items.filter(F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text"), F.lit(count)) == number)
        yield [(None if r.item_id is None else str(r.item_id), r.text.encode()) for r in mine.collect()]


def shingle_counts(docs: DataFrame, wanted: frozenset[bytes], size: int) -> dict[bytes, int]:
    """In how many documents each wanted shingle occurs; the answer is no larger than ``wanted``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(wanted)
    single = any(b" " not in s for s in wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = sent.value, Counter()
        for batch in batches:
            for part in slices(batch):
                for text in text_bytes(part.column("text")):
                    words = words_of(text)
                    counts.update(known.intersection(shingles(words, size)))
                    if single and len(words) >= size:
                        counts.update(known.intersection(words))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["s", "n"])

    ship(docs.sparkSession)
    counted = docs.select("text").mapInArrow(run, "s binary, n bigint").groupBy("s").agg(F.sum("n").alias("n"))
    return {bytes(r.s): r.n for r in counted.collect()}


def spans_of(words: list[bytes], counts: dict[bytes, int], window: int, size: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(start, end, place, shingle): neighbouring windows that share their rarest shingle at one place, as one span."""
    if not words:
        return
    parts, width = shingles(words, size), min(window, len(words))
    inside = width - (len(words) - len(parts))  # shingles of a window
    first, held = 0, None
    for start in range(len(words) - width + 1):
        place = min(range(start, start + inside), key=lambda i: (counts.get(parts[i], 0), parts[i]))
        if held is not None and place != held:
            yield first, start - 1 + width, held, parts[held]
            first = start
        held = place
    yield first, len(words), held, parts[held]


def index_windows(items: list[tuple], counts: dict[bytes, int], window: int, size: int) -> dict[bytes, list]:
    """The spans of all items under their shingle: [(offset of the shingle, window length, words, item ids)]."""
    holders: dict[tuple, set] = defaultdict(set)
    known: dict[bytes, bytes] = {}
    for item, text in items:
        words = [known.setdefault(w, w) for w in words_of(text)]
        for start, end, place, shingle in spans_of(words, counts, window, size):
            holders[shingle, place - start, min(window, len(words)), tuple(words[start:end])].add(item)
    index: dict[bytes, list] = defaultdict(list)
    for (shingle, *span), ids in holders.items():
        index[shingle].append((*span, tuple(sorted(ids - {None}))))
    return dict(index)


def find_hits(words: list[bytes], index: dict[bytes, list], size: int, single: bool) -> tuple[bytearray, set[str]]:
    """Flags of hit words, and the items that have a window in the document."""
    hit, items = bytearray(len(words)), set()
    kinds = [shingles(words, size)]
    if single and len(words) >= size > 1:
        kinds.append(words)
    for grams in kinds:
        if index.keys().isdisjoint(grams):
            continue
        for position, gram in enumerate(grams):
            for offset, width, span, ids in index.get(gram, ()):
                base = position - offset  # where the span begins
                low, high = max(0, -base), min(len(span), len(words) - base)
                if high - low < width:
                    continue
                # the span is compared from the shingle outwards; what agrees is hit if a window fits in
                left = right = offset
                while right < high and words[base + right] == span[right]:
                    right += 1
                while left > low and words[base + left - 1] == span[left - 1]:
                    left -= 1
                if right - left >= width:
                    hit[base + left : base + right] = b"\x01" * (right - left)
                    items.update(ids)
    return hit, items


class Searcher:
    """Finds the windows of one shard of a benchmark in texts; holds its broadcast index."""

    def __init__(self, docs: DataFrame, items: list[tuple], window: int, size: int):
        wanted = frozenset(s for _, text in items for s in shingles(words_of(text), size))
        index = index_windows(items, shingle_counts(docs, wanted, size), window, size)
        self.index, self.size = docs.sparkSession.sparkContext.broadcast(index), size
        self.single = any(b" " not in s for s in index)

    def __call__(self, text: bytes) -> tuple[int, list[int], list[str]]:
        """Number of words, positions of hit words, and the items found, sorted."""
        words = words_of(text)
        hit, items = find_hits(words, self.index.value, self.size, self.single)
        return len(words), [i for i, flag in enumerate(hit) if flag], sorted(items)


def searchers(docs: DataFrame, benchmark: DataFrame, window: int, size: int, shard_bytes: int) -> list[Callable]:
    """One searcher per shard, at least one. Their indexes are used by one job after the other, never side by side."""
    if size > window:
        raise ValueError("a shingle is no longer than a window")
    return [Searcher(docs, items, window, size) for items in shards(benchmark, shard_bytes)] or [lambda text: (len(words_of(text)), [], [])]


def _row_keys() -> dict:
    """Two hashes that tell rows of other ids or texts apart; repeated rows share them, and their result."""
    return {"decon__a": F.xxhash64("doc_id", "text"), "decon__b": F.xxhash64("text", "doc_id", F.lit("b"))}


def _merged(docs: DataFrame, found: list[Callable]) -> DataFrame:
    """Row keys, n_words, n_hit and item_ids of the distinct rows of ``docs`` with hits of any of several searchers."""
    keyed = docs.select("doc_id", "text").withColumns(_row_keys())
    fields = [field("n_words", "bigint"), field("hits", "[int]"), field("items", "[string]")]
    parts = []
    for search in found:

        def make(texts: pa.Array, search=search) -> list:
            return list(zip(*map(search, text_bytes(texts)), strict=True)) or [[], [], []]

        hits = map_texts(keyed, make, fields, tuple(_row_keys())).filter(F.size("hits") > 0)
        parts.append(written(hits, "hits"))
    # sets: repeated rows of a shard become one before the shuffle, so a group has one entry per shard
    together = reduce(DataFrame.unionByName, parts).groupBy(*_row_keys()).agg(
        F.first("n_words").alias("n_words"), F.collect_set("hits").alias("hits"), F.collect_set("items").alias("items")
    )
    return together.select(
        *_row_keys(), "n_words", F.size(F.array_distinct(F.flatten("hits"))).cast("bigint").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten("items"))).alias("item_ids"),
    )


def is_contaminated(n_words, n_hit):
    """A twentieth of the words or more are hit; numbers or columns."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids (sorted as strings) and contaminated of every row of ``docs``."""
    first, *more = found = searchers(docs, benchmark, window, shingle, shard_bytes)
    if more:
        keyed = docs.select("doc_id", "text").withColumns(_row_keys())
        counted = map_texts(keyed, lambda texts: [[len(words_of(t)) for t in text_bytes(texts)]], [field("n_words", "bigint")], ("doc_id", *_row_keys()))
        hits = counted.join(_merged(docs, found).drop("n_words"), list(_row_keys()), "left")
        hits = hits.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)), "item_ids": F.coalesce("item_ids", F.array().cast("array<string>"))})
    else:

        def make(texts: pa.Array) -> list:
            rows = [(n, len(hit), items) for n, hit, items in map(first, text_bytes(texts))]
            return list(zip(*rows, strict=True)) or [[], [], []]

        hits = map_texts(docs, make, [field("n_words", "bigint"), field("n_hit", "bigint"), field("item_ids", "[string]")])
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), "item_ids",
        is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def uncontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The rows of ``docs``, unchanged, that are not contaminated."""
    first, *more = found = searchers(docs, benchmark, window, shingle, shard_bytes)
    if more:
        bad = _merged(docs, found).filter(is_contaminated(F.col("n_words"), F.col("n_hit"))).select(*_row_keys())
        return docs.withColumns(_row_keys()).join(bad, list(_row_keys()), "left_anti").select(*docs.columns)

    def clean(text: bytes) -> bool:
        n, hit, _ = first(text)
        return not is_contaminated(n, len(hit))

    return filter_texts(docs, lambda texts: list(map(clean, text_bytes(texts))))
