"""Token counts: batch encoding in Arrow functions that return lengths only.

``docs`` needs doc_id and text; other columns are not read. One row comes back per row, repeated rows included. A null
text counts as empty (0 bytes, 0 tokens); an empty table gives an empty table; ids may be null.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import field, map_texts

TOKEN_LIMIT = 4096
# Segments are handed to the encoder in batches of about this many bytes, whatever their number.
ENCODE_BYTES = 1 << 18
# Counts of short segments are remembered in a worker up to this many; then the memory starts anew.
REMEMBERED = 1 << 18
SHORT = 64

# A single space between two other characters: no piece of a word-split vocabulary holds it inside. The mark that
# stands for a space in pieces counts as a space where a text holds it.
MARK = "▁"
SAFE = re.compile(f"(?<=[^ {MARK}]) (?=[^ {MARK}])")


@lru_cache(maxsize=2)
def encoder(model: str) -> tuple[sentencepiece.SentencePieceProcessor, bool]:
    """The model, loaded once per worker, and whether single spaces are safe boundaries of it.

    They are if each word gets the space mark in front, as the first word of a text does, no piece spans the mark, and
    no other white space is turned into a space.
    """
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    spanning = any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size()))
    others = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
    probes = [["a", "b"], *(["a", c, "b"] for c in others)]
    apart = all(sp.encode(" ".join(p)) == sum(map(sp.encode, p), []) for p in probes)
    return sp, apart and not spanning


# Counts by segment; the model of a session does not change within a worker, else it is emptied.
_known: dict[str, int] = {}
_known_of = ""


def _lengths(sp: sentencepiece.SentencePieceProcessor, segments: list[str]) -> list[int]:
    """Token counts of distinct segments, encoded in batches balanced by bytes."""
    out: list[int] = []
    batch: list[str] = []
    size = 0
    for segment in segments:
        batch.append(segment)
        size += len(segment.encode())
        if size >= ENCODE_BYTES:
            out += map(len, sp.encode(batch, num_threads=1))
            batch, size = [], 0
    if batch:
        out += map(len, sp.encode(batch, num_threads=1))
    return out


def count_tokens(texts: list[str], model: str) -> list[int]:
    """Tokens of each whole text, without begin, end or added special tokens."""
    global _known, _known_of
    sp, safe = encoder(model)
    if _known_of != model:
        _known, _known_of = {}, model
    if not safe:
        return _lengths(sp, texts)
    split = []
    for text in texts:
        parts = text.split(" ")
        split.append(SAFE.split(text) if "" in parts or MARK in text else parts)
    segments = set().union(*split)
    if len(_known) + len(segments) > REMEMBERED:
        _known = {}
    new = [s for s in segments if s not in _known]
    counts = dict(zip(new, _lengths(sp, new), strict=True))
    _known.update((s, n) for s, n in counts.items() if len(s) <= SHORT)
    counts = {s: _known[s] if s in _known else counts[s] for s in segments}
    return [sum(map(counts.__getitem__, parts)) for parts in split]


def with_tokens(docs: DataFrame, model: str, keep: tuple[str, ...]) -> DataFrame:
    """The ``keep`` columns of every row and its n_tokens, the number that ``token_counts`` gives."""
    count = lambda texts: [count_tokens([t or "" for t in texts.to_pylist()], model)]
    return map_texts(docs, count, [field("n_tokens", "bigint")], keep)


def token_counts(docs: DataFrame, model: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether the text has more than ``limit`` tokens.

    ``model`` is the path of a sentencepiece model that every executor can open.
    """

    def make(texts: pa.Array) -> list:
        values = [t or "" for t in texts.to_pylist()]
        return [[len(t.encode()) for t in values], count_tokens(values, model)]

    counted = map_texts(docs, make, [field("n_bytes", "bigint"), field("n_tokens", "bigint")])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
