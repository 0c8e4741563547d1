"""Byte-level BPE: texts to token ids and back, by recursive DuckDB queries inside each partition.

``docs`` needs doc_id and text; other columns are not read. A null text counts as empty: no ids, an empty decoded text.
Repeated rows give a row each, ids may be null, an empty table gives an empty table. Special tokens are not known:
their strings are ordinary text. Texts and words may have any length.

``ranks`` is the path of a rank file (base64 of the token's bytes, a space, its rank) that every executor can open. A
worker loads it once into DuckDB: the tokens, and a merge table of all pairs of tokens whose bytes together are a token.
A text is split by the pattern, and words that are tokens get their rank. For the others rows of (word, position, token)
join the merge table again and again, and each word contracts its pair of least rank that stands leftmost, until no
word has a pair left. Decoding joins ids with tokens and strings their bytes together in order.

A text is first split at spaces before other characters. A word of the pattern can hold such a space at its beginning
only, so segments are encoded apart, and the ids of short ones are remembered in the worker.
"""

from __future__ import annotations

import base64
import re
import tempfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kerbside.llm.common import field, ship, slices

# Segments of at most SHORT characters are remembered in a worker up to this many; then the memory starts anew.
REMEMBERED = 1 << 19
SHORT = 32
# Words of more bytes are contracted by ENCODE_LONG.
LONG = 64
# Words that one recursive query contracts have about this many bytes together, unless a single one has more.
ENCODE_BYTES = 1 << 19
# What DuckDB may hold in a worker; beyond, it spills to the worker's temporary folder.
MEMORY = "500MB"
# Ids that one query decodes.
DECODE_IDS = 1 << 18

# A pair is calm if no token pair that its result can be part of has a lesser rank.
TABLES = """
    CREATE TABLE merge AS
        SELECT a.id AS l, b.id AS r, w.id AS m
        FROM (SELECT id, bytes, unnest(range(1, octet_length(bytes))) AS pos FROM token) AS w
        JOIN token AS a ON a.bytes = w.bytes[1 : w.pos] JOIN token AS b ON b.bytes = w.bytes[w.pos + 1 :];
    CREATE TABLE pair AS
        SELECT l, r, m, m NOT IN (SELECT l FROM merge WHERE m < l UNION ALL SELECT r FROM merge WHERE m < r) AS calm FROM merge;
"""

# The working table holds the words that changed in the last round; each contracts its leftmost pair of least rank.
ENCODE = """
    WITH RECURSIVE state(word, round, ids) AS (
        SELECT word, 0, ids FROM fresh
        UNION ALL
        SELECT word, round + 1, ids[1 : best % 256 - 1] || [best // 256] || ids[best % 256 + 2 :]
        FROM state JOIN (
            SELECT word, min(m * 256 + pos) AS best
            FROM (SELECT word, unnest(ids[:-2]) AS id, unnest(ids[2:]) AS after, generate_subscripts(ids, 1) AS pos FROM state) AS s
            JOIN pair ON pair.l = s.id AND pair.r = s.after
            GROUP BY word
        ) USING (word)
    )
    SELECT word, arg_max(ids, round) AS ids FROM state GROUP BY word
"""

# The same for long words, of which the last state alone is kept. A round contracts a word's pairs of least rank from
# the left, where one does not overlap another, up to the first that makes a pair of lesser rank (``risk``): that one is
# next.
ENCODE_LONG = """
    WITH RECURSIVE state(word, ids) USING KEY (word) AS (
        SELECT word, ids FROM fresh
        UNION
        (
        WITH here AS MATERIALIZED (
            SELECT word, pos, m, calm
            FROM (SELECT word, unnest(ids) AS id, unnest(list_append(ids[2:], NULL)) AS after, generate_subscripts(ids, 1) AS pos FROM state) AS s
            JOIN pair ON pair.l = s.id AND pair.r = s.after
        ), least AS (
            SELECT word, min(m) AS m FROM here GROUP BY word
        ), hit AS (
            SELECT word, pos, m, calm, pos - row_number() OVER (PARTITION BY word ORDER BY pos) AS island FROM here JOIN least USING (word, m)
        ), apart AS MATERIALIZED (
            SELECT word, pos, m, calm, lag(pos) OVER (PARTITION BY word ORDER BY pos) AS before
            FROM (SELECT *, row_number() OVER (PARTITION BY word, island ORDER BY pos) AS nth FROM hit) WHERE nth % 2 = 1
        ), risk AS (
            SELECT word, min(pos) AS pos
            FROM (SELECT word, pos, m, CASE WHEN before = pos - 2 THEN m ELSE ids[pos - 1] END AS l, ids[pos + 2] AS r FROM apart JOIN state USING (word) WHERE NOT calm) AS a
            WHERE EXISTS (FROM pair WHERE pair.l = a.l AND pair.r = a.m AND pair.m < a.m) OR EXISTS (FROM pair WHERE pair.l = a.m AND pair.r = a.r AND pair.m < a.m)
            GROUP BY word
        ), chosen AS (
            SELECT word, any_value(m) AS m, list(apart.pos ORDER BY apart.pos) AS ps
            FROM apart LEFT JOIN risk USING (word) WHERE risk.pos IS NULL OR apart.pos <= risk.pos
            GROUP BY word
        )
        SELECT word, flatten(list_transform(list_zip(list_prepend(-1, ps[:-2]), ps), lambda x: ids[x[1] + 2 : x[2] - 1] || [m])) || ids[ps[-1] + 2 :]
        FROM state JOIN chosen USING (word)
        )
    )
    SELECT word, ids FROM state
"""

# The database has one thread, so the aggregate meets the rows as they are sorted.
DECODE = """
    SELECT text, string_agg(chars, '') AS chars
    FROM (SELECT text, chars FROM given JOIN token USING (id) ORDER BY pos) GROUP BY text
"""


def _members(kind: str) -> str:
    """All characters of a class of the pattern, as the body of a set.

    They are asked of the tokenizer library itself: regular expression engines know different versions of Unicode.
    """
    single = tiktoken.Encoding("characters", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    points = np.array([*range(0xD800), *range(0xE000, 0x110000)], np.uint32)
    found = bytes(single.encode_ordinary(points.tobytes().decode("utf-32-le"))).decode()
    points = np.frombuffer(found.encode("utf-32-le"), np.uint32)
    first, last = points[np.diff(points, prepend=-2) != 1], points[np.diff(points, append=1 << 31) != 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first.tolist(), last.tolist(), strict=True))


def _splitter(pattern: str) -> tuple[re.Pattern, str, bool]:
    """The pattern with its classes written out, the class of white space, and whether ``str.isalpha`` tells single words."""
    letters, numbers, spaces = _members(r"\p{L}"), _members(r"\p{N}"), _members(r"\s")
    inside = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    outside = inside.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    words = re.compile(outside.replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]"))
    # By the public pattern a run of letters, with or without a space before it, is one word.
    alphabet = "".join(c for c in map(chr, range(0x110000)) if c.isalpha())
    known = re.fullmatch(f"[{letters}]+", alphabet) is not None
    return words, spaces, pattern == public_tokenizers.PATTERN and known


class Coder:
    """A rank file in a DuckDB database of the worker's memory."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        if len(self.ranks.keys() & {bytes([b]) for b in range(256)}) < 256:
            raise ValueError("the rank file must hold every single byte")
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.words, spaces, self.plain = _splitter(pattern)
        self.safe, self.odd = re.compile(f"(?= [^{spaces}])"), re.compile(f" (?:[{spaces}]|$)")
        self.database = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": tempfile.gettempdir()})
        # ``chars`` holds a character for each byte.
        tokens, ids = list(self.ranks), list(self.ranks.values())
        self._register("given", id=pa.array(ids, pa.int32()), bytes=pa.array(tokens, pa.binary()), chars=pa.array([t.decode("latin-1") for t in tokens]))
        self.database.execute("CREATE TABLE token AS FROM given")
        self.database.execute(TABLES)
        self.known_words: dict[str, bytes] = {}
        # Ids of segments at the beginning of a text, and of those after a space.
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def _register(self, name: str, **columns: pa.Array) -> None:
        self.database.register(name, pa.table(columns))

    def _contracted(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of words that are no tokens, in queries of about ENCODE_BYTES."""
        coded = [word.encode() for word in words]
        for query, kept in ((ENCODE, [i for i, c in enumerate(coded) if len(c) <= LONG]), (ENCODE_LONG, [i for i, c in enumerate(coded) if len(c) > LONG])):
            ends = np.cumsum([len(coded[i]) for i in kept], dtype=np.int64)
            start = 0
            while start < len(kept):
                base = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + ENCODE_BYTES, "right")))
                part = kept[start:stop]
                ids = self.of_byte[np.frombuffer(b"".join([coded[i] for i in part]), np.uint8)]
                offsets = np.append(0, ends[start:stop] - base).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                self._register("fresh", word=pa.array(np.arange(len(part), dtype=np.int32)), ids=lists)
                done = self.database.sql(query).to_arrow_table().combine_chunks()
                lists = done.column("ids").combine_chunks()
                raw, offsets = lists.values.to_numpy().astype("<u4").tobytes(), (lists.offsets.to_numpy() * 4).tolist()
                for row, at in enumerate(done.column("word").to_pylist()):
                    yield words[part[at]], raw[offsets[row] : offsets[row + 1]]
                start = stop

    def _encode_words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of distinct words. Those of short ones stay in ``known_words``."""
        fresh = words - self.known_words.keys()
        if len(self.known_words) + len(fresh) > REMEMBERED:
            self.known_words, fresh = {}, words
        found, others = {}, []
        for word in fresh:
            rank = self.ranks.get(word.encode())
            if rank is None:
                others.append(word)
            else:
                found[word] = rank.to_bytes(4, "little")
        found.update(self._contracted(others))
        self.known_words.update(found)
        made = dict(zip(words, map(self.known_words.__getitem__, words), strict=True))
        for word in [w for w in found if len(w) > SHORT]:
            del self.known_words[word]
        return made

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        split = []
        for text in texts:
            first, *rest = [s[i > 0 :] for i, s in enumerate(self.safe.split(text))] if self.odd.search(text) else text.split(" ")
            split.append((first, rest))
        wanted = ({first for first, _ in split}, set(chain.from_iterable(rest for _, rest in split)))
        fresh = [of - known.keys() for of, known in zip(wanted, self.known, strict=True)]
        if sum(map(len, self.known)) + sum(map(len, fresh)) > REMEMBERED:
            self.known, fresh = ({}, {}), wanted
        for before, segments, known in zip(("", " "), fresh, self.known, strict=True):
            single = {s for s in segments if s.isalpha()} if self.plain else set()
            parts = {s: self.words.findall(before + s) for s in segments - single}
            ids = self._encode_words({before + s for s in single}.union(chain.from_iterable(parts.values())))
            known.update((s, ids[before + s]) for s in single)
            known.update((s, b"".join([ids[word] for word in words])) for s, words in parts.items())
        begin, after = self.known
        made = [begin[first] + b"".join(map(after.__getitem__, rest)) for first, rest in split]
        for segments, known in zip(fresh, self.known, strict=True):
            for segment in segments:
                if len(segment) > SHORT:
                    del known[segment]
        return made

    def decode(self, texts: list[bytes]) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        ids = np.frombuffer(b"".join(texts), "<u4").astype(np.int32)
        text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) // 4 for t in texts])
        parts: list[list[bytes]] = [[] for _ in texts]
        for start in range(0, len(ids), DECODE_IDS):
            block = slice(start, start + DECODE_IDS)
            pos = np.arange(len(ids[block]), dtype=np.int32)
            self._register("given", text=pa.array(text[block]), pos=pa.array(pos), id=pa.array(ids[block]))
            found = self.database.sql(DECODE).to_arrow_table()
            for i, piece in zip(found.column("text").to_pylist(), found.column("chars").to_pylist(), strict=True):
                parts[i].append(piece.encode("latin-1"))
        return [b"".join(p) for p in parts]


@lru_cache(maxsize=1)
def coder(ranks: str, pattern: str) -> Coder:
    """The coder of a worker."""
    return Coder(ranks, pattern)


def _mapped(docs: DataFrame, column: str, names: list[str], make: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """doc_id and the columns that ``make`` derives from slices of ``column``."""
    kinds = {"n_tokens": "bigint"}
    schema = T.StructType([docs.schema["doc_id"], *[field(name, kinds.get(name, "binary")) for name in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                made = [pa.array(x, pa.int64() if name in kinds else pa.binary()) for name, x in zip(names, make(part), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made], ["doc_id", *names])

    ship(docs.sparkSession)
    return docs.select("doc_id", column).mapInArrow(run, schema)


def _texts(part: pa.RecordBatch) -> list[str]:
    return [t or "" for t in part.column("text").to_pylist()]


def encode(docs: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers, as token files hold them)."""

    def make(part: pa.RecordBatch) -> list:
        ids = coder(ranks, pattern).encode(_texts(part))
        return [[len(i) // 4 for i in ids], ids]

    return _mapped(docs, "text", ["n_tokens", "ids"], make)


def decode(tokens: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and the decoded bytes of the ``ids`` of each row; null ids decode to nothing."""
    make = lambda part: [coder(ranks, pattern).decode([i or b"" for i in part.column("ids").to_pylist()])]
    return _mapped(tokens, "ids", ["decoded"], make)


def round_trip(docs: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids, and decoded: what ``decode`` makes of these ids, in the same pass."""

    def make(part: pa.RecordBatch) -> list:
        of = coder(ranks, pattern)
        ids = of.encode(_texts(part))
        return [[len(i) // 4 for i in ids], ids, of.decode(ids)]

    return _mapped(docs, "text", ["n_tokens", "ids", "decoded"], make)
