"""Fill-in-middle: texts cut into prefix, middle and suffix at whole units, found in a Fenwick tree over text blocks.

``docs`` needs doc_id and text; other columns are not read. A null text counts as empty and stays plain; repeated rows
give a row each (with the same cuts); a null id counts as the empty string; an empty table gives an empty table.

A text's UTF-8 bytes are divided into blocks of fixed size. Two Fenwick trees hold how many units and how many code
points begin in each block. A cut after so many units is found by descending the unit tree bit by bit to the block in
which the next unit begins, and then among that block's own unit starts; the code points before it are a prefix sum of
the other tree and a count in the block. Memory is a few bytes for each byte of a slice of texts or of one long text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.common import arrow_type, field, ship, slices, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Texts of a hundred that are cut, and of these the ones that put the suffix first.
CUT, SUFFIX_FIRST = 90, 20
BLOCK = 4096
CODE_POINT = None
WORDS = r"\S+\s*"


class Fenwick:
    """Prefix sums of counts by block."""

    def __init__(self, counts: np.ndarray):
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        at = np.arange(1, len(sums))
        self.tree = np.concatenate([[0], sums[1:] - sums[at - (at & -at)]]).tolist()
        self.top = 1 << (len(self.tree) - 1).bit_length() >> 1 if len(self.tree) > 1 else 0

    def before(self, block: int) -> int:
        """The sum of the blocks before ``block``."""
        total = 0
        while block:
            total += self.tree[block]
            block &= block - 1
        return total

    def find(self, count: int) -> tuple[int, int]:
        """The last block with no more than ``count`` before it, and what is left of ``count`` there."""
        block, step = 0, self.top
        while step:
            if block + step < len(self.tree) and self.tree[block + step] <= count:
                block += step
                count -= self.tree[block]
            step >>= 1
        return block, count


class Blocks:
    """A text in blocks. ``units`` is a pattern of what must not be cut, matched from left to right; None: code points.

    What the pattern skips belongs to the unit before it, at the beginning of a text to the first.
    """

    def __init__(self, text: bytes, units: str | None = CODE_POINT):
        self.text, raw = text, np.frombuffer(text, np.uint8)
        blocks = -(-len(raw) // BLOCK)
        self.points = (raw & 0xC0) != 0x80
        self.starts = self.points if units is None else self._starts(units)
        at = np.arange(blocks) * BLOCK
        count = lambda mask: np.add.reduceat(mask, at, dtype=np.int64) if blocks else np.zeros(0, np.int64)
        counts = count(self.starts)
        self.n = int(counts.sum())
        self.units = Fenwick(counts)
        self.code_points = self.units if units is None else Fenwick(count(self.points))

    def _starts(self, units: str) -> np.ndarray:
        text = self.text.decode("utf-8", "replace")
        found = np.array([m.start() for m in regex.finditer(units, text) if m.end() > m.start()], np.int64)
        starts = np.zeros(len(self.text), bool)
        if len(found):
            found[0] = 0
            starts[np.flatnonzero(self.points)[found]] = True
        return starts

    def cut(self, count: int) -> tuple[int, int]:
        """Bytes and code points of the first ``count`` units."""
        if count >= self.n:
            end = len(self.text)
            return end, self.code_points.before(len(self.code_points.tree) - 1)
        if count <= 0:
            return 0, 0
        block, left = self.units.find(count)
        base = block * BLOCK
        at = base + int(np.flatnonzero(self.starts[base : base + BLOCK])[left])
        return at, self.code_points.before(block) + int(np.count_nonzero(self.points[base:at]))


def drawn(doc_id: object, seed: int = 1) -> list[int]:
    """Four numbers below 2**32 that follow from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _whole_markers(markers: tuple[str, str, str]) -> tuple[str, str, str]:
    """The markers, if none can arise where a text and a marker meet: their first letters come nowhere else in them."""
    firsts = {m[:1] for m in markers}
    if len(set(markers)) < 3 or "" in firsts or any(c in firsts for m in markers for c in m[1:]):
        raise ValueError("markers must differ and must not begin with a letter that another place of them holds")
    if any(a != b and b.startswith(a) for a in markers for b in markers):
        raise ValueError("no marker may begin with another")
    return markers


def transform(docs: DataFrame, units: str | None = CODE_POINT, seed: int = 1, cut: int = CUT, suffix_first: int = SUFFIX_FIRST,
              markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output.

    ``psm`` puts the prefix first, ``spm`` the suffix; ``plain`` texts stay as they are: empty ones, those that hold a
    marker, and those that the draw leaves out.
    """
    p, s, m = (x.encode() for x in _whole_markers(markers))

    def one(doc_id: object, text: bytes) -> tuple:
        blocks = Blocks(text, units)
        first, second, chance, order = drawn(doc_id, seed)
        if not text or p in text or s in text or m in text or chance % 100 >= cut:
            return blocks.n, "plain", None, None, text
        a, b = sorted((first % (blocks.n + 1), second % (blocks.n + 1)))
        (start, prefix_chars), (end, chars) = blocks.cut(a), blocks.cut(b)
        prefix, middle, suffix = text[:start], text[start:end], text[end:]
        if order % 100 < suffix_first:
            return blocks.n, "spm", prefix_chars, chars - prefix_chars, b"".join((s, suffix, p, prefix, m, middle))
        return blocks.n, "psm", prefix_chars, chars - prefix_chars, b"".join((p, prefix, s, suffix, m, middle))

    schema = T.StructType([
        docs.schema["doc_id"], field("n", "bigint"), field("form", "string"), field("prefix_chars", "bigint"),
        field("middle_chars", "bigint"), field("output", "string"),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = part.column("doc_id")
                made = [one(i, t) for i, t in zip(ids.to_pylist(), text_bytes(part.column("text")), strict=True)]
                columns = [pa.array(x, arrow_type(f.dataType)) for x, f in zip(list(zip(*made, strict=True))[:-1], schema.fields[1:-1], strict=True)]
                output = pa.array([row[-1] for row in made], pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([ids, *columns, output], schema.names)

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``output`` was made of. Each marker comes once in it, unless it is plain."""
    p, s, m = _whole_markers(markers)
    after = lambda text, mark: F.substring_index(text, mark, -1)
    until = lambda text, mark: F.substring_index(text, mark, 1)
    psm = F.concat(after(until(output, s), p), after(output, m), until(after(output, s), m))
    spm = F.concat(until(after(output, p), m), after(output, m), after(until(output, p), s))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
