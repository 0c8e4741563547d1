"""URL filters: rules in a memory-mapped sorted array of digests, probed by binary search and confirmed in full.

``pages`` needs page_id and url; other columns are not read. A null url, or one without ``://``, has an empty host and
path, which no rule fits. Repeated rows are judged each; an empty table gives an empty table, no rules give the default
verdict throughout.

A rule is a host and the start of a path. It fits its host and all subdomains; the longest rule that fits wins. The
rules lie in one file: sorted 64-bit xxhash keys, offsets, and the full texts. Each executor gets the file through Spark
and maps it into memory, so its workers share one copy. An url is probed under each suffix of its host that has no more
labels than a rule, with each length of path that a rule has, so the cost of a long host is that of reading it; a key that
is found is confirmed by its text, so two texts of one key do no harm.
"""

from __future__ import annotations

import struct
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import ship

SEED = 0
# A list of rules beyond this many bytes is refused: it is kept whole by each executor.
MAX_BYTES = 2 << 30
ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HEAD = struct.Struct("<QQQQ")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _key(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}\n{path}".encode(), SEED)


def write_rules(rules: Iterable[Rule], path: Path, key=_key) -> None:
    """The file: counts, labels of the longest host, sorted keys, offsets of the texts, lengths of paths, texts (verdict, host, path by line)."""
    unique = {(r.host, r.path): r for r in rules}
    ordered = sorted(unique.values(), key=lambda r: (key(r.host, r.path), r.host, r.path))
    texts = [f"{r.verdict}\n{r.host}\n{r.path}".encode() for r in ordered]
    if sum(map(len, texts)) + 16 * len(texts) > MAX_BYTES:
        raise ValueError("the rules are too many for one executor's memory: filter with parts of them, one after the other")
    keys = np.array([key(r.host, r.path) for r in ordered], "<u8")
    offsets = np.cumsum([0, *map(len, texts)]).astype("<u8")
    lengths = np.unique(np.array([len(r.path) for r in ordered], "<u8"))
    labels = max((r.host.count(".") + 1 for r in ordered), default=0)
    with path.open("wb") as out:
        out.write(_HEAD.pack(len(keys), len(lengths), int(offsets[-1]), labels))
        for part in (keys, offsets, lengths):
            out.write(part.tobytes())
        for text in texts:
            out.write(text)


class DigestArray:
    """The mapped file."""

    def __init__(self, path: str, key=_key):
        raw = np.memmap(path, np.uint8, "r")
        count, kinds, size, self.labels = _HEAD.unpack(raw[: _HEAD.size].tobytes())
        at = _HEAD.size
        self.keys = raw[at : (at := at + 8 * count)].view("<u8")
        self.offsets = raw[at : (at := at + 8 * (count + 1))].view("<u8")
        self.lengths = raw[at : (at := at + 8 * kinds)].view("<u8").tolist()
        self.texts = raw[at : at + size]
        self.key = key

    def probe(self, candidates: list[tuple[str, str]]) -> list[str | None]:
        """The verdict of each (host, path) that is a rule, None for others: one vectorised search for all."""
        wanted = np.array([self.key(h, p) for h, p in candidates], np.uint64)
        found = np.searchsorted(self.keys, wanted)
        out: list[str | None] = [None] * len(candidates)
        hit = np.flatnonzero((found < len(self.keys)) & (self.keys[np.minimum(found, len(self.keys) - 1)] == wanted)) if len(self.keys) else []
        for i in hit:
            at = int(found[i])
            while at < len(self.keys) and self.keys[at] == wanted[i]:
                verdict, host, path = self.texts[int(self.offsets[at]) : int(self.offsets[at + 1])].tobytes().decode().split("\n", 2)
                if (host, path) == candidates[i]:
                    out[i] = verdict
                at += 1
        return out

    def match(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """The longest fitting rule of each url and its verdict."""
        candidates, owners = [], []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host:
                continue
            labels = host.rsplit(".", self.labels)[-self.labels :] if self.labels else []
            for suffix in {".".join(labels[j:]) for j in range(len(labels))}:
                for length in self.lengths:
                    if length <= len(path):
                        candidates.append((suffix, path[:length]))
                        owners.append(i)
        best: dict[int, tuple[int, str, str]] = {}
        for i, (host, path), verdict in zip(owners, candidates, self.probe(candidates), strict=True):
            if verdict is not None:
                best[i] = max(best.get(i, (-1, "", "")), (len(host) + len(path), host + path, verdict))
        return [best[i][1] if i in best else None for i in range(len(hosts))], [best[i][2] if i in best else None for i in range(len(hosts))]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: Iterable[Rule], default: str = ALLOW) -> DataFrame:
    """page_id, host, path, the rule that decides (or null) and the verdict (the default without a rule)."""
    spark = pages.sparkSession
    ship(spark)
    name = f"rules-{uuid.uuid4().hex}.bin"
    local = Path(tempfile.mkdtemp(prefix="kerbside-"), name)
    write_rules(rules, local)
    spark.sparkContext.addFile(str(local))
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = DigestArray(SparkFiles.get(name))
        for batch in batches:
            rule, verdict = array.match(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            verdict = [v or default for v in verdict]
            columns = [*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return split.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
