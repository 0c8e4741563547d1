"""Secret scans: wide candidate patterns, and a random forest that removes their false positives.

``docs`` needs doc_id and text for ``scan``, text for ``redact``; other columns are kept or ignored. Null and empty texts
have no findings; repeated rows are scanned each; an empty table gives an empty table. Texts are scanned whole.

The forest is trained from labelled findings: rows (text, start, end, label) that say where a candidate stands and
whether it is a secret. ``made_findings`` makes such rows by planting credentials and lookalikes in sentences.
"""

from __future__ import annotations

import base64
import math
import random
import re
import string
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import field, map_texts, shared_folder, ship, slices

TREES = 30
DEPTH = 8
THRESHOLD = 0.5
# The number of labelled findings made for training, half of them secrets.
FINDINGS = 6000
MASK = "[SECRET]"

_RUN = r"A-Za-z0-9+/_~.\-"
# Long runs of credential characters, or shorter ones that are assigned to something named like a credential.
_CANDIDATE = re.compile(
    rf"(?<![{_RUN}])(?:[{_RUN}]{{16,}}={{0,2}}|(?:(?<=[\"'=:])|(?<=[=:] ))[{_RUN}]{{8,15}}+={{0,2}}(?![{_RUN}]))"
)
# Whatever is assigned to something named like a credential, up to a space or quote; in a query string up to its next part.
_ASSIGNED = re.compile(
    r"""(?i:passw|passphrase|pwd|secret|token|key|credential|auth|bearer|private)[\w\-]{0,32}["'`]?[ \t]{0,3}(?:[=:]>|:=|[=:])[ \t]{0,3}"""
    r"""(?:["'`](?P<quoted>[^\s"'`]{6,})|(?P<bare>[^\s"'`]{6,}))"""
)
_SECRET_WORDS = ("token", "secret", "passw", "pwd", "key", "credential", "auth", "bearer", "private")
_PLAIN_WORDS = ("commit", "sha", "md5", "checksum", "digest", "uuid", "version", "build", "hash", "example", "file", "path", "id", "tel", "card")
_NAMED = re.compile(r"""(?i:passw|passphrase|pwd|secret|token|key|credential|auth|private)[\w\-]*["'`]?\s*[=:>]+\s*["'`]?$""")
# Code and fillers that stand where a value would.
_HOLDER = re.compile(r"""[({<\[]|\$\{|\*{4}|(?i:x{6}|your|example|change)""")
_PREFIX = re.compile(r"AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk[_-]|pk_|rk_|AIza|eyJ|glpat-|npm_|SG\.")
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[A-Za-z]+(?:[.\-/_][A-Za-z]+)*\.?$")


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    for found in _ASSIGNED.finditer(text):
        start, end = found.span(found.lastgroup)
        if found.lastgroup == "bare":
            line = text.rfind("\n", 0, found.start()) + 1
            if re.search(r"[?&][\w.\-]*$", text[max(line, found.start() - 64) : found.start()]):
                end = start + re.match(r"[^&#]*", text[start:end]).end()
            while end > start and text[end - 1] in ".,;)]}>":
                end -= 1
        if end - start >= 6:
            yield start, end


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Spans of what may be a secret, in order and apart; an assigned value is one as a whole, with any run that leaves it."""
    last = None
    for start, end in sorted([*_assigned(text), *_runs(text)]):
        if last is None or start >= last[1]:
            if last:
                yield last
            last = start, end
        else:
            last = last[0], max(last[1], end)
    if last:
        yield last


def _runs(text: str) -> Iterator[tuple[int, int]]:
    for found in _CANDIDATE.finditer(text):
        start, end = found.span()
        while end - start > 8 and text[end - 1] in ".-/~":
            end -= 1
        yield start, end


def vocabulary(path: str) -> frozenset[str]:
    """Letter pieces of a public vocabulary file of base64 tokens and ranks: the dictionary for coverage."""
    words = (base64.b64decode(line.split()[0]).decode("utf-8", "ignore").strip().lower() for line in Path(path).open("rb") if line.strip())
    return frozenset(w for w in words if 3 <= len(w) <= 12 and w.isascii() and w.isalpha())


def coverage(value: str, dictionary: frozenset[str]) -> float:
    """Share of the characters that lie in dictionary pieces, longest first from the left."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(min(12, len(low) - at), 2, -1) if low[at : at + n] in dictionary), 0)
        covered += size
        at += size or 1
    return covered / max(1, len(low))


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(text: str, start: int, end: int, dictionary: frozenset[str]) -> list[float]:
    value, n = text[start:end], end - start
    before, after = text[max(0, start - 48) : start], text[end : end + 32]
    counts = Counter(value)
    kinds = [_kind(c) for c in value]
    letters = [c for c in value.lower() if c.isalpha()]
    turns = sum((a in "aeiou") != (b in "aeiou") for a, b in zip(letters, letters[1:], strict=False))
    near = " ".join(_WORD.findall(before)[-4:] + _WORD.findall(after)[:2]).lower()
    held = before.rstrip().rstrip("\"'`").rstrip()
    inside = {c: value.count(c) for c in "/.-_"}
    return [
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1),
        len(counts) / n,
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        kinds.count(2) / n,
        kinds.count(1) / n,
        coverage(value, dictionary),
        turns / max(1, len(letters) - 1),
        float(inside["/"]),
        float(inside["."]),
        float(inside["-"] + inside["_"]),
        float(sum(w in near for w in _SECRET_WORDS)),
        float(sum(w in near.split() for w in _PLAIN_WORDS)),
        float(held[-1:] in ("=", ":")),
        float(before[-1:] in ("\"", "'", "`") and before[-1:] == after[:1]),
        float(bool(_PREFIX.match(value))),
        float(all(c in string.hexdigits for c in value)),
        float(value.isdigit()),
        float(bool(_SENTENCE.match(value))),
        float(value.isalpha() and (value[1:].islower() or value.isupper())),
        float(before[-1:].isalpha() or after[:1].isalpha()),
        float(before[-1:] == "@" or after[:1] == "@" or before[-3:] == "://"),
        kinds.count(3) / n,
        float(len(set(kinds))),
        float(bool(_NAMED.search(before))),
        float(bool(_HOLDER.search(value))),
    ]


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1 at leaves), threshold, children, and the probability of a secret."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    chance: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Mean over trees of the leaf's probability, for rows x features."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(rows), len(self.feature)), np.int64)
        for _ in range(DEPTH + 1):
            f = self.feature[trees, at]
            low = np.take_along_axis(rows, np.maximum(f, 0), axis=1) <= self.threshold[trees, at]
            at = np.where(f < 0, at, np.where(low, self.left[trees, at], self.right[trees, at]))
        return self.chance[trees, at].mean(axis=1)


# Fixed names and shapes of what is planted for training.
_NAMES = ("token", "secret", "api_key", "apiKey", "password", "access_key", "client_secret", "auth_token", "SECRET_KEY", "private_key")
_ASSIGN = ('{n} = "{v}"', "{n} = '{v}'", '{n}: "{v}"', "{n}={v}", "{n}: {v}", '"{n}": "{v}"', "{n} {v}", "Authorization: Bearer {v}")
_PLAIN = ("commit {v}", "sha1 {v}", "md5: {v}", "checksum = {v}", "uuid {v}", "id={v}", "build {v}", "file {v}", "see {v}", "version {v}", "{v}")


def _secret(rng: random.Random) -> str:
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    both, up = string.ascii_letters + string.digits, string.ascii_uppercase + string.digits
    hexes = "0123456789abcdef"
    kind = rng.randrange(12)
    if kind > 8:
        # what people type: any printable characters, or words made odd
        marks = "!#$%&*+-.?@^_~"
        word = lambda: "".join(rng.choice("bcdfghklmnprstvwz") + rng.choice("aeiou") for _ in range(rng.randrange(2, 4)))
        odd = lambda w: "".join({"a": "@", "e": "3", "i": "1", "o": "0", "s": "$"}.get(c, c) if rng.random() < 0.5 else c for c in w)
        shapes = (
            lambda: pick(both + marks * 2, rng.randrange(7, 20)) + rng.choice(marks) + rng.choice(string.digits),
            lambda: odd(word()).capitalize() + odd(word()) + rng.choice(marks) + pick(string.digits, rng.randrange(1, 5)),
            lambda: word() + pick(string.digits, rng.randrange(1, 3)) + rng.choice(marks) + rng.choice(marks) + word(),
            lambda: rng.choice(marks[:-3]).join(word() for _ in range(3)) + rng.choice(marks) + rng.choice(string.digits),
            lambda: odd(word()) + rng.choice(string.digits) + rng.choice("bcdfgh") + rng.choice(string.digits),
            lambda: odd(word()) + rng.choice(string.digits) + rng.choice(marks) + pick(both, rng.randrange(2, 5)),
        )
        name = rng.choice((*_NAMES, "password", "db_password", "passwd", "pwd", "pwd"))
        return rng.choice(_ASSIGN[:6]).format(n=name, v=rng.choice(shapes)())
    if kind < 3:
        return rng.choice(_ASSIGN).format(n=rng.choice(_NAMES), v=pick(hexes, rng.choice((32, 40, 40, 64))))
    if kind < 5:
        return rng.choice(_ASSIGN).format(n=rng.choice(_NAMES), v=pick(both + "+/-_", rng.randrange(20, 64)) + rng.choice(("", "", "=", "==")))
    if kind == 5:
        return rng.choice(_ASSIGN[:6]).format(n=rng.choice(_NAMES), v=pick(both, rng.randrange(10, 20)) + "7a")
    known = (f"{rng.choice(('AKIA', 'ASIA'))}{pick(up, 16)}", f"ghp_{pick(both, 36)}", f"sk_live_{pick(both, 24)}", f"xoxb-{pick(string.digits, 12)}-{pick(both, 24)}", f"AIza{pick(both + '-_', 35)}", f"eyJ{pick(both, 30)}.eyJ{pick(both, 60)}.{pick(both + '-_', 43)}")
    value = rng.choice(known[:1] * 5 + known)
    return value if kind == 6 else rng.choice(_ASSIGN).format(n=rng.choice(_NAMES), v=value) if kind == 7 else f'"{value}"'


def _lookalike(rng: random.Random, words: list[str]) -> str:
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    some = lambda n: [rng.choice(words) for _ in range(n)]
    hexes = "0123456789abcdef"
    kind = rng.randrange(19)
    if kind > 15:
        # words and code after the name of a credential
        code = (f"os.environ['{some(1)[0].upper()}']", f"get_{some(1)[0]}()", f"${{{'_'.join(some(2)).upper()}}}", f"{{{{ {some(1)[0]} }}}}", f"<{'-'.join(some(2))}>", "********", f"{some(1)[0]}.{some(1)[0]}({some(1)[0]})")
        word = rng.choice(sorted(w for w in words if len(w) > 5)) if rng.random() < 0.5 else "".join(some(2))
        value = rng.choice(code) if rng.random() < 0.4 else rng.choice((word, word.capitalize(), f"{word},", f"{word}.", f"({word})"))
        return rng.choice(("{n}: {v}", "{n} = {v}", "{n}={v}", '{n}: "{v}"')).format(n=rng.choice((*_NAMES, "password", "key", "pwd")), v=value)
    if kind > 13:
        # a word of no known language, maybe cut at a letter beyond ASCII
        word = "".join(rng.choice("bcdfghklmnprstvwz") + rng.choice(("a", "e", "i", "o", "u", "ei", "au", "io")) + rng.choice(("", "n", "r", "st", "ng", "ch", "t")) for _ in range(rng.randrange(6, 11)))
        word = rng.choice((word, word.capitalize(), word.upper()))
        return rng.choice((word, f"ü{word}", f"{word}é", f"{word}.", f"{word},"))
    if kind < 4:
        word = "".join(some(rng.randrange(4, 9)))
        return rng.choice((word, word.capitalize(), word.upper(), f"{word}.", ".".join(some(4)), "-".join(some(5)), f"{rng.choice(_NAMES)} = {word}"))
    if kind == 4:
        return rng.choice(_PLAIN[:6]).format(v=pick(hexes, rng.choice((32, 40, 64))))
    if kind == 5:
        return rng.choice(_PLAIN).format(v="-".join(pick(hexes, n) for n in (8, 4, 4, 4, 12)))
    if kind == 6:
        return rng.choice(("{v}", "card {v}", "id {v}", "{v}.")).format(v=pick(string.digits, rng.randrange(16, 20)))
    if kind == 7:
        return f"{'.'.join(some(2))}.{pick(string.digits, 2)}@mail{rng.randrange(10)}.example.com"
    if kind == 8:
        return f"https://{''.join(some(2))}.example.com/{'/'.join(some(3))}/{rng.randrange(99999)}.html"
    if kind == 9:
        return rng.choice(_PLAIN).format(v="/" + "/".join(some(4)) + rng.choice((".py", ".txt", "", ".tar.gz")))
    if kind == 10:
        return "_".join(some(4)) + rng.choice(("", "()", "_v2")) if rng.random() < 0.5 else some(1)[0] + "".join(w.capitalize() for w in some(4))
    if kind == 11:
        value = rng.choice(("x" * 24, "X" * 32, "0" * 32, "your-api-key-here", "example_token_value", "changeme-changeme", "<insert-your-token-here>", "1234567890123456", "abcdefghijklmnop"))
        return rng.choice(_ASSIGN).format(n=rng.choice(_NAMES), v=value)
    if kind == 12:
        return rng.choice(_PLAIN).format(v=f"{'-'.join(some(2))}-{rng.randrange(10)}.{rng.randrange(20)}.{rng.randrange(9)}-{rng.choice(('alpha', 'rc1', 'release'))}")
    return rng.choice(_ASSIGN).format(n=rng.choice(("key", "name", "title", "path")), v="-".join(some(4)))


def made_findings(spark: SparkSession, dictionary: frozenset[str], count: int = FINDINGS, seed: int = 42) -> DataFrame:
    """``count`` labelled findings (text, start, end, label): every other planted thing is a secret."""
    words = sorted(w for w in dictionary if len(w) < 7)
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i in batch.column("id").to_pylist():
                rng = random.Random(seed * 1_000_003 + i)
                label = i % 2
                thing = _secret(rng) if label else _lookalike(rng, words)
                around = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(2)]
                text = f"{around[0]} {thing} {around[1]}"
                if rng.random() < 0.1:
                    text = text.upper()
                for start, end in candidates(text):
                    if start < len(around[0]) + 1 + len(thing) and end > len(around[0]):
                        made.append((text, start, end, float(label)))
            columns = list(zip(*made, strict=True)) or [[]] * 4
            types = (pa.string(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["text", "start", "end", "label"])

    return spark.range(count).mapInArrow(run, "text string, start int, end int, label double")


def fit(findings: DataFrame, dictionary: frozenset[str], trees: int = TREES, depth: int = DEPTH, seed: int = 42) -> Forest:
    """Train on labelled findings (a bounded table) and read the trees back as arrays for the scanning tasks."""
    spark = findings.sparkSession
    ship(spark)
    words = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "start", "end")), strict=True)
            made = [features(t, a, b, words.value) for t, a, b in rows]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(made, pa.list_(pa.float64()))], ["label", "features"])

    rows = findings.select("label", "text", "start", "end").mapInArrow(run, "label double, features array<double>")
    rows = rows.withColumn("features", array_to_vector("features"))
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(rows)
    path = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()  # trees x 2**(depth + 1) rows at most
    most = max(r.id for r in nodes) + 1
    shape = (trees, most)
    out = Forest(np.full(shape, -1), np.zeros(shape), np.zeros(shape, int), np.zeros(shape, int), np.zeros(shape))
    for r in nodes:
        total = sum(r.impurityStats)
        out.chance[r.treeID, r.id] = r.impurityStats[1] / total if total else 0.0
        if r.leftChild >= 0:
            out.feature[r.treeID, r.id] = r.split.featureIndex
            out.threshold[r.treeID, r.id] = r.split.leftCategoriesOrThreshold[0]
            out.left[r.treeID, r.id], out.right[r.treeID, r.id] = r.leftChild, r.rightChild
    return out


class Scanner:
    """Finds secrets in texts; holds the broadcast forest and dictionary."""

    def __init__(self, spark: SparkSession, forest: Forest, dictionary: frozenset[str], threshold: float = THRESHOLD):
        self.sent, self.threshold = spark.sparkContext.broadcast((forest, dictionary)), threshold

    def __call__(self, texts: list[str | None]) -> tuple[list[int], list[list[tuple[int, int, float]]]]:
        """For each text its number of candidates and the findings (start, end, score) in code points."""
        forest, dictionary = self.sent.value
        spans = [(i, a, b) for i, t in enumerate(texts) if t for a, b in candidates(t)]
        counts, found = [0] * len(texts), [[] for _ in texts]
        scores = forest.score(np.array([features(texts[i], a, b, dictionary) for i, a, b in spans])) if spans else []
        for (i, a, b), score in zip(spans, scores, strict=True):
            counts[i] += 1
            if score > self.threshold:
                found[i].append((a, b, float(score)))
        return counts, found


def trained(spark: SparkSession, vocabulary_file: str | None = None) -> Scanner:
    """The scanner of the registered query: trained from ``FINDINGS`` made findings."""
    dictionary = vocabulary(vocabulary_file or str(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return Scanner(spark, fit(made_findings(spark, dictionary), dictionary), dictionary)


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """doc_id, n_candidates, n_secrets and findings (start, end, secret, score) of every row."""

    def make(texts: pa.Array) -> list:
        values = texts.to_pylist()
        counts, found = scanner(values)
        cut = [[t[a:b] for a, b, _ in f] for t, f in zip(values, found, strict=True)]
        return [counts, [[x[0] for x in f] for f in found], [[x[1] for x in f] for f in found], cut, [[x[2] for x in f] for f in found]]

    fields = [field("n_candidates", "bigint"), field("start", "[int]"), field("end", "[int]"), field("secret", "[string]"), field("score", "[double]")]
    found = map_texts(docs, make, fields)
    return found.select("doc_id", "n_candidates", F.size("start").cast("bigint").alias("n_secrets"), F.arrays_zip("start", "end", "secret", "score").alias("findings"))


def redact(docs: DataFrame, scanner: Scanner, mask: str = MASK) -> DataFrame:
    """All rows and columns of ``docs``, secrets in the text replaced by ``mask`` (and n_chars, where there, counted anew)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                _, found = scanner(texts)
                changed = [i for i, f in enumerate(found) if f]
                for i in changed:
                    for start, end, _ in reversed(found[i]):
                        texts[i] = texts[i][:start] + mask + texts[i][end:]
                columns = {name: part.column(name) for name in part.schema.names}
                if changed:
                    columns["text"] = pa.array(texts, part.column("text").type)
                    if "n_chars" in columns:
                        sizes = columns["n_chars"].to_pylist()
                        for i in changed:
                            sizes[i] = len(texts[i])
                        columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, docs.schema)
