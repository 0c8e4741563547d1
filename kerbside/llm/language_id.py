"""Language identification in two levels: the family first, then linear SVMs between each two languages of the family.

Training rows need doc_id, text and lang, rows to judge doc_id and text; nothing else is read. A null text, or one
without any letter, is ``und`` with score 0, and so is every text where no labelled text was given. Texts are read whole
for training and prediction. Repeated rows and ids are judged each; empty tables give empty tables.

Features are the shares of hashed byte 1-, 2- and 3-grams of the lower-cased text, digits, white space and ASCII
punctuation taken as a space. A prediction is the mean of the grams' weights, so no vector is built for it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import field, filter_texts, map_texts, written

# Families by language code; a language that is not named here is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ca": "romance", "ro": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic",
}
# The models are fitted on about this many labelled texts of each language (all of them where there are fewer), chosen
# by a hash of id and text. Everything else sees all documents.
SAMPLE_PER_LANGUAGE = 1000
BUCKETS = 2048
UNDETERMINED = "und"
# Iterations of each fit; a looser tolerance than Spark's own ends most fits earlier.
STEPS = 15
TOLERANCE = 1e-3
# The sample is bounded, so a few partitions hold it and each iteration is one short job.
SAMPLE_PARTITIONS = 6

_LETTER = regex.compile(r"\p{L}")
_SPACE = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class Model:
    """Weights over gram buckets; the last entry of each is the constant."""

    families: tuple[str, ...]
    languages: dict[str, tuple[str, ...]]
    family_weights: np.ndarray  # families x (buckets + 1)
    pair_weights: dict[tuple[str, str], np.ndarray]  # above 0: the first language


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all grams of all texts, gram size by gram size, and where each text starts and ends in the bytes."""
    parts = [b" " + t.lower().encode().translate(_SPACE) + b"  " for t in texts]
    ends = np.cumsum([len(p) for p in parts])
    raw = np.frombuffer(b"".join(parts) + b"  ", np.uint8).astype(np.uint32)
    n = len(raw) - 2
    keys = [raw[:n] + np.uint32(1 << 24)]
    keys.append((raw[:n] << np.uint32(8)) + raw[1 : n + 1] + np.uint32(1 << 25))
    keys.append((keys[1] << np.uint32(8)) + raw[2 : n + 2])
    shift = np.uint32(32 - int(math.log2(BUCKETS)))
    buckets = np.stack([(k * np.uint32(2654435761)) >> shift for k in keys]).astype(np.int32)
    return buckets, np.concatenate([[0], ends[:-1]]), ends


def shares(texts: list[str]) -> np.ndarray:
    """Texts x buckets: thousandths of a text's grams that fall into the bucket."""
    buckets, starts, ends = grams(texts)
    out = np.empty((len(texts), BUCKETS), np.float32)
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        out[i] = np.bincount(buckets[:, a:b].ravel(), minlength=BUCKETS) * (1000.0 / (3 * (b - a)))
    return out


def means(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Texts x rows of ``weights``: constant plus weighted shares."""
    buckets, starts, ends = grams(texts)
    size = (3.0 * (ends - starts)) / 1000.0
    out = np.empty((len(texts), len(weights)))
    for k, row in enumerate(weights):
        gathered = row[:-1].astype(np.float32)[buckets].sum(axis=0, dtype=np.float64)
        out[:, k] = np.add.reduceat(gathered, starts) / size + row[-1]
    return out


def _training(labelled: DataFrame, per_language: int) -> DataFrame:
    """(lang, features) of the bounded sample."""

    def rows_of(sample: DataFrame) -> DataFrame:
        rows = map_texts(sample, make, [field("shares", "[float]")], ("lang",))
        rows = written(rows.repartition(SAMPLE_PARTITIONS), "language-sample")
        return rows.select("lang", array_to_vector("shares").alias("features"))

    def make(texts: pa.Array) -> list:
        return [list(shares(texts.to_pylist()))]

    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    # one number per language; the texts stay where they are
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return rows_of(labelled)
    parts = 1 << 30
    bounds = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, per_language / n) * parts))])
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit("sample")), F.lit(parts)) < F.element_at(bounds, F.col("lang"))
    return rows_of(labelled.filter(drawn))


def fit(labelled: DataFrame, families: dict[str, str] | None = None, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fit on rows with a non-null lang; None if there are none."""
    rows = _training(labelled, per_language)
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not languages:
        return None
    of = {lang: (families or FAMILIES).get(lang, lang) for lang in languages}
    names = tuple(sorted(set(of.values())))
    members = {f: tuple(lang for lang in languages if of[lang] == f) for f in names}
    family_weights = np.zeros((len(names), BUCKETS + 1))
    if len(names) > 1:
        number = reduce(lambda c, x: c.when(F.col("lang") == x, float(names.index(of[x]))), languages, F)
        fitted = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=STEPS, tol=TOLERANCE).fit(rows.withColumn("label", number))
        family_weights = np.column_stack([fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()])
    pairs = {}
    for inside in members.values():
        for first, second in combinations(inside, 2):
            both = rows.filter(F.col("lang").isin(first, second))
            label = F.when(F.col("lang") == first, 1.0).otherwise(0.0)
            svm = LinearSVC(regParam=1e-2, maxIter=STEPS, tol=TOLERANCE).fit(both.withColumn("label", label))
            pairs[first, second] = np.append(svm.coefficients.toArray(), svm.intercept)
    return Model(names, members, family_weights, pairs)


def judge(texts: list[str], model: Model) -> tuple[list[str], list[float]]:
    """Language and score of texts that have letters.

    The score is the probability of the family times the winner's mean pairwise confidence (0.5: undecided).
    """
    pairs = list(model.pair_weights)
    found = means(texts, np.vstack([model.family_weights, *(model.pair_weights[p] for p in pairs)]))
    k = len(model.families)
    odds = np.exp(found[:, :k] - found[:, :k].max(axis=1, keepdims=True))
    odds /= odds.sum(axis=1, keepdims=True)
    sure = {p: 1 / (1 + np.exp(-2 * np.clip(found[:, k + i], -50, 50))) for i, p in enumerate(pairs)}
    langs, scores = [], []
    for i, f in enumerate(odds.argmax(axis=1)):
        inside = model.languages[model.families[f]]
        best, confidence = inside[0], 1.0
        if len(inside) > 1:
            duels = {a: [sure[a, b][i] if (a, b) in sure else 1 - sure[b, a][i] for b in inside if b != a] for a in inside}
            best = max(inside, key=lambda a: (sum(p > 0.5 for p in duels[a]), sum(duels[a]), a))
            confidence = sum(duels[best]) / len(duels[best])
        langs.append(best)
        scores.append(float(odds[i, f]) * float(confidence))
    return langs, scores


def _judged(texts: list[str | None], model: Model | None) -> tuple[list[str], list[float]]:
    langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    known = [i for i, t in enumerate(texts) if model is not None and t and _LETTER.search(t)]
    if known:
        for i, lang, score in zip(known, *judge([texts[i] for i in known], model), strict=True):
            langs[i], scores[i] = lang, score
    return langs, scores


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every row."""

    def make(texts: pa.Array) -> list:
        return list(_judged(texts.to_pylist(), model))

    return map_texts(docs, make, [field("lang_pred", "string"), field("score", "double")])


def held_out(doc_id: str = "doc_id"):
    """Rows whose id hash is a multiple of 5: never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def with_language(docs: DataFrame, model: Model | None, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text has a language with at least this score."""

    def keeps(texts: pa.Array) -> list[bool]:
        return [lang != UNDETERMINED and score >= min_score for lang, score in zip(*_judged(texts.to_pylist(), model), strict=True)]

    return filter_texts(docs, keeps)
