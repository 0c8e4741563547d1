"""Mixing sources to target weights: temperature mixing, realised as budgeted permutations of blocks.

``docs`` needs doc_id, text and source; all its columns are kept, but ``mix_epoch``, ``mix_block``, ``mix_position`` and
``n_tokens``, if it has any of those, are replaced. A null source is a source of its own. Null and empty texts have no
tokens; a source without tokens has weight 0 and each of its rows comes once. Repeated rows count and come each. An
empty table gives an empty table. With ``model``, the path of a sentencepiece model that every executor can open, tokens
are its tokens; without, they are what the function ``tokens`` makes of a text: words, which say nothing of texts without
spaces.

A source's weight is its share of tokens to the power of an exponent between 0 and 1. The exponent is the largest that
meets the target entropy, raised as far as needed to keep within the repetition limit. Without a budget the mixture is
the smallest that holds every document at least once; with one, sources may also be cut. Whole epochs hold all blocks of
a source in an order drawn per epoch; the last, broken one holds blocks in that order until its tokens are used up.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import written
from kerbside.llm.token_counts import with_tokens

# Share of the largest possible entropy (all sources alike) to reach, and how often a document may come at most.
TARGET_ENTROPY = 0.95
MAX_REPEATS = 4.0
# A block is about this many tokens, and a source has no more blocks than this, so that their list stays small.
BLOCK_TOKENS = 1 << 16
MAX_BLOCKS = 1 << 16
SEED = 42
RESULT = ("n_tokens", "mix_epoch", "mix_block", "mix_position")

_ALL = (1 << 63) - 1


@dataclass(frozen=True)
class Plan:
    """The exponent, and per source (source, tokens, weight, repeats) as a frame."""

    exponent: float
    sources: DataFrame


def n_tokens(text: Column) -> Column:
    """Words, as a cheap stand-in for tokens where no model is given."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def _entropies(totals: DataFrame, most: int, exponents: list[float]) -> list[float]:
    """Entropy of the weights at each exponent, from one pass over the sources."""
    low = F.log(F.col("tokens") / F.lit(float(most)))
    sums = [x for a in exponents for x in (F.sum(F.exp(low * a)), F.sum(F.exp(low * a) * low))]
    row = totals.filter("tokens > 0").agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    return [math.log(row[2 * i]) - a * row[2 * i + 1] / row[2 * i] for i, a in enumerate(exponents)]


def choose_exponent(totals: DataFrame, target: float, max_repeats: float, budget: int | None = None) -> float:
    """The largest exponent that meets the entropy, or a larger one if only that meets the repetition limit.

    Both are monotone in the exponent. Each round cuts the interval into 16 parts at once, six rounds give 24 bits.
    """
    head = totals.agg(F.max("tokens"), F.min(F.when(F.col("tokens") > 0, F.col("tokens"))), F.sum((F.col("tokens") > 0).cast("int")), F.sum("tokens")).first()
    most, least, count, total = head
    if not most or count < 2:
        return 1.0
    low, high = 0.0, 1.0
    if _entropies(totals, most, [1.0])[0] < target * math.log(count):
        for _ in range(6):
            grid = [low + (high - low) * i / 16 for i in range(17)]
            met = [a for a, h in zip(grid, _entropies(totals, most, grid), strict=True) if h >= target * math.log(count)]
            low = max(met, default=low)
            high = min((a for a in grid if a > low), default=high)
    else:
        low = 1.0

    def repeats(a: float) -> float:
        """How often the smallest source comes, the most repeated one."""
        if budget is None:
            return (most / least) ** (1 - a)
        size = totals.filter("tokens > 0").agg(F.sum(F.pow(F.col("tokens") / F.lit(float(most)), F.lit(a)))).first()[0]
        return (least / most) ** a / size * budget / least

    if repeats(low) > max_repeats:
        left, right = low, 1.0
        for _ in range(24):
            middle = (left + right) / 2
            left, right = (left, middle) if repeats(middle) <= max_repeats else (middle, right)
        low = right
    return low


def plan(
    totals: DataFrame, target: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, budget: int | None = None
) -> Plan:
    """Weights and repeats of each source of ``totals`` (source, tokens)."""
    exponent = choose_exponent(totals, target, max_repeats, budget)
    head = totals.agg(F.max("tokens").alias("most")).select(F.coalesce("most", F.lit(0))).first()[0]
    share = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(1, head))), F.lit(exponent))).otherwise(0.0)
    size = totals.agg(F.coalesce(F.sum(share), F.lit(0.0))).first()[0] or 1.0
    weight = share / F.lit(size)
    amount = F.lit(float(budget)) if budget is not None else F.lit(head * size)
    repeats = F.when(F.col("tokens") > 0, weight * amount / F.col("tokens")).otherwise(1.0)
    # the largest source comes exactly once without a budget, whatever the rounding
    repeats = F.when((repeats - F.round(repeats)).between(-1e-9, 1e-9), F.round(repeats)).otherwise(repeats)
    return Plan(exponent, totals.withColumn("weight", weight).withColumn("repeats", repeats))


def schedule(slim: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """(source, blocks, block, epoch, position, upto) of every block in every epoch it belongs to.

    Documents of a block are taken up to the hash ``upto``; that is all of them but in the block where a budget ends.
    """
    sized = sources.select(F.col("source").alias("of"), "tokens", "repeats", F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("tokens") / BLOCK_TOKENS))).cast("int").alias("blocks"))
    blocked = slim.join(sized, slim["source"].eqNullSafe(sized["of"])).withColumn("block", F.pmod("h", "blocks").cast("int"))
    blocks = written(
        blocked.groupBy("source", "block").agg(F.sum("n").alias("size"), *[F.first(c).alias(c) for c in ("tokens", "repeats", "blocks")]), "blocks"
    )
    epochs = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil("repeats").cast("int")) - 1))
    drawn = blocks.select("*", epochs.alias("epoch")).withColumn("drawn", F.xxhash64("source", "block", "epoch", F.lit(seed)))
    line = Window.partitionBy("source", "epoch").orderBy("drawn", "block").rowsBetween(Window.unboundedPreceding, 0)
    placed = drawn.withColumn("through", F.sum("size").over(line)).withColumn("before", F.col("through") - F.col("size"))
    left = F.when(F.col("tokens") > 0, (F.col("repeats") - F.col("epoch")) * F.col("tokens")).otherwise(F.lit(0.0))
    fallback = F.pmod("drawn", F.lit(1 << 30)) / F.lit(float(1 << 30))
    position = F.when(F.col("tokens") > 0, (F.col("epoch") * F.col("tokens") + F.col("before")) / (F.col("repeats") * F.col("tokens"))).otherwise(fallback)
    placed = written(placed.withColumn("left", F.round(left).cast("bigint") - F.col("before")).withColumn("position", position), "placed")
    whole = placed.filter((F.col("left") >= F.col("size")) | (F.col("tokens") == 0)).withColumn("upto", F.lit(_ALL))
    cut = placed.filter((F.col("left") < F.col("size")) & (F.col("left") > 0))
    inside = blocked.select(F.col("source").alias("of"), F.col("block").alias("in"), "h", "n").join(
        cut, F.col("of").eqNullSafe(F.col("source")) & (F.col("in") == F.col("block"))
    )
    summed = inside.groupBy(*[F.col(c) for c in placed.columns], "h").agg(F.sum("n").alias("n"))
    within = Window.partitionBy("source", "block", "epoch").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    fitting = summed.withColumn("used", F.sum("n").over(within)).filter("used <= left")
    partly = fitting.groupBy(*[F.col(c) for c in placed.columns]).agg(F.max("h").alias("upto"))
    picked = ("source", "blocks", "block", "epoch", "position", "upto")
    return whole.select(*picked).unionByName(partly.select(*picked))


def mix(
    docs: DataFrame,
    target: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    budget: int | None = None,
    seed: int = SEED,
    tokens=n_tokens,
    model: str | None = None,
    columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """The mixture: a row for each time a document comes, with its n_tokens, epoch, block and block's position (0 to 1).

    Read in the order of mix_position, sources come in proportion to their weights all along. ``columns`` names those of
    ``docs`` to keep, source among them, instead of all. A model's tokens are counted once and kept with these columns.
    """
    order = F.xxhash64("doc_id", "text", F.lit(seed))
    kept = [c for c in columns or docs.columns if c not in RESULT]
    if model is None:
        at = docs.select(*kept, order.alias("mix__h"), tokens(F.col("text")).alias("n_tokens"))
    else:
        at = written(with_tokens(docs.withColumn("mix__h", order), model, (*kept, "mix__h")), "counted")
    slim = written(at.select("source", F.col("mix__h").alias("h"), F.col("n_tokens").alias("n")), "slim")
    totals = written(slim.groupBy("source").agg(F.sum("n").alias("tokens")), "totals")
    steps = schedule(slim, plan(totals, target, max_repeats, budget).sources, seed)
    steps = written(steps.select(*[F.col(c).alias(f"mix__{c}") for c in steps.columns]), "schedule")
    counts = steps.select("mix__source", "mix__blocks").distinct().select(F.col("mix__source").alias("mix__of"), F.col("mix__blocks").alias("mix__n"))
    at = at.join(counts, F.col("source").eqNullSafe(F.col("mix__of")))
    same = F.col("source").eqNullSafe(F.col("mix__source")) & (F.pmod("mix__h", "mix__n").cast("int") == F.col("mix__block"))
    found = at.join(steps, same & (F.col("mix__h") <= F.col("mix__upto")))
    return found.select(*kept, "n_tokens", F.col("mix__epoch").alias("mix_epoch"), F.col("mix__block").alias("mix_block"), F.col("mix__position").alias("mix_position"))
