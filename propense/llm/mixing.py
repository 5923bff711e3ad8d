"""Mixing sources by temperature.

Source shares of tokens are raised to an exponent (1: as they are, 0: all sources alike, above 1: the large
ones more) and normalised. The exponent is bisected: the flattest mixture whose entropy stays within a target and that
repeats no source more often than allowed. Each source then has a token budget. Its documents are read
in passes, each in a seeded permutation of its own, until the budget is used; the place in that stream
says to which block a document goes, so every block of the result mixes the sources by their weights.

Running totals within a source are taken in two steps, over slots of the hash order and within a slot, so
that no task holds a source, however large it is.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propense.llm.common import stored

#: Documents per slot of a source's permutation, and tokens per block of the result.
SLOT_DOCS = 5_000
BLOCK_TOKENS = 1_000_000
MAX_REPEATS = 4.0
#: The query's target: this share of the largest possible entropy.
ENTROPY_SHARE = 0.98
#: Exponents tried in one pass over the sources; each pass narrows the interval by as much.
TRIED = 32
#: The exponent grows up to this power of two.
MAX_DOUBLINGS = 10


@dataclass(frozen=True)
class Target:
    """``entropy`` in nats, or as ``entropy_share`` of the logarithm of the number of sources."""

    entropy: float | None = None
    entropy_share: float | None = None
    max_repeats: float = MAX_REPEATS
    #: Tokens of the result; None: as many as there are.
    budget: int | None = None


def count_tokens(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def source_totals(docs: DataFrame, source: str = "source", tokens: str = "tokens") -> DataFrame:
    """(source, docs, tokens) of the sources that have tokens; null is a source of its own."""
    return docs.where(F.col(tokens) > 0).groupBy(source).agg(F.count("*").alias("docs"), F.sum(tokens).alias("tokens"))


@dataclass(frozen=True)
class Temperature:
    """The exponent found, the sum of powered shares ``z``, all tokens, the budget and the largest source's tokens.

    ``met`` is false where no exponent has the entropy wanted within the repetition limit.
    """

    exponent: float
    z: float
    whole: int
    budget: int
    largest: int
    met: bool


def find_exponent(totals: DataFrame, target: Target) -> Temperature:
    """The flattest mixture within ``target``.

    Entropy falls as the exponent grows. Where the sources as they are (exponent 1) are flatter than wanted,
    the exponent grows above 1, for as long as no source is repeated too often; sources that are all alike
    stay so, and then the target is not met.
    """
    whole, count, largest = totals.agg(F.sum("tokens"), F.count("*"), F.max("tokens")).first()
    if not whole:
        return Temperature(1.0, 1.0, 0, 0, 1, True)
    budget = whole if target.budget is None else target.budget
    if budget > target.max_repeats * whole:
        raise ValueError(f"{budget} tokens need more than {target.max_repeats} repeats of {whole}")
    ceiling = math.inf if target.entropy is None else target.entropy
    if target.entropy_share is not None:
        ceiling = min(ceiling, target.entropy_share * math.log(count))
    # relative to the largest source, so that no sum of powers vanishes
    log_share = F.log(F.col("tokens") / F.lit(largest))

    def measure(exponents: list[float]) -> list[tuple[float, bool, bool]]:
        """Sum of powers, and whether entropy and repetition are within the target, in one pass."""
        sums = []
        for a in exponents:
            power = F.exp(a * log_share)
            sums += [F.sum(power), F.sum(power * log_share), F.max(power / F.col("tokens"))]
        row = totals.agg(*sums).first()
        out = []
        for k, a in enumerate(exponents):
            z, weighted, rate = row[3 * k : 3 * k + 3]
            entropy = math.log(z) - a * weighted / z
            out.append((z, entropy <= ceiling + 1e-12, rate / z * budget <= target.max_repeats * (1 + 1e-12)))
        return out

    def narrowed(low: float, high: float, right: Callable[[tuple], bool]) -> float:
        """The smallest exponent above ``low`` that is right, where ``high`` is and all above it are."""
        for _ in range(12):
            tried = [low + (high - low) * k / TRIED for k in range(TRIED + 1)]
            first = next((k for k, found in enumerate(measure(tried)) if right(found)), TRIED)
            low, high = tried[max(first - 1, 0)], tried[first]
            if first == 0 or high - low < 1e-12 * max(high, 1.0):
                break
        return high

    met = True
    if measure([1.0])[0][1]:
        exponent = narrowed(0.0, 1.0, lambda f: f[1] and f[2])
    else:
        grown = [2.0**k for k in range(1, MAX_DOUBLINGS + 1)]
        enough = next((a for a, f in zip(grown, measure(grown)) if f[1]), None)
        exponent = grown[-1] if enough is None else narrowed(enough / 2, enough, lambda f: f[1])
        met = enough is not None
        if not measure([exponent])[0][2]:
            # the last exponent that repeats no source too often
            exponent, met = narrowed(1.0, exponent, lambda f: not f[2]), False
            exponent = max(1.0, exponent * (1 - 1e-9))
        elif not met:
            exponent = 1.0
    z = measure([exponent])[0][0]
    return Temperature(exponent, z * (largest / whole) ** exponent, whole, budget, largest, met)


def weights(totals: DataFrame, target: Target) -> DataFrame:
    """``totals`` with weight, exponent, met, budget (tokens of the source in the result) and repeats."""
    found = find_exponent(totals, target)
    power = F.exp(found.exponent * F.log(F.col("tokens") / F.lit(found.largest)))
    z = totals.agg(F.sum(power)).first()[0] or 1.0
    return totals.withColumn("weight", power / F.lit(z)).withColumns(
        {
            "budget": F.floor(F.col("weight") * F.lit(found.budget)).cast("long"),
            "exponent": F.lit(found.exponent),
            "met": F.lit(found.met),
        }
    ).withColumn("repeats", F.col("budget") / F.col("tokens"))


def mix(
    docs: DataFrame,
    target: Target,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
) -> DataFrame:
    """The mixture in reading order: doc_id, source, tokens, pass, block, position (within the block).

    A document is taken where its place in the source's stream is before the end of the source's budget, so
    a source is over its budget by less than one document. Documents without words carry no tokens and
    are not placed. A null id or source is a value like any other; repeated rows are one document, rows that
    repeat an id with another text or source are documents of their own. Equal hashes are ordered by id. An
    empty table gives none. Only the named columns are read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.xxhash64(text_col).alias("text_hash"),
        count_tokens(F.col(text_col)).alias("tokens"),
    )
    rows = stored(rows.where("tokens > 0").distinct(), "mix-docs")
    totals = stored(source_totals(rows), "mix-sources")
    plan = weights(totals, target)
    n_blocks = max(1, math.ceil((plan.agg(F.sum("budget")).first()[0] or 0) / block_tokens))
    plan = plan.where("budget > 0").select(
        F.col("source").alias("_source"),
        F.col("tokens").alias("_all"),
        F.col("budget").alias("_budget"),
        F.ceil(F.col("budget") / F.col("tokens")).cast("int").alias("_passes"),
        F.ceil(F.col("docs") / SLOT_DOCS).cast("int").alias("_slots"),
    )
    streams = rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.col("_passes") - 1))
    )
    order = F.xxhash64(F.lit(seed), "pass", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_hash")
    # 31 bits of the hash, evenly over the slots
    streams = streams.withColumn("order", order).withColumn(
        "slot", F.floor(F.shiftrightunsigned("order", 33) * F.col("_slots") / F.lit(2.0**31)).cast("int")
    )
    by_slot = streams.groupBy("source", "pass", "slot").agg(F.sum("tokens").alias("_slot_tokens"))
    before = Window.partitionBy("source", "pass").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    by_slot = by_slot.select(
        F.col("source").alias("_s"),
        F.col("pass").alias("_p"),
        F.col("slot").alias("_k"),
        F.coalesce(F.sum("_slot_tokens").over(before), F.lit(0)).alias("_before"),
    )
    within = (
        Window.partitionBy("source", "pass", "slot")
        .orderBy(F.shiftrightunsigned("order", 33), "order", "doc_id", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = streams.withColumn("_within", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(
        by_slot,
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("pass") == F.col("_p")) & (F.col("slot") == F.col("_k")),
    )
    place = F.col("pass") * F.col("_all") + F.col("_before") + F.col("_within")
    placed = placed.withColumn("_place", place).where("_place < _budget")
    block = F.floor(F.col("_place") / F.col("_budget") * F.lit(n_blocks)).cast("long")
    placed = placed.withColumn("block", F.least(block, F.lit(n_blocks - 1)))
    shuffled = Window.partitionBy("block").orderBy(F.xxhash64("order", "source"), "source", "doc_id", "text_hash")
    return placed.withColumn("position", F.row_number().over(shuffled).cast("long") - 1).select(
        F.col("doc_id").alias(id_col), F.col("source").alias(source_col), "tokens", "pass", "block", "position", "text_hash"
    )
