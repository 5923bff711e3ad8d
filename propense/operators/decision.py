"""Expected revenue per product and the best offer per customer."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propense.functions.columns import rounded

THRESHOLD = 0.71


def combine_scores(tables: Mapping[str, tuple[DataFrame, DataFrame]], key: str) -> DataFrame:
    """Join the two score tables of every product; only customers scored by all remain.

    Scores are cast to double here, so that the threshold below means the same for float input.
    """
    parts = []
    for product, (propensity, revenue) in tables.items():
        for table, column in ((propensity, "predicted_probability"), (revenue, "predicted_revenue")):
            parts.append(
                table.select(key, F.col(column).cast("double").alias(f"{product}_{column}"))
            )
    return reduce(lambda left, right: left.join(right, key), parts)


def gated(probability: Column, revenue: Column, threshold: Column | float) -> Column:
    """probability x revenue, or 0 for a probability below the threshold."""
    return F.when(probability < threshold, F.lit(0.0)).otherwise(probability * revenue)


def expected_revenue(
    scores: DataFrame, products: Sequence[str], threshold: Column | float = THRESHOLD
) -> DataFrame:
    """Adds ``<product>_expected_revenue`` behind each product's two score columns."""
    columns = {c: F.col(c) for c in scores.columns if not c.endswith(("_probability", "_revenue"))}
    for p in products:
        probability, revenue = f"{p}_predicted_probability", f"{p}_predicted_revenue"
        columns[probability] = F.col(probability)
        columns[revenue] = F.col(revenue)
        columns[f"{p}_expected_revenue"] = gated(F.col(probability), F.col(revenue), threshold)
    return scores.select(*[c.alias(name) for name, c in columns.items()])


def best_product(combined: DataFrame, products: Sequence[str]) -> DataFrame:
    """Highest expected revenue and its product; on equal value the earlier product wins."""
    values = [F.col(f"{p}_expected_revenue") for p in products]
    best = F.greatest(*values) if len(values) > 1 else values[0]
    choice = F.lit(products[-1].upper())
    for p, value in list(zip(products, values))[-2::-1]:
        choice = F.when(best == value, F.lit(p.upper())).otherwise(choice)
    others = [c for c in combined.columns if not c.endswith(("_probability", "_revenue"))]
    return combined.select(
        *others, best.alias("max_expected_revenue"), choice.alias("best_product_type")
    )


def product_mix(outcome: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Customers per best product, with the percentage of all customers (within ``by``)."""
    counts = outcome.groupBy(*by, "best_product_type").agg(F.count(F.lit(1)).alias("count"))
    # The window sees one row per product only.
    total = F.sum("count").over(Window.partitionBy(*by))
    return counts.withColumn("percentage", rounded(F.col("count") * 100.0 / total, 2))


def outcome_totals(outcome: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    value = F.col("max_expected_revenue")
    named = {"avg": F.avg, "min": F.min, "max": F.max, "total": F.sum}
    return outcome.groupBy(*by).agg(
        *[rounded(fn(value), 2).alias(f"{name}_expected_revenue") for name, fn in named.items()]
    )


def positive_offers(outcome: DataFrame, key: str) -> DataFrame:
    """All offers worth something, best first; the key settles ties."""
    return outcome.where(F.col("max_expected_revenue") > 0).orderBy(
        F.desc("max_expected_revenue"), key
    )


def top_offers(outcome: DataFrame, key: str, k: int = 100) -> DataFrame:
    """The k best offers: each task keeps its own k, so nothing is sorted as a whole."""
    return positive_offers(outcome, key).limit(k)


def top_offer_details(combined: DataFrame, outcome: DataFrame, key: str, k: int = 100) -> DataFrame:
    """All score columns of the k best offers. The k keys are a fixed small side."""
    keys = top_offers(outcome, key, k).select(key)
    return combined.join(F.broadcast(keys), key, "left_semi")


def threshold_sweep(scores: DataFrame, products: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    """Totals and number of positive offers for any number of thresholds, in one pass over the scores.

    A customer's best product changes only where the threshold passes one of the customer's probabilities,
    so a customer is one step more than there are products at most. A step counts from its first
    threshold up to its last; the sums at a threshold are those of all steps that have begun less those
    that have ended. Scores are finite or NULL; a threshold given twice is one row.
    """
    levels = sorted({float(t) for t in thresholds})
    if not levels or not all(map(math.isfinite, levels)):
        raise ValueError(f"thresholds must be finite numbers: {list(thresholds)}")
    passed = {p: f"_passed_{p}" for p in products}
    # how many thresholds a probability reaches, by binary search; NULL and NaN reach all, as no test fails
    splits = [float("-inf"), *levels, float("inf")]
    places = Bucketizer(
        splitsArray=[splits] * len(products),
        inputCols=[f"{p}_predicted_probability" for p in products],
        outputCols=list(passed.values()),
        handleInvalid="keep",
    )
    steps = places.transform(scores)
    reached = [F.least(F.col(c).cast("int"), F.lit(len(levels))) for c in passed.values()]
    # step k begins behind the k-th smallest of those numbers and ends with the next
    ends = F.concat(F.array(F.lit(0)), F.array_sort(F.array(*reached)), F.array(F.lit(len(levels))))
    steps = steps.withColumn("_ends", ends).withColumn(
        "_step", F.explode(F.arrays_zip(F.slice("_ends", 1, len(products) + 1).alias("low"), F.slice("_ends", 2, len(products) + 1).alias("last")))
    )
    first, last = F.col("_step.low") + 1, F.col("_step.last")
    steps = steps.where(first <= last).select(first.alias("_first"), last.alias("_last"), *_gated_by_place(products, passed, len(levels)))
    outcome = best_product(steps, products)
    value, sign = F.col("max_expected_revenue"), F.col("_at.sign")
    turns = F.array(
        F.struct(F.col("_first").alias("place"), F.lit(1).alias("sign")),
        F.struct((F.col("_last") + 1).alias("place"), F.lit(-1).alias("sign")),
    )
    sums = {
        "customers": F.sum(sign),
        "positive_offers": F.sum(F.when(value > 0, sign).otherwise(0)),
        "total": F.sum(value * sign),
        "valued": F.sum(F.when(value.isNotNull(), sign).otherwise(0)),
        **{f"best_{p}": F.sum(F.when(F.col("best_product_type") == p.upper(), sign).otherwise(0)) for p in products},
    }
    changes = (
        outcome.withColumn("_at", F.explode(turns)).groupBy(F.col("_at.place").alias("place")).agg(*[s.alias(n) for n, s in sums.items()])
    )
    # a row per threshold
    rows = scores.sparkSession.createDataFrame(list(enumerate(levels, 1)), "place int, threshold double")
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    known = rows.join(changes, "place", "left").select(
        "place", "threshold", *[F.coalesce(n, F.lit(0)).alias(n) for n in sums]
    )
    at = known.select("threshold", *[F.sum(n).over(upto).alias(n) for n in sums]).where("customers > 0")
    return at.select(
        "threshold",
        "customers",
        "positive_offers",
        rounded(F.when(F.col("valued") > 0, F.col("total")), 2).alias("total_expected_revenue"),
        *[f"best_{p}" for p in products],
    )


def _gated_by_place(products: Sequence[str], passed: Mapping[str, str], most: int) -> list[Column]:
    """Expected revenue within a step: that of the products whose probability reaches its first threshold."""
    out = []
    for p in products:
        probability, revenue = F.col(f"{p}_predicted_probability"), F.col(f"{p}_predicted_revenue")
        below = F.least(F.col(passed[p]).cast("int"), F.lit(most)) <= F.col("_step.low")
        out.append(F.when(below, F.lit(0.0)).otherwise(probability * revenue).alias(f"{p}_expected_revenue"))
    return out
