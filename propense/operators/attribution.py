"""Additive feature attribution of boosted-tree models against a background sample.

For a row x and a background row z, a feature may take its value from either. The contribution of a
feature is its Shapley value over those choices, averaged over the background; the contributions of a
row plus the mean margin of the background give the margin of the row. In a tree this has a closed form
per leaf (the interventional variant of the published tree method): of the features on the path to the
leaf, ``a`` must come from x and ``b`` from z, and the leaf's value is shared out by a and b alone.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propense.functions.columns import ident
from propense.operators import features as prep

# Rows explained unless the caller asks for a sample: all of them.
SAMPLE_SIZE = None
BACKGROUND_SIZE = 100
# Rows explained at a time within a task, and numbers held for the leaves at work.
CHUNK = 1024
WORK = 1 << 20

# The helpers below travel to the tasks with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SPLIT = re.compile(r"(If|Else) \(feature (\d+) (<=|>|in|not in) ([^)]+)\)")
# Entries of categories are 0 or 1 and are split by sets.
_ONE_SIDE = {"{0.0}": True, "{1.0}": False}
_LEAF = re.compile(r"Predict: (\S+)")


@dataclass(frozen=True)
class Leaf:
    """A leaf holds where every feature on its path lies in its interval: low < x <= high."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray


def leaves_of(ensemble) -> list[Leaf]:
    """All leaves of a fitted ensemble, their values times the weight of their tree."""
    out: list[Leaf] = []
    for tree, weight in zip(ensemble.trees, ensemble.treeWeights):
        path: list[tuple[int, float, float]] = []
        for line in tree.toDebugString.splitlines()[1:]:
            depth = len(line) - len(line.lstrip()) - 2  # a tree's text is indented by its depth
            split, leaf = _SPLIT.search(line), _LEAF.search(line)
            if split:
                _, j, side, at = split.groups()
                if at in _ONE_SIDE:
                    low, at = _ONE_SIDE[at] == (side == "in"), 0.5
                else:
                    low = side == "<="
                bound = (-np.inf, float(at)) if low else (float(at), np.inf)
                path[depth:] = [(int(j), *bound)]
            elif leaf:
                out.append(_leaf(float(leaf.group(1)) * weight, path[:depth]))
            elif line.strip():
                raise ValueError(f"unexpected line in a tree: {line.strip()}")
    return out


def leaf_values(ensemble) -> list[list[float]]:
    """Values of each tree's leaves, in the order in which the learner numbers them, times the tree's weight."""
    return [
        [float(value) * weight for value in _LEAF.findall(tree.toDebugString)]
        for tree, weight in zip(ensemble.trees, ensemble.treeWeights)
    ]


def _leaf(value: float, path: Sequence[tuple[int, float, float]]) -> Leaf:
    bounds: dict[int, tuple[float, float]] = {}
    for j, low, high in path:
        old = bounds.get(j, (-np.inf, np.inf))
        bounds[j] = (max(old[0], low), min(old[1], high))
    names = np.array(list(bounds), dtype=int)
    low, high = (np.array([b[i] for b in bounds.values()]) for i in (0, 1))
    return Leaf(value, names, low, high)


def _holds(leaf: Leaf, rows: np.ndarray) -> np.ndarray:
    """Which of the leaf's intervals each row is in."""
    x = rows[:, leaf.features]
    return (x > leaf.low) & (x <= leaf.high)


def _shares(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Part of a leaf's value for one of the a features of x, and for one of the b of z."""
    own, other = np.zeros((most + 1, most + 1)), np.zeros((most + 1, most + 1))
    for a in range(most + 1):
        for b in range(most + 1 - a):
            whole = factorial(a + b)
            if a:
                own[a, b] = factorial(a - 1) * factorial(b) / whole
            if b:
                other[a, b] = -factorial(a) * factorial(b - 1) / whole
    return own, other


@dataclass(frozen=True)
class Stack:
    """Leaves with the same number of features, as arrays over the leaves."""

    value: np.ndarray
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """Per row and leaf a number whose bits say which of the leaf's intervals hold."""
        out = np.zeros((len(rows), len(self.value)), dtype=np.int64)
        for j in range(self.features.shape[1]):
            x = rows[:, self.features[:, j]]
            out |= ((x > self.low[:, j]) & (x <= self.high[:, j])).astype(np.int64) << j
        return out


def stacked(leaves: Sequence[Leaf]) -> list[Stack]:
    by_size: dict[int, list[Leaf]] = {}
    for leaf in leaves:
        if len(leaf.features):
            by_size.setdefault(len(leaf.features), []).append(leaf)
    return [
        Stack(
            np.array([leaf.value for leaf in same]),
            *(np.stack([getattr(leaf, name) for leaf in same]) for name in ("features", "low", "high")),
        )
        for _, same in sorted(by_size.items())
    ]


def contributions(stacks: Sequence[Stack], background: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Contribution of every feature in every row, as (rows, features).

    What a leaf gives a row depends on two bit patterns alone, the row's and a background row's. Leaves
    are worked off in stacks: the patterns of the background that occur are counted, and each occurring
    pattern of a row is matched with those once, for all rows that have it.
    """
    total = np.zeros((rows.shape[1], len(rows)))
    for stack in stacks:
        size = stack.features.shape[1]
        own, other = _shares(size)
        full = (1 << size) - 1
        bits = np.arange(size)
        # The work space is leaves x background x features at a time.
        step = max(1, WORK // (len(background) * size))
        for at in range(0, len(stack.value), step):
            part = Stack(*(x[at : at + step] for x in (stack.value, stack.features, stack.low, stack.high)))
            theirs = part.codes(background)
            n = len(part.value)
            # every pattern of a row that occurs at a leaf, once
            keys, place = np.unique(part.codes(rows) * n + np.arange(n), return_inverse=True)
            shares = np.zeros((len(keys), size))
            for k in range(0, len(keys), step):
                mine, leaf = np.divmod(keys[k : k + step], n)
                z = theirs[:, leaf].T
                from_row, from_background = mine[:, None] & ~z, ~mine[:, None] & z & full
                reachable = (mine[:, None] | z) == full
                a, b = np.bitwise_count(from_row), np.bitwise_count(from_background)
                weight = part.value[leaf][:, None] * reachable / len(background)
                give, take = weight * own[a, b], weight * other[a, b]
                for j in bits:
                    shares[k : k + step, j] = (give * (from_row >> j & 1) + take * (from_background >> j & 1)).sum(axis=1)
            place = place.reshape(len(rows), n)
            for j in bits:
                np.add.at(total, part.features[:, j], shares[place, j].T)
    return total.T


def margin(leaves: Sequence[Leaf], rows: np.ndarray) -> np.ndarray:
    """The raw sum of the ensemble: what the contributions add up to."""
    out = np.zeros(len(rows))
    for leaf in leaves:
        out += leaf.value * _holds(leaf, rows).all(axis=1)
    return out


def stack_margin(stacks: Sequence[Stack], constant: float, rows: np.ndarray) -> np.ndarray:
    """The same, from stacks; ``constant`` is the value of leaves without a condition."""
    out = np.full(len(rows), constant)
    for stack in stacks:
        out += (stack.codes(rows) == (1 << stack.features.shape[1]) - 1) @ stack.value
    return out


def _used(leaves: Sequence[Leaf]) -> tuple[list[int], list[Leaf]]:
    """The features that any leaf asks for, and the leaves over places among those.

    There are at most as many as the trees have splits, however wide the vectors are.
    """
    used = sorted({int(j) for leaf in leaves for j in leaf.features}) or [0]
    place = {j: k for k, j in enumerate(used)}
    return used, [
        Leaf(leaf.value, np.array([place[int(j)] for j in leaf.features], dtype=int), leaf.low, leaf.high) for leaf in leaves
    ]


def _listed(values: Sequence, kind: str) -> Column:
    """An array that is one literal, not an expression per element."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def attribute(
    model: PipelineModel,
    train: DataFrame,
    rows: DataFrame,
    key: str,
    *,
    sample_size: int | None = SAMPLE_SIZE,
    background_size: int = BACKGROUND_SIZE,
    seed: int = 42,
    zeros: bool = True,
) -> DataFrame:
    """(instance, feature, value, contribution), one row per row and feature, with base and margin.

    Explains ``sample_size`` rows, or all for None, against at most ``background_size`` of ``train``.
    Leaves and background are of a bounded size and go to every task; the rows stay where they are.
    Vectors are cut down to the features that leaves use before they are worked on, so a predictor with very
    many categories costs no more than one with few. All others contribute 0: they are rows of the result as
    well, made at the end without Python, unless ``zeros`` is off.
    """
    vectorise = PipelineModel(model.stages[:-1])
    used, leaves = _used(leaves_of(model.stages[-1]))
    cut = VectorSlicer(inputCol="features", outputCol="_used", indices=used)
    as_arrays = lambda df: cut.transform(vectorise.transform(df)).select(
        ident(key).alias("instance_id"), "features", vector_to_array("_used").alias("x")
    )
    picked = as_arrays(prep.sample_rows(train, key, background_size, seed)).select("x").collect()
    if not picked:
        raise ValueError("no background rows")
    background = np.array([r["x"] for r in picked])
    base = float(margin(leaves, background).mean())
    # One copy per executor; plain arrays, so workers need no copy of this package to read them.
    sent = rows.sparkSession.sparkContext.broadcast(
        (
            [(k.value, k.features, k.low, k.high) for k in stacked(leaves)],
            float(sum(leaf.value for leaf in leaves if not len(leaf.features))),
            background,
        )
    )
    if sample_size is not None:
        # A top-n ends in one task; spread its few rows again, as they are costly to explain.
        spread = min(rows.sparkSession.sparkContext.defaultParallelism, max(sample_size // 32, 1))
        rows = prep.sample_rows(rows, key, sample_size, seed).repartition(spread, ident(key))

    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        arrays, constant, background = sent.value
        stacks = [Stack(*a) for a in arrays]
        for batch in batches:
            phi, margins = [], []
            for k in range(0, len(batch), CHUNK):
                x = np.stack(batch.iloc[k : k + CHUNK].to_numpy())
                phi += list(contributions(stacks, background, x))
                margins += list(stack_margin(stacks, constant, x))
            yield pd.DataFrame({"phi": phi, "margin": margins})

    # annotations that are text cannot be resolved in a task's copy of the function
    explain.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    explained = F.pandas_udf(explain, "phi array<double>, margin double")
    found = as_arrays(rows).withColumn("e", explained("x"))
    names = prep.feature_names(model)
    if zeros:
        place = np.full(len(names), -1)
        place[used] = np.arange(len(used))
        phi = F.transform(_listed(place.tolist(), "int"), lambda k: F.when(k < 0, 0.0).otherwise(F.get("e.phi", k)))
        zipped = F.arrays_zip(_listed(names, "string").alias("name"), vector_to_array("features").alias("x"), phi.alias("phi"))
    else:
        some = _listed([names[j] for j in used], "string")
        zipped = F.arrays_zip(some.alias("name"), F.col("x"), F.col("e.phi").alias("phi"))
    return found.select("instance_id", F.col("e.margin").alias("margin"), F.inline(zipped).alias("name", "x", "phi")).select(
        "instance_id",
        F.col("name").alias("feature_name"),
        F.col("x").alias("feature_value"),
        F.col("phi").alias("contribution"),
        F.lit(base).alias("base_value"),
        "margin",
    )


def attribution_summary(detail: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, ranked over the few features."""
    means = detail.groupBy("feature_name").agg(
        F.avg(F.abs(F.col("contribution"))).alias("mean_abs_contribution")
    )
    order = Window.orderBy(F.desc("mean_abs_contribution"), "feature_name")
    return means.withColumn("feature_rank", F.row_number().over(order)).orderBy("feature_rank")
