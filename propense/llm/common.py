"""Helpers shared by the operators: stored intermediate tables, whole groups in tasks, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propense.session import scratch_path

#: Rows of one bucket that are compared in one task; larger buckets are compared block by block.
BLOCK_ROWS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read again: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames made of whole runs of equal keys, from batches sorted by them."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        changed = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy()
        changed[0] = bool(rest) and bool((batch[keys].iloc[0] != rest[-1][keys].iloc[-1]).any())
        starts = np.flatnonzero(changed)
        if len(starts):
            done = [*rest, batch.iloc[: starts[-1]]]
            yield pd.concat(done, ignore_index=True)
            rest = [batch.iloc[starts[-1] :]]
        else:
            rest.append(batch)
    if rest:
        yield pd.concat(rest, ignore_index=True)


def group_bounds(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where runs of equal keys begin in ``frame``, and its length."""
    changed = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
    changed[0] = True
    return np.append(np.flatnonzero(changed), len(frame))


def in_blocks(rows: DataFrame, bucket: str, size: str, item: Column, block_rows: int) -> DataFrame:
    """Deal each bucket's rows to tasks (bucket, block_i, block_j) so that any two rows meet in one.

    Adds ``side`` (the row's own block), ``block_i`` and ``block_j``. A bucket of n rows has
    k = ceil(n / block_rows) blocks and each of its rows goes to k tasks; ordinary buckets have one.
    """
    blocks = F.ceil(F.col(size) / F.lit(block_rows)).cast("int")
    return (
        rows.withColumn("_k", blocks)
        .withColumn("side", F.pmod(F.xxhash64(item), F.col("_k")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("block_i", F.least("side", "_other"))
        .withColumn("block_j", F.greatest("side", "_other"))
        .drop("_k", "_other", size)
        .repartition(bucket, "block_i", "block_j")
        .sortWithinPartitions(bucket, "block_i", "block_j", "side")
    )


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) of the graph with edges ``a``-``b``."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) with root the smallest node of the component, for every node of ``edges`` (a, b).

    Alternates large-star and small-star steps until nothing moves. The number of steps grows with the
    logarithm of the longest chain; every step ends in a table in the shared folder, so a lost executor
    costs one step at most.
    """
    ordered = lambda df: df.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a <> b")
    now = stored(ordered(edges).distinct(), name)
    state = None
    while True:
        both = now.union(now.select("b", "a")).toDF("a", "b")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = ordered(large).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            low.select("a", F.col("low").alias("b"))
        )
        now = stored(ordered(small).distinct(), name)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    # a is never a root here: every edge leads from a node to the smallest one of its component
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )
