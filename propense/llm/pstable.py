"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors of length one with cosine c lie sqrt(2 - 2c) apart. Every table projects them on ``PROJECTIONS``
Gaussian directions, shifts and quantises the projections with width ``WIDTH`` times the distance of the
threshold, and the cells together are the bucket. At the threshold itself (cosine 0.95) a projection
agrees with probability 0.90, a table with 0.053, and one of 160 tables at least with 0.9998; at 0.97 a
pair is missed once in ten million. Pairs of one bucket are compared by their exact cosine.

Equal vectors are one class from the start. A pair that several tables bring together counts in the
first of them alone, so links are counted inside the tasks and pairs are never written out: a bucket gives
each vector's number of partners and a spanning tree of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propense.llm.common import (
    BLOCK_ROWS,
    components,
    group_bounds,
    in_blocks,
    spanning,
    stored,
    whole_groups,
)

THRESHOLD = 0.95
TABLES, PROJECTIONS, WIDTH = 160, 28, 8.0
SEED = 20


def usable(vector: Column) -> Column:
    """Vectors with a direction: not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


#: What a task has drawn already, by length of the vectors and threshold.
_DRAWN: dict[tuple[int, float], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _projections(size: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if (size, threshold) in _DRAWN:
        return _DRAWN[size, threshold]
    rng = np.random.default_rng([SEED, size])
    width = WIDTH * np.sqrt(2 - 2 * threshold)
    directions = rng.standard_normal((size, TABLES * PROJECTIONS)) / width
    shifts = rng.random(TABLES * PROJECTIONS)
    mix = rng.integers(1, 2**62, PROJECTIONS, dtype=np.int64) | 1
    _DRAWN[size, threshold] = directions, shifts, mix
    return directions, shifts, mix


def keys(units: np.ndarray, threshold: float, tables: int = TABLES) -> np.ndarray:
    """Bucket of each row in each of the first tables."""
    directions, shifts, mix = _projections(units.shape[1], threshold)
    n = tables * PROJECTIONS
    cells = np.floor(units @ directions[:, :n] + shifts[:n]).astype(np.int64)
    return (cells.reshape(len(units), tables, PROJECTIONS) * mix).sum(axis=2)


def _buckets(units: np.ndarray, threshold: float) -> np.ndarray:
    """Keys that also differ by table and by the length of the vectors."""
    table = np.arange(1, TABLES + 1, dtype=np.int64) * np.int64(0x1E3779B97F4A7C15)
    return keys(units, threshold) * np.int64(0x2545F4914F6CDD1D) + table + units.shape[1]


def _compare(units: np.ndarray, side: np.ndarray, across: bool, table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within the threshold that no earlier table has brought together."""
    first, second = [], []
    for k in range(0, len(units), 512):
        near = units[k : k + 512] @ units.T >= threshold
        i, j = np.nonzero(near)
        i += k
        keep = i < j
        if across:
            keep &= side[i] != side[j]
        first.append(i[keep])
        second.append(j[keep])
    i, j = np.concatenate(first), np.concatenate(second)
    if table and len(i):
        rows, flat = np.unique(np.concatenate([i, j]), return_inverse=True)
        before = keys(units[rows], threshold, table)
        a, b = flat[: len(i)], flat[len(i) :]
        new = np.arange(len(i))
        for t in range(table):
            new = new[before[a[new], t] != before[b[new], t]]
            if not len(new):
                break
        i, j = i[new], j[new]
    return i, j


def links(classes: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(node, links, root): parts of the number of linked vectors of each class, and links that span all.

    ``classes`` has node, vec and copies. The parts of a node add up; ``root`` is null in rows that only
    carry a number.
    """

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["vec"].map(len).to_numpy()
            for size in np.unique(lengths):
                same = batch[lengths == size]
                for k in range(0, len(same), 1000):
                    part = same.iloc[k : k + 1000]
                    found = _buckets(unit(np.stack(part["vec"]).astype(np.float64)), threshold)
                    yield pd.DataFrame(
                        {
                            "bucket": found.ravel(),
                            "place": np.tile(np.arange(TABLES, dtype=np.int32), len(part)),
                            "node": np.repeat(part["node"].to_numpy(), TABLES),
                        }
                    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = ["bucket", "block_i", "block_j"]
        for frame in whole_groups(batches, group):
            bounds = group_bounds(frame, group)
            nodes, copies = frame["node"].to_numpy(), frame["copies"].to_numpy()
            side, place = frame["side"].to_numpy(), frame["place"].to_numpy()
            across = (frame["block_i"] != frame["block_j"]).to_numpy()
            vectors = frame["vec"]
            out = []
            for begin, end in zip(bounds[:-1], bounds[1:]):
                if len({len(v) for v in vectors.iloc[begin:end]}) > 1:
                    continue  # vectors of different length have no cosine; such a bucket is a clash of hashes
                units = unit(np.stack(vectors.iloc[begin:end]).astype(np.float64))
                i, j = _compare(units, side[begin:end], across[begin], int(place[begin]), threshold)
                if not len(i):
                    continue
                own, weight = nodes[begin:end], copies[begin:end]
                number = np.zeros(len(own), dtype=np.int64)
                np.add.at(number, i, weight[j])
                np.add.at(number, j, weight[i])
                some = np.flatnonzero(number)
                out.append(pd.DataFrame({"node": own[some], "links": number[some], "root": None}))
                a, b = spanning(own[i], own[j])
                out.append(pd.DataFrame({"node": a, "links": 0, "root": b}))
            if out:
                yield pd.concat(out, ignore_index=True).astype({"root": "Int64"})

    replicas = classes.select("node", "vec").mapInPandas(replicate, "bucket long, place int, node long")
    sizes = replicas.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    met = replicas.join(sizes, "bucket").join(classes, "node")
    dealt = in_blocks(met, "bucket", "size", F.col("node"), block_rows)
    return dealt.mapInPandas(compare, "node long, links long, root long")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """A row per distinct (id, vector): id, n_links, component_id and kept (id = component_id).

    Null and empty vectors, zero vectors and vectors with null or non-finite components link with nothing,
    nor do vectors of different length. A null id has its links and its component's smallest id; it is
    not kept unless it stands alone, when its component is null as well. Repeated rows are one row.
    Only the two named columns are read, so others cannot clash. An empty table gives none.
    """
    # adding zero makes -0.0 and 0.0 one value
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda x: x + x * 0).alias("vec"))
    rows = rows.distinct().withColumn("node", F.when(usable(F.col("vec")), F.xxhash64("vec")))
    valid = rows.where(F.col("node").isNotNull())
    classes = valid.groupBy("node", "vec").agg(F.count("*").alias("copies"), F.min("id").alias("first_id"))
    classes = stored(classes, "vector-classes")
    found = stored(links(classes.select("node", "vec", "copies"), threshold), "vector-links")
    numbers = found.groupBy("node").agg(F.sum("links").alias("others"))
    edges = found.where(F.col("root").isNotNull()).select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(edges, "vector-components")
    firsts = classes.select("node", "copies", "first_id")
    linked = firsts.join(roots, "node").select("node", "root", "first_id")
    lowest = linked.groupBy("root").agg(F.min("first_id").alias("lowest"))
    named = linked.join(lowest, "root").select("node", "lowest")
    known = (
        firsts.join(numbers, "node", "left")
        .join(named, "node", "left")
        .select(
            "node",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"),
            F.coalesce("lowest", "first_id").alias("component"),
        )
    )
    out = rows.select("id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
