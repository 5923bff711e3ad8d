"""A Merkle manifest of a table as a persistent tree with path copying.

Every group (a source) has a tree over its leaves in order of id, every run of 16 nodes has one parent,
and the roots of the groups, in order of the groups, have a tree of their own. Aligned blocks of 16^3
nodes are built in one task each; the roots of blocks are the nodes of the next tier, which is dealt
to tasks in the same way, until a group is one block. On the way down every block gets the path from its
root to the top: the siblings to the left and to the right of each step.

A changed leaf makes a version of the tree: all nodes are shared with the original except the leaf's
ancestors, which are copied, first those inside its block, then those of the tiers above, along the path
the block was given. So versions never meet in the task of a top block, however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propense.llm.common import stored

#: Nodes with one parent, levels inside a block, and so the nodes of a block.
WIDTH, LEVELS = 16, 3
BLOCK = WIDTH**LEVELS
HEX = 64


def digest(*fields: Column) -> Column:
    """sha256 of fields: ``-`` for a null, else its bytes in UTF-8, a colon and the value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_inside(total: int) -> int:
    """Levels that a block builds for a group of ``total`` nodes: all of them, or as many as it has."""
    levels, covered = 0, 1
    while covered < total and levels < LEVELS:
        levels, covered = levels + 1, covered * WIDTH
    return levels


def build(nodes: Sequence[str], levels: int) -> list[list[str]]:
    """The text of every run of siblings, level by level from the leaves; the last one is the root's."""
    runs = []
    row = list(nodes)
    for _ in range(levels):
        texts = ["".join(row[k : k + WIDTH]) for k in range(0, len(row), WIDTH)]
        runs.append(texts)
        row = [_hash(t) for t in texts]
    runs.append(row)
    return runs


def around(runs: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """What lies left and right of the path from a node to the root of its block, level by level."""
    left, right = [], []
    for texts in runs[:-1]:
        run, k = texts[place // WIDTH], place % WIDTH
        left.append(run[: HEX * k])
        right.append(run[HEX * (k + 1) :])
        place //= WIDTH
    return left, right


def copied(node: str, left: Sequence[str], right: Sequence[str]) -> list[str]:
    """The ancestors of ``node`` made anew from the siblings on its way, root last; none for a lone node."""
    path = []
    for before, after in zip(left, right):
        node = _hash(before + node + after)
        path.append(node)
    return path


def _ordered(leaves: DataFrame) -> DataFrame:
    """Adds ``place``, the 0-based place of a leaf in its group by id, and ``total``, the group's leaves.

    Rows are dealt out by ranges of group, id and leaf and numbered where they lie; only the row counts of
    groups by task are summed. Equal rows are spread by ``tie``, their order makes no difference.
    """
    keys = ["name", "id", "leaf", "tie"]
    dealt = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = stored(dealt.withColumn("row", F.monotonically_increasing_id()), "manifest-order")
    dealt = dealt.withColumn("part", F.shiftright("row", 33))
    parts = dealt.groupBy("name", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy("name")
    parts = parts.select(
        "name",
        "part",
        (F.sum("n").over(within.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(within).alias("total"),
    )
    return dealt.join(parts, ["name", "part"]).select(
        "name", "id", "leaf", "changed", (F.col("row") + F.col("shift")).alias("place"), "total"
    )


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / BLOCK).cast("long"))


def _sorted(group: pa.Table) -> tuple[list[str], int]:
    return group.column("leaf").to_pylist(), levels_inside(group.column("total")[0].as_py())


def _tops(tier: DataFrame) -> DataFrame:
    """(name, place, total, leaf): the roots of blocks as nodes of the next tier."""

    def top(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        nodes, levels = _sorted(group)
        total = group.column("total")[0].as_py()
        return pa.table(
            {
                "name": group.column("name")[:1],
                "place": group.column("block")[:1],
                "total": pa.array([-(-total // BLOCK)], pa.int64()),
                "leaf": pa.array(build(nodes, levels)[-1], pa.string()),
            }
        )

    rows = _in_blocks(tier.select("name", "place", "total", "leaf"))
    return rows.groupBy("name", "block").applyInArrow(top, "name string, place long, total long, leaf string")


def _tiers(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of all groups' trees, from the leaves up, and (name, root) of every group.

    The number of tiers grows with the logarithm of the largest group, to base 4096.
    """
    tiers, roots = [leaves], []
    while True:
        tops = stored(_tops(tiers[-1]), "manifest-tier")
        roots.append(tops.where("total = 1").select("name", F.col("leaf").alias("root")))
        above = tops.where("total > 1")
        if above.isEmpty():
            break
        tiers.append(above)
    out = roots[0]
    for more in roots[1:]:
        out = out.union(more)
    return tiers, out


PATH = "left array<string>, right array<string>"


def _by_block(rows: DataFrame):
    """Grouped by block; under columns of its own, as two such groupings may come from one table."""
    return rows.toDF(*rows.columns).groupBy("name", "block")


def _expanded(tier: DataFrame, paths: DataFrame) -> DataFrame:
    """(name, block, left, right): the whole path of every node of a tier, a block of the one below."""

    def paths_of(group: pa.Table, above: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        nodes, levels = _sorted(group)
        runs = build(nodes, levels)
        left, right = above.column("left")[0].as_py(), above.column("right")[0].as_py()
        own = [around(runs, k) for k in range(len(nodes))]
        return pa.table(
            {
                "name": group.column("name"),
                "block": group.column("place"),
                "left": pa.array([a + left for a, _ in own], pa.list_(pa.string())),
                "right": pa.array([b + right for _, b in own], pa.list_(pa.string())),
            }
        )

    rows = _in_blocks(tier.select("name", "place", "total", "leaf"))
    return _by_block(rows).cogroup(_by_block(paths)).applyInArrow(paths_of, f"name string, block long, {PATH}")


def _block_paths(tiers: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths of the blocks of leaves, from ``paths`` of the groups' roots (name, left, right)."""
    found = None
    for k in range(len(tiers) - 1, -1, -1):
        # groups that are one block in this tier begin here with the path of their root
        heads = tiers[k].where(F.col("total") <= BLOCK).select("name").distinct()
        heads = paths.join(heads, "name", "left_semi").select("name", F.lit(0).cast("long").alias("block"), "left", "right")
        # ``found`` has the paths of this tier's blocks in larger groups
        here = heads if found is None else heads.unionByName(found)
        if k == 0:
            return here
        found = stored(_expanded(tiers[k], here), "manifest-paths")
    raise AssertionError("no tier")


def _top_paths(roots: DataFrame) -> tuple[DataFrame, str | None]:
    """(name, left, right) of every group's root in the tree of all, and that tree's root, if any."""
    nodes = roots.select(
        F.lit("").alias("name"), F.col("name").alias("id"), F.col("root").alias("leaf"),
        F.lit(None).cast("string").alias("changed"), F.lit(0).cast("long").alias("tie"),
    )
    ordered = stored(_ordered(nodes), "manifest-groups")
    tiers, root = _tiers(ordered)
    empty = F.array().cast("array<string>")
    top = root.select("name", empty.alias("left"), empty.alias("right"))
    paths = stored(_expanded(ordered, _block_paths(tiers, top)), "manifest-group-paths")
    named = ordered.select("place", F.col("id").alias("name"))
    paths = paths.select(F.col("block").alias("place"), "left", "right").join(named, "place").drop("place")
    first = root.first()
    return paths, first and first["root"]


def followed(group: pa.Table, above: pa.Table, root: str | None) -> pa.Table:
    """Every leaf of a block with its proof, folded with its siblings to the top: the changed leaf if there is one.

    An unchanged leaf is folded as well, and what comes out is not taken from the tree: a wrong sibling shows.
    """
    group = group.sort_by("place")
    nodes, levels = _sorted(group)
    runs = build(nodes, levels)
    upper_left, upper_right = above.column("left")[0].as_py(), above.column("right")[0].as_py()
    upper = "".join(a + b for a, b in zip(upper_left, upper_right))
    proofs, paths, folded = [], [], []
    for k, other in enumerate(group.column("changed").to_pylist()):
        left, right = around(runs, k)
        proofs.append(_hash("".join(a + b for a, b in zip(left, right)) + upper))
        leaf = nodes[k] if other is None else other
        path = copied(leaf, left + upper_left, right + upper_right)
        # nodes of an unchanged leaf are those of the original: none is copied
        paths.append([] if other is None else path)
        folded.append(path[-1] if path else leaf)
    size = len(nodes)
    return pa.table(
        {
            "id": group.column("id"),
            "name": group.column("name"),
            "leaf": group.column("leaf"),
            "subroot": pa.array([above.column("subroot")[0].as_py()] * size, pa.string()),
            "root": pa.array([root] * size, pa.string()),
            "proof_sha256": pa.array(proofs, pa.string()),
            "copied": pa.array(paths, pa.list_(pa.string())),
            "folded_root": pa.array(folded, pa.string()),
        }
    )


def versions(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group_col: str = "source",
    id_col: str = "doc_id",
    tampered: Column | None = None,
    changes: dict[str, Column] | None = None,
) -> DataFrame:
    """A row per row of ``docs``: id, group, leaf, subroot, root, proof_sha256, copied, folded_root, verified.

    Where ``tampered`` holds, the leaf is taken from the ``changes`` of columns instead: ``copied`` has the
    nodes of that version that the original does not share, from the leaf's parent to the root. Elsewhere nothing
    is copied. ``folded_root`` is computed for every row from its leaf, changed or not, and the original siblings.
    proof_sha256 is of all siblings on the way from the leaf over its group's root to the root.

    Null groups are one group, the first; null ids come first in theirs. Rows that repeat an id are leaves
    of their own, in order of their digests, equal rows included. An empty table gives none. Only ``fields``,
    group and id and what ``changes`` and ``tampered`` name are read, so other columns cannot clash.
    """
    plain = digest(*[F.col(c) for c in fields])
    changed = F.lit(None).cast("string")
    if tampered is not None:
        changed = F.when(tampered, digest(*[(changes or {}).get(c, F.col(c)) for c in fields]))
    # "" is the null group and sorts before all others, which keep their order by bytes
    name = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(
        name.alias("name"), F.col(id_col).alias("id"), plain.alias("leaf"), changed.alias("changed")
    ).withColumn("tie", F.monotonically_increasing_id())
    # the texts are read once, here
    ordered = stored(_ordered(stored(leaves, "manifest-leaves")), "manifest-leaves")
    tiers, roots = _tiers(ordered)
    paths, root = _top_paths(roots)
    blocks = _block_paths(tiers, paths).join(roots.withColumnRenamed("root", "subroot"), "name")

    def follow(group: pa.Table, above: pa.Table) -> pa.Table:
        return followed(group, above, root)

    kind = ordered.schema["id"].dataType.simpleString()
    columns = (
        f"id {kind}, name string, leaf string, subroot string, root string, proof_sha256 string, "
        "copied array<string>, folded_root string"
    )
    found = _by_block(_in_blocks(ordered)).cogroup(_by_block(blocks)).applyInArrow(follow, columns)
    return found.select(
        F.col("id").alias(id_col),
        F.when(F.col("name") != "", F.substring("name", 2, 1 << 30)).alias(group_col),
        "leaf", "subroot", "root", "proof_sha256", "copied", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
