"""The manifest against trees built plainly in memory, of many shapes."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from propense.llm import manifest, queries
from tests.oracle import connect, differences

FIELDS = ("doc_id", "source", "text")


def digest(*values):
    text = "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
    return hashlib.sha256(text.encode()).hexdigest()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes, width):
    """All levels, from the nodes to the root."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[k : k + width])) for k in range(0, len(row), width)])
    return levels


def siblings(levels, place, width):
    """(left, right) on each level of the way up."""
    out = []
    for row in levels[:-1]:
        start = place // width * width
        out.append(("".join(row[start:place]), "".join(row[place + 1 : start + width])))
        place //= width
    return out


def brute(rows, changed, width=16):
    """rows: (id, source, text); changed: id, text -> other text or the same object for none."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        leaves = sorted(((r[0] is not None, r[0] or 0, digest(*r), r) for r in by_source[s]), key=lambda x: x[:3])
        trees[s] = leaves, tree([x[2] for x in leaves], width)
    top = tree([trees[s][1][-1][0] for s in order], width)
    root = top[-1][0] if order else None
    out = []
    for k, s in enumerate(order):
        leaves, levels = trees[s]
        for place, (_, _, leaf, row) in enumerate(leaves):
            way = siblings(levels, place, width) + siblings(top, k, width)
            other = changed(row)
            node, path = digest(*other) if other else leaf, []
            for left, right in way:
                node = sha(left + node + right)
                path.append(node)
            proof = sha("".join(a + b for a, b in way))
            out.append((row[0], s, leaf, levels[-1][0], root, proof, tuple(path) if other else (), node if other else root))
    return sorted(out, key=repr)


def found(df):
    columns = "doc_id source leaf subroot root proof_sha256 copied folded_root".split()
    return sorted((tuple(tuple(v) if isinstance(v, list) else v for v in (r[c] for c in columns)) for r in df.collect()), key=repr)


def lower_third(row):
    return (row[0], row[1], row[2].lower() if row[2] is not None else None) if row[0] is not None and row[0] % 3 == 0 else None


def check(spark, rows, width=16):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs = docs.selectExpr("*", "1 AS name", "2 AS id", "3 AS place", "4 AS leaf", "5 AS tie").repartition(6)
    got = manifest.versions(docs, FIELDS, tampered=F.col("doc_id") % 3 == 0, changes={"text": F.lower("text")})
    want = brute(rows, lower_third, width)
    assert found(got) == want
    for r in got.select("verified", "folded_root", "root").collect():
        assert r.verified == (r.folded_root == r.root)
    return want


def test_groups_of_many_sizes(spark):
    """Sizes around every border of runs, lone groups, a null group, and names whose order is by bytes."""
    sizes = {None: 3, "": 1, "a": 15, "B": 16, "é": 17, "z": 33, "\U0001f600": 256, "￿": 257, "ab": 1, "a-": 300}
    rows, k = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            k += 7
            rows.append((k % 1009 - 500, s, f"Text {k} É"))
    rows += [(2000 + k, f"s{k:03d}", f"T{k}") for k in range(40)]
    check(spark, rows)


@pytest.mark.parametrize("n", [1, 9, 64, 65, 520])
def test_tiers(spark, monkeypatch, n):
    """Small blocks make trees of several tiers, also for the groups' roots."""
    monkeypatch.setattr(manifest, "WIDTH", 2)
    monkeypatch.setattr(manifest, "BLOCK", 8)
    rows = [(k, "hot", f"Leaf {k}") for k in range(n)] + [(k, f"s{k}", "X") for k in range(n % 71)]
    check(spark, rows, width=2)


def test_nulls_ties_and_repeats(spark):
    rows = [(None, None, None), (None, None, None), (1, None, None), (1, "a", "X"), (1, "a", "X"), (1, "a", "Y"), (None, "a", ""), (3, "a", None)]
    rows += [(3, "b", "Same")] * 40 + [(6, "b", "y" * 1_000_000 + "Z")]
    check(spark, rows)


def test_versions_share_what_is_not_copied(spark):
    """A version is the original but for one path, and a changed text shows in its root."""
    rows = [(k, f"s{k % 3}", f"Doc {k}") for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = manifest.versions(docs, FIELDS, tampered=F.col("doc_id") == 33, changes={"text": F.lit("tampered")}).collect()
    assert [r.doc_id for r in got if not r.verified] == [33]
    (r,) = [r for r in got if r.copied]
    # 30 leaves: two levels in the source, one above it
    assert len(r.copied) == 3 and r.copied[-1] == r.folded_root != r.root
    untouched = [r for r in manifest.versions(docs, FIELDS).collect()]
    assert all(r.verified and not r.copied for r in untouched)
    # digests keep their field apart from others
    one = manifest.versions(spark.createDataFrame([(1, "a", "1:b")], docs.schema), FIELDS).first()
    assert one.leaf == one.subroot == one.root == digest(1, "a", "1:b") and one.proof_sha256 == sha("")


def test_empty_tables(spark):
    assert manifest.versions(spark.createDataFrame([], "doc_id long, source string, text string"), FIELDS).collect() == []


def test_query(spark, sf_dir):
    name = "op11_merkle_manifest"
    got = queries.QUERIES[name](spark, sf_dir)
    assert differences(got, connect(sf_dir), queries.ORACLE_SQL[name]) == []
    assert got.where("NOT verified").count() > 0


@pytest.mark.parametrize("upper", [[], [sha("u")]])
def test_unchanged_leaves_are_folded_from_their_siblings(upper):
    leaves = [sha(str(k)) for k in range(20)]
    changed = [sha("new") if k == 3 else None for k in range(20)]
    group = pa.table(
        {
            "id": list(range(20)), "name": ["=a"] * 20, "leaf": leaves, "changed": pa.array(changed, pa.string()),
            "place": list(range(20)), "total": [20] * 20,
        }
    )
    above = pa.table({"left": pa.array([[""] * len(upper)], pa.list_(pa.string())), "right": [upper], "subroot": ["s"]})
    top = tree(leaves, 16)[-1][0]
    for sibling in upper:
        top = sha(top + sibling)
    # the root that is handed in is a wrong one: no row may take it over
    rows = manifest.followed(group, above, sha("wrong")).to_pylist()
    assert [r["folded_root"] == top for r in rows] == [k != 3 for k in range(20)]
    assert all(r["folded_root"] != r["root"] for r in rows)
    assert [len(r["copied"]) for r in rows] == [2 + len(upper) if k == 3 else 0 for k in range(20)]
