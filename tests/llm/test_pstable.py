import numpy as np
import pytest

from propense.llm import pstable, queries


def brute(rows):
    """(id, n_links, component_id) of distinct rows by comparing all."""
    rows = list(dict.fromkeys((i, None if v is None else tuple(v)) for i, v in rows))
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = [[a == b for b in range(len(rows))] for a in range(len(rows))]
    units = [np.array(v, float) / np.max(np.abs(v)) if g else None for (_, v), g in zip(rows, good)]
    for a in range(len(rows)):
        for b in range(len(rows)):
            if good[a] and good[b] and len(units[a]) == len(units[b]):
                x, y = units[a], units[b]
                near[a][b] = bool(x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95 - 1e-15)
            elif a == b:
                near[a][b] = True
    big = 1 << 62
    label = [big if i is None else i for i, _ in rows]
    while True:
        new = [min(label[b] for b in range(len(rows)) if near[a][b]) for a in range(len(rows))]
        if new == label:
            break
        label = new
    return sorted(((i, sum(near[k]) - 1, None if c == big else c) for k, ((i, _), c) in enumerate(zip(rows, label))), key=repr)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=repr)


def hard():
    rng = np.random.default_rng(6)
    rows = []
    for k in range(25):
        v = rng.standard_normal(16)
        for c in range(4):
            # cosines from 1 down to about 0.97
            rows.append((10 * k + c, (v + rng.standard_normal(16) * 0.06 * c * np.linalg.norm(v) / 4).astype(np.float32).tolist()))
    v = rng.standard_normal(16).astype(np.float32).tolist()
    rows += [(500 + k, v) for k in range(40)] + [(600, [2 * x for x in v]), (601, [-x for x in v])]
    rows += [(700, None), (701, []), (702, [0.0] * 16), (703, [float("nan")] + v[1:]), (704, [float("inf")] + v[1:])]
    rows += [(705, [None] + v[1:]), (706, v[:8]), (707, [1e-30] * 16), (708, [1e30] * 16), (None, v), (500, v), (500, rows[0][1])]
    rows += [(800, [0.0] * 15 + [1.0]), (801, [-0.0] * 15 + [1.0])]
    return rows


@pytest.mark.parametrize("block_rows", [5, 2048])
def test_hard_vectors(spark, monkeypatch, block_rows):
    monkeypatch.setattr(pstable, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(pstable.links, "__defaults__", (pstable.THRESHOLD, block_rows))
    rows = hard()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS node", "2 AS id", "3 AS vec")
    got = pstable.near_duplicates(df)
    assert found(got) == brute(rows)
    assert pstable.near_duplicates(df.limit(0)).count() == 0
    for r in got.collect():
        assert r.kept == (r.vec_id == r.component_id)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    x = pstable.unit(rng.standard_normal((4000, 64)))
    other = rng.standard_normal((4000, 64))
    other -= (other * x).sum(axis=1, keepdims=True) * x
    y = 0.9501 * x + np.sqrt(1 - 0.9501**2) * pstable.unit(other)
    met = (pstable.keys(x, 0.95) == pstable.keys(y, 0.95)).any(axis=1)
    assert met.mean() > 0.999


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(queries.op3_embedding_near_dedup(spark, sf_dir)) == brute(rows)
