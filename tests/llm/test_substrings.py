import hashlib
import random

import pytest

from propense.llm import queries, substrings


def brute(docs):
    """Per (id, text): bytes, removed bytes, runs and digest; ids that are null take no part."""
    first = {}
    for d, t in docs:
        if d is not None:
            b = (t or "").encode()
            for p in range(len(b) - 49):
                s = b[p : p + 50]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if d is not None:
            for p in range(len(b) - 49):
                if first[b[p : p + 50]] < d:
                    gone[p : p + 50] = b"\1" * 50
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in df.collect()), key=repr)


def hard():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdeé \n", k=rng.randrange(1, 9)))
    passages = ["".join(word() for _ in range(n)) for n in (3, 9, 10, 11, 12, 13, 20, 60, 400)]
    docs = [(k, "".join(word() for _ in range(rng.randrange(30))) + rng.choice(passages) + rng.choice(passages)[3:] + word()) for k in range(120)]
    docs += [(200, "a" * 500), (201, "a" * 60), (202, "ab" * 100), (203, None), (204, ""), (205, "é" * 40), (206, "x" * 49)]
    docs += [(207, "é" * 25 + "y"), (-5, passages[8]), (208, passages[8]), (209, passages[8]), (None, passages[8]), (208, passages[8])]
    docs += [(210, passages[7]), (210, passages[7] + passages[8]), (211, "q" * 50), (212, "q" * 50)]
    return docs


@pytest.mark.parametrize("small", [False, True])
def test_hard_texts(spark, monkeypatch, small):
    if small:  # steps of a task; the functions run in tasks only by value of these, so shrink the driver's part
        monkeypatch.setattr(substrings, "BUCKET_BYTES", 64)
    docs = spark.createDataFrame(hard(), "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS copy", "3 AS names")
    found = substrings.deduplicate(docs.repartition(7))
    assert rows_of(found) == brute(hard())
    assert substrings.deduplicate(docs.limit(0)).count() == 0


def test_long_texts_in_pieces(monkeypatch):
    import numpy as np

    data = np.frombuffer(random.Random(1).randbytes(3000), np.uint8)
    whole = substrings._runs(data)
    monkeypatch.setattr(substrings, "PIECE", 100)
    pieces = substrings._runs(data)
    spread = lambda r: np.repeat(r[2], r[1]).tolist()
    assert spread(whole) == spread(pieces)


def test_spans_cover_what_is_removed(spark):
    docs = spark.createDataFrame([(1, "x" * 60 + "tail"), (2, "head " + "x" * 60 + " end")], "doc_id long, text string")
    rows = {r.doc_id: r for r in substrings.deduplicate(docs).collect()}
    assert rows[1].spans == [] and rows[2].spans == [[5, 65]]


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(queries.op9_substring_dedup(spark, sf_dir)) == brute(docs)
