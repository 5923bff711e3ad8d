import re

import numpy as np
import pytest
import xxhash

from propense.llm import queries, simhash

HARD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "One TWO three"), (7, "one two three"),
    (8, "word " * 5000), (9, "É one two three"), (10, "é one two three"), (10, "é one two three"), (None, "one two three"),
]


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def lowest_reachable(ids, near):
    label = list(ids)
    while True:
        new = [min(label[j] for j in range(len(ids)) if near[i][j]) for i in range(len(ids))]
        if new == label:
            return label
        label = new


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS id", "1 AS fp", "2 AS component_id")


def test_fingerprints_of_hard_texts(spark):
    found = {(r.doc_id, r.fp) for r in simhash.simhash_components(frame(spark, HARD)).collect()}
    want = {(d, int(np.uint64(plain_fingerprint(t)).view(np.int64))) for d, t in HARD}
    assert found == want


def test_a_piece_ends_between_words(monkeypatch):
    text = "alpha beta  gamma\ndelta " * 50
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_query_equals_brute_force(spark, sf_dir):
    found = {r.doc_id: r for r in queries.op10_simhash_near_dedup(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = np.array([plain_fingerprint(d.text) for d in docs], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    labels = lowest_reachable([d.doc_id for d in docs], near)
    assert len(found) == len(docs)
    for d, p, label in zip(docs, prints, labels):
        assert (found[d.doc_id].fingerprint, found[d.doc_id].component_id) == (f"{int(p):016x}", label)


@pytest.mark.parametrize("block_rows", [2, 2048])
def test_links_of_all_distances(spark, block_rows):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    prints = set(base.tolist())
    for x in base[:40].tolist():
        for flips in (1, 2, 3):
            prints.add(x ^ sum(1 << int(b) for b in rng.choice(64, flips, replace=False)))
    # a chain and a crowd around one fingerprint
    prints |= {sum(3 << 2 * k for k in range(n)) for n in range(12)} | {1 << b for b in range(64)}
    values = np.array(sorted(prints), dtype=np.uint64)
    rows = [(int(v),) for v in values.view(np.int64)]
    edges = simhash.links(spark.createDataFrame(rows, "fp long"), 2, block_rows)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    want = lowest_reachable(values.view(np.int64).tolist(), near)
    assert [roots.get(v, v) for v in values.view(np.int64).tolist()] == want


def test_keep_one_and_empty(spark):
    rows = [(3, "a b c d"), (1, "A b c d"), (2, "else something other here"), (2, "else something other here"), (None, "a b c d")]
    docs = frame(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 1), (False, 2), (False, 2), (True, 0)]
    assert simhash.simhash_components(docs.limit(0)).count() == 0


def shingles_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def planted(rng, n, edits):
    """Texts of 40 to 120 random words, each beside a copy with ``edits`` of them substituted."""
    for _ in range(n):
        words = [f"w{x}" for x in rng.integers(0, 5000, rng.integers(40, 120))]
        copy = list(words)
        for at in rng.choice(len(words), edits, replace=False):
            copy[at] = "other"
        yield " ".join(words), " ".join(copy)


@pytest.mark.parametrize("block_rows", [2, 2048])
def test_copies_are_those_of_brute_force(spark, block_rows):
    rng = np.random.default_rng(11)
    texts = [t for edits in (1, 1, 1, 2, 6) for pair in planted(rng, 12, edits) for t in pair]
    chain = [f"c{x}" for x in range(100)]
    texts += [" ".join(chain[k : k + 80]) for k in range(0, 20, 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles_of(t) for t in texts]
    near = [[len(a & b) / len(a | b) >= 0.8 for b in sets] for a in sets]
    want = lowest_reachable(range(len(texts)), near)
    found = {r.doc_id: r.component_id for r in simhash.copy_components(docs, block_rows=block_rows).collect()}
    assert [found[i] for i in range(len(texts))] == want
    assert 20 < sum(i != label for i, label in enumerate(want)) < len(texts) / 2
    # most of these are further apart than the two bits of operator 10
    prints = np.array([plain_fingerprint(t) for t in texts], dtype=np.uint64)
    assert sum(int(prints[i] ^ prints[i + 1]).bit_count() > 2 for i in range(0, 120, 2) if near[i][i + 1]) > 10


def test_near_fingerprints_alone_find_copies(spark, monkeypatch):
    """Without any min-wise fingerprint: copies in one SimHash component are linked, and no other texts."""
    monkeypatch.setattr(simhash, "bands", lambda hashes: np.zeros(0, dtype=np.int64))
    rng = np.random.default_rng(13)
    texts = [t for pair in planted(rng, 40, 1) for t in pair]
    line = " ".join(f"line{k}" for k in range(11))
    texts += [" ".join(f"w{x}" for x in rng.integers(0, 5000, 200)) + (" " + line) * 100 for _ in range(4)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles_of(t) for t in texts]
    prints = np.array([simhash._majority(simhash._ones(simhash.shingle_set(t)), len(simhash.shingle_set(t))) for t in texts], dtype=np.uint64)
    found = {r.doc_id: r.component_id for r in simhash.copy_components(docs).collect()}
    copies = [[len(a & b) / len(a | b) >= 0.8 for b in sets] for a in sets]
    want = lowest_reachable(range(len(texts)), copies)
    assert all(found[i] in (i, want[i]) for i in range(len(texts)))
    differ = prints[:, None] ^ prints[None, :]
    halves = np.minimum(np.bitwise_count(differ & np.uint64(2**32 - 1)), np.bitwise_count(differ >> np.uint64(32)))
    near = (halves <= 1) & (np.bitwise_count(differ) <= simhash.COPY_BITS)
    assert all(found[i] == found[j] for i in range(80) for j in range(80) if near[i, j] and copies[i][j])
    assert sum(found[i + 1] == i for i in range(0, 80, 2)) > 5


def test_a_repeated_line_does_not_make_copies(spark):
    rng = np.random.default_rng(12)
    line = " ".join(f"line{k}" for k in range(11))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 200)) + (" " + line) * 100 for _ in range(6)]
    prints = [plain_fingerprint(t) for t in texts]
    assert all((prints[0] ^ p).bit_count() <= 2 for p in prints)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert simhash.keep_one(docs).count() == len(texts)


def test_sets_that_share_too_little_are_not_linked():
    import pandas as pd

    base = np.arange(100)
    sets = [base, base[:80], base[:79], np.arange(1000, 1100)]
    frame = pd.DataFrame({"bucket": 1, "block_i": 0, "block_j": 0, "side": 0, "key": [5, 6, 7, 8], "hashes": sets})
    a, b = simhash._resembling(frame, 0.8)
    assert sorted(zip(a.tolist(), b.tolist())) == [(5, 6), (6, 7)]
    a, b = simhash._resembling(frame.drop(1), 0.8)
    assert len(a) == len(b) == 0
