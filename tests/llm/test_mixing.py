import math

import pytest

from propense.llm import mixing, queries


def docs_of(spark, sizes, more=()):
    rows = [(f"{s}{k}", s) for s, n in sizes.items() for k in range(n)]
    rows = [(i, "word " * (3 + i % 7), s) for i, (_, s) in enumerate(rows)] + list(more)
    return spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS tokens", "2 AS slot", "3 AS pass")


def totals_of(spark, tokens):
    rows = [(s, 1, n) for s, n in tokens.items()]
    return spark.createDataFrame(rows, "source string, docs long, tokens long")


def entropy(w):
    return -sum(x * math.log(x) for x in w if x)


@pytest.mark.parametrize("share,repeats", [(0.9, 100.0), (1.0, 2.0), (1.0, 1000.0), (0.2, 5.0)])
def test_exponent_meets_the_target(spark, share, repeats):
    tokens = {"a": 90_000, "b": 9_000, "c": 900, None: 100}
    totals = totals_of(spark, tokens)
    found = mixing.find_exponent(totals, mixing.Target(entropy_share=share, max_repeats=repeats))
    exponent, z, whole, budget = found.exponent, found.z, found.whole, found.budget
    p = [n / whole for n in tokens.values()]

    def state(a):
        w = [x**a for x in p]
        w = [x / sum(w) for x in w]
        return entropy(w), max(x * budget / n for x, n in zip(w, tokens.values()))

    h, most = state(exponent)
    assert most <= repeats * (1 + 1e-6)
    assert found.met and h <= share * math.log(4) + 1e-9
    if exponent > 0:
        flatter_h, flatter_most = state(exponent - 1e-6)
        assert flatter_h > share * math.log(4) or flatter_most > repeats
    assert z == pytest.approx(sum(x**exponent for x in p))
    with pytest.raises(ValueError):
        mixing.find_exponent(totals, mixing.Target(max_repeats=1.0, budget=whole + 1))


@pytest.mark.parametrize("tokens", [{"a": 1000, "b": 990, "c": 980}, {k: 10_000 + 7 * k for k in range(50)}, {"a": 5, "b": 4}])
def test_sources_flatter_than_wanted(spark, tokens):
    """The exponent grows above 1 until the entropy is met."""
    tokens = {str(k): n for k, n in tokens.items()}
    share = 0.9
    found = mixing.find_exponent(totals_of(spark, tokens), mixing.Target(entropy_share=share, max_repeats=1000.0))
    assert found.met and found.exponent > 1
    w = [(n / found.whole) ** found.exponent for n in tokens.values()]
    assert entropy([x / sum(w) for x in w]) == pytest.approx(share * math.log(len(tokens)), abs=1e-6)
    weighed = mixing.weights(totals_of(spark, tokens), mixing.Target(entropy_share=share, max_repeats=1000.0)).collect()
    assert sum(r.weight for r in weighed) == pytest.approx(1.0) and all(r.met for r in weighed)


def test_targets_out_of_reach_are_reported(spark):
    # sources alike stay alike, whatever the exponent
    alike = mixing.find_exponent(totals_of(spark, {"a": 50, "b": 50}), mixing.Target(entropy_share=0.5))
    assert (alike.exponent, alike.met) == (1.0, False)
    # the entropy would need more repeats than allowed: as far as those go
    tokens = {"a": 1000, "b": 900, "c": 800}
    tight = mixing.find_exponent(totals_of(spark, tokens), mixing.Target(entropy_share=0.2, max_repeats=1.5))
    w = [(n / 2700) ** tight.exponent for n in tokens.values()]
    most = max(x / sum(w) * 2700 / n for x, n in zip(w, tokens.values()))
    assert not tight.met and most == pytest.approx(1.5, abs=1e-6)
    one = mixing.find_exponent(totals_of(spark, {"a": 5}), mixing.Target(entropy_share=0.98))
    assert one.met
    assert mixing.find_exponent(totals_of(spark, {"a": 5}).limit(0), mixing.Target(entropy_share=0.98)).met


def test_target_binds_on_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("source", mixing.count_tokens("text").alias("tokens"))
    found = mixing.find_exponent(mixing.source_totals(docs), mixing.Target(entropy_share=mixing.ENTROPY_SHARE))
    assert found.met and found.exponent != 1.0


def brute(docs, target, block_tokens, seed_order):
    """Streams of the sources in the order of the operator's hash, cut by budget."""
    out = {}
    for source, (items, budget, all_tokens) in seed_order.items():
        for p in range(math.ceil(budget / all_tokens)):
            at = p * all_tokens
            for doc, n in items[p]:
                if at < budget:
                    out[doc, p] = (source, at, n)
                at += n
    return out


@pytest.mark.parametrize("slot_docs", [3, 5000])
def test_streams_equal_brute_force(spark, monkeypatch, slot_docs):
    monkeypatch.setattr(mixing, "SLOT_DOCS", slot_docs)
    docs = docs_of(spark, {"a": 60, "b": 9, "c": 2}, [(900, None, "a"), (901, "", "b"), (902, "x y", None), (None, "z z z", "b")])
    target = mixing.Target(entropy_share=1.0, max_repeats=6.0)
    got = mixing.mix(docs, target, block_tokens=100)
    rows = got.collect()
    tokens = {(r.doc_id, r.source): len((r.text or "").split()) for r in docs.collect()}
    totals = {}
    for (_, s), n in tokens.items():
        totals[s] = totals.get(s, 0) + n
    totals = {s: n for s, n in totals.items() if n}
    budgets = {r.source: r.budget for r in mixing.weights(totals_of(spark, totals), target).collect()}
    order = spark.createDataFrame([r.asDict() for r in rows], got.schema).select(
        "doc_id", "source", "pass", "tokens", mixing.F.xxhash64(mixing.F.lit(0), "pass", mixing.F.coalesce(mixing.F.col("doc_id").cast("string"), mixing.F.lit("")), "text_hash").alias("h")
    )
    for s in totals:
        for p in range(math.ceil(budgets[s] / totals[s])):
            mine = sorted((r for r in order.collect() if (r.source, r["pass"]) == (s, p)), key=lambda r: ((r.h % 2**64) >> 33, r.h))
            # all documents of a whole pass; of the last one those that begin before the budget ends
            at, expected = p * totals[s], 0
            for r in mine:
                assert at < budgets[s]
                at += r.tokens
                expected += 1
            whole_pass = sum(1 for (_, t), n in tokens.items() if t == s and n)
            assert expected == whole_pass or at >= budgets[s]
    taken = {s: sum(r.tokens for r in rows if r.source == s) for s in totals}
    for s in totals:
        assert budgets[s] <= taken[s] < budgets[s] + 10
    blocks = {}
    for r in rows:
        blocks.setdefault(r.block, []).append(r.position)
    assert all(sorted(ps) == list(range(len(ps))) for ps in blocks.values())
    n_blocks = math.ceil(sum(budgets.values()) / 100)
    assert set(blocks) == set(range(n_blocks))
    for s in totals:
        for b in range(n_blocks):
            held = sum(r.tokens for r in rows if r.block == b and r.source == s)
            assert abs(held - budgets[s] / n_blocks) <= 10 or totals[s] < 30
    assert mixing.mix(docs.limit(0), target).count() == 0
    again = sorted(map(tuple, mixing.mix(docs.repartition(5), target, block_tokens=100).collect()), key=repr)
    assert again == sorted(map(tuple, rows), key=repr)


def test_query(spark, sf_dir):
    rows = queries.op5_source_mixing(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(docs[r.doc_id].source == r.source and len(docs[r.doc_id].text.split()) == r.tokens for r in rows)
    assert len({(r.doc_id, r["pass"]) for r in rows}) == len(rows)
