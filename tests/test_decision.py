import pytest

from propense.operators import decision, silver

PRODUCTS = ["a", "b", "c"]


def scores(spark, *rows):
    columns = ", ".join(f"{p}_predicted_probability double, {p}_predicted_revenue double" for p in PRODUCTS)
    return spark.createDataFrame(rows, f"client long, {columns}")


def test_known_customer(spark):
    df = scores(spark, (545, 0.7717968, 5.3578362, 0.743412, 10.341004, 0.35874963, 2.6644068))
    combined = decision.expected_revenue(df, PRODUCTS)
    row = combined.first()
    assert row["a_expected_revenue"] == pytest.approx(4.135161, abs=2e-6)
    assert row["b_expected_revenue"] == pytest.approx(7.687627, abs=2e-6)
    assert row["c_expected_revenue"] == 0.0
    best = decision.best_product(combined, PRODUCTS).first()
    assert best["best_product_type"] == "B"
    assert combined.columns == ["client"] + [
        f"{p}_{c}" for p in PRODUCTS for c in ("predicted_probability", "predicted_revenue", "expected_revenue")
    ]


def test_threshold_is_inclusive_also_for_floats(spark):
    tables = {
        p: (
            spark.sql("SELECT 1L AS client, CAST(0.75 AS FLOAT) AS predicted_probability"),
            spark.sql("SELECT 1L AS client, 2.0D AS predicted_revenue"),
        )
        for p in PRODUCTS
    }
    combined = decision.expected_revenue(decision.combine_scores(tables, "client"), PRODUCTS, 0.75)
    assert combined.first()["a_expected_revenue"] == 1.5


def test_ties_go_to_the_earlier_product(spark):
    df = scores(spark, (1, 0.1, 9.0, 0.1, 9.0, 0.1, 9.0), (2, 0.1, 1.0, 0.8, 5.0, 0.8, 5.0))
    outcome = decision.best_product(decision.expected_revenue(df, PRODUCTS), PRODUCTS)
    assert {r["client"]: r["best_product_type"] for r in outcome.collect()} == {1: "A", 2: "B"}
    assert decision.top_offers(outcome, "client", 10).count() == 1


def test_only_customers_scored_by_all_remain(spark):
    def table(name, clients):
        return spark.createDataFrame([(c, 0.9) for c in clients], f"client long, {name} double")

    tables = {
        "a": (table("predicted_probability", [1, 2, 3]), table("predicted_revenue", [1, 2])),
        "b": (table("predicted_probability", [2, 3]), table("predicted_revenue", [1, 2, 3])),
    }
    assert [r["client"] for r in decision.combine_scores(tables, "client").collect()] == [2]


def test_product_mix(spark):
    rows = [(i, 1.0, "A") for i in range(573)] + [(i, 1.0, "B") for i in range(52)] + [(i, 1.0, "C") for i in range(11)]
    df = spark.createDataFrame(rows, "client long, max_expected_revenue double, best_product_type string")
    mix = {r["best_product_type"]: r["percentage"] for r in decision.product_mix(df).collect()}
    assert mix == {"A": 90.09, "B": 8.18, "C": 1.73}


def test_sweep_equals_single_thresholds(spark, roles):
    products = ["o", "f", "p"]
    sweep = {r["threshold"]: r for r in decision.threshold_sweep(roles.scores, products, (0.4, 0.71)).collect()}
    for threshold, row in sweep.items():
        outcome = decision.best_product(decision.expected_revenue(roles.scores, products, threshold), products)
        total = decision.outcome_totals(outcome).first()["total_expected_revenue"]
        assert row["total_expected_revenue"] == total
        assert row["positive_offers"] == decision.positive_offers(outcome, "client").count()


def test_sweep_of_a_thousand_thresholds(spark):
    """Every threshold against a plain loop, with ties, gaps, NULLs and probabilities at a threshold."""
    import random

    rng = random.Random(3)
    products = ["a", "b", "c"]
    grid = [k / 1000 for k in range(1000)]
    chance = lambda: rng.choice([None, 0.0, 1.0, 0.25, rng.randrange(1000) / 1000, rng.random(), -1.0, 2.0])
    worth = lambda: rng.choice([None, 0.0, -3.0, 8.0, rng.randrange(100) / 4])
    rows = [(k, *[x for _ in products for x in (chance(), worth())]) for k in range(300)]
    columns = ", ".join(f"{p}_predicted_probability double, {p}_predicted_revenue double" for p in products)
    scores = spark.createDataFrame(rows, f"client long, {columns}").repartition(3)
    got = {r["threshold"]: r for r in decision.threshold_sweep(scores, products, [*grid, 0.5]).collect()}
    assert sorted(got) == grid
    for t in grid:
        values, best = [], dict.fromkeys(products, 0)
        for _, *cells in rows:
            worths = [
                0.0 if p is not None and p < t else None if p is None or r is None else p * r for p, r in zip(cells[::2], cells[1::2])
            ]
            known = [w for w in worths if w is not None]
            value = max(known, default=None)
            best[next((p for p, w in zip(products, worths) if w is not None and w == value), products[-1])] += 1
            values.append(value)
        row = got[t]
        assert row["customers"] == 300 and row["positive_offers"] == sum(v is not None and v > 0 for v in values)
        assert row["total_expected_revenue"] == pytest.approx(sum(v for v in values if v is not None), abs=0.006)
        assert [row[f"best_{p}"] for p in products] == list(best.values())
    assert decision.threshold_sweep(scores.limit(0), products, grid).count() == 0
    with pytest.raises(ValueError, match="finite"):
        decision.threshold_sweep(scores, products, [])
    # customers are not taken times thresholds, and are read once
    plan = decision.threshold_sweep(scores, products, grid)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2


def test_top_k_with_equal_values_is_settled_by_key(spark):
    df = spark.range(1000).selectExpr("id AS client", "5.0D AS max_expected_revenue", "'A' AS best_product_type")
    assert [r["client"] for r in decision.top_offers(df, "client", 4).collect()] == [0, 1, 2, 3]


def test_silver_joins_need_the_key(spark):
    a, b = spark.range(3).toDF("client"), spark.range(3).toDF("id")
    with pytest.raises(ValueError, match="client"):
        silver.train_table(a, [b], "client")
    with pytest.raises(ValueError, match="client"):
        silver.holdout_table(a, [], b, "client")


def test_silver_plans_shuffle_each_input_once(spark, roles):
    """With broadcasting off, no input of the joins is shuffled again after its own aggregation."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = roles.train._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    on_client = [
        line for line in plan.splitlines()
        if "Exchange hashpartitioning" in line and any(k in line for k in ("(client#", "o_custkey#", "user_id#"))
    ]
    assert len(on_client) == 5  # campaign clients, sales, flows, balances, profile
