import math
import random

import pytest

from propense.operators import metrics


def test_known_confusion_matrix(spark):
    cells = [(1, 0.9)] * 229 + [(0, 0.1)] * 680 + [(0, 0.8)] * 47 + [(1, 0.2)] * 13
    row = metrics.classification_metrics(spark.createDataFrame(cells, "y int, p double"), "y", "p").first()
    assert row["accuracy"] == pytest.approx(0.93808, abs=5e-6)
    assert row["precision"] == pytest.approx(0.82971, abs=5e-6)
    assert row["recall"] == pytest.approx(0.94628, abs=5e-6)
    assert row["f1_score"] == pytest.approx(0.88417, abs=5e-6)
    assert (row["positive_class_count"], row["negative_class_count"]) == (242, 727)


def test_empty_denominators(spark):
    row = metrics.classification_metrics(spark.createDataFrame([(0, 0.1)], "y int, p double"), "y", "p").first()
    assert (row["precision"], row["recall"], row["f1_score"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert row["auc_score"] is None


@pytest.mark.parametrize("digits", [1, 3, 12])
def test_auc_counts_pairs(spark, digits):
    rng = random.Random(digits)
    rows = [(rng.randint(0, 1), round(rng.random() ** 3, digits)) for _ in range(400)]
    rows += [(rng.randint(0, 1), 0.5) for _ in range(200)]  # a hot score
    pairs = [(p > n) + (p == n) / 2 for y, p in rows if y for z, n in rows if not z]
    got = metrics.roc_auc(spark.createDataFrame(rows, "y int, p double"), "y", "p").first()["auc_score"]
    assert got == pytest.approx(sum(pairs) / len(pairs), rel=1e-12)


@pytest.mark.parametrize(
    "score",
    [
        lambda rng: 0.5 + rng.random() * 1e-9,  # crowded
        lambda rng: 10 ** -rng.uniform(0, 15),  # over many magnitudes
        lambda rng: rng.choice([0.0, 1.0, 1e-300, 1 - 1e-16, 0.5]),  # at the ends
        lambda rng: rng.gauss(0, 3),  # not a probability at all
    ],
)
def test_auc_of_awkward_scores(spark, score):
    rng = random.Random(7)
    rows = [(rng.randint(0, 1), score(rng)) for _ in range(300)]
    pairs = [(p > n) + (p == n) / 2 for y, p in rows if y for z, n in rows if not z]
    got = metrics.roc_auc(spark.createDataFrame(rows, "y int, p double"), "y", "p").first()["auc_score"]
    assert got == pytest.approx(sum(pairs) / len(pairs), rel=1e-12)


def test_auc_by_groups_with_nulls(spark, monkeypatch):
    """Groups that share tasks and batches, a NULL group, groups of one class, and a group over all tasks."""
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1]), rng.randint(0, 1), rng.randrange(300) / 300) for _ in range(3000)]
    rows += [("big", 2, rng.randint(0, 1), rng.random()) for _ in range(4000)] + [("one", 3, 1, 0.5)] * 3
    rows += [("a", 1, None, 0.5), ("a", 1, 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, y int, p double").repartition(5)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        got = {(r["g"], r["h"]): r for r in metrics.classification_metrics(df, "y", "p", ["g", "h"], cutoff=0.3).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    groups = {}
    for g, h, y, p in rows:
        if y is not None and p is not None:
            groups.setdefault((g, h), []).append((y, p))
    assert set(got) == set(groups)
    for key, cells in groups.items():
        high, low = [p for y, p in cells if y], [p for y, p in cells if not y]
        pairs = sum((p > n) + (p == n) / 2 for p in high for n in low)
        want = pairs / (len(high) * len(low)) if high and low else None
        assert got[key]["auc_score"] == (None if want is None else pytest.approx(want, rel=1e-12))
        assert got[key]["true_positives"] == sum(p > 0.3 for p in high) and got[key]["false_positives"] == sum(p > 0.3 for p in low)


def test_scores_are_read_once(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    scored = lines.selectExpr("l_linenumber % 2 AS y", "l_discount * 10 AS p", "l_returnflag AS g")
    plan = metrics.classification_metrics(scored, "y", "p", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_regression(spark):
    rows = [(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)]
    row = metrics.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()
    assert row["mae"] == pytest.approx(4 / 3) and row["mse"] == pytest.approx(10 / 3)
    assert row["rmse"] == pytest.approx(math.sqrt(10 / 3))
    assert row["r2_score"] == pytest.approx(1 - 10 / 8)
    assert row["mae_percentage"] == pytest.approx(400 / 9) and row["std_actual"] == pytest.approx(2.0)
    zero = spark.createDataFrame([(-1.0, 0.0), (1.0, 0.0)], "y double, p double")
    assert metrics.regression_metrics(zero, "y", "p").first()["mae_percentage"] == math.inf
