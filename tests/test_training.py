import threading

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from functools import lru_cache
from itertools import product
from math import factorial

from propense.operators import attribution, training
from propense.plans import registry

SETTINGS = {"max_depth": 3, "n_estimators": 4, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(400).selectExpr(
        "id AS client",
        "CAST((id * 37) % 101 AS DOUBLE) AS a",
        "CAST((id * 53) % 89 AS DOUBLE) AS b",
        "IF(id % 11 = 0, NULL, element_at(array('x', 'y', 'z'), CAST(id % 3 AS INT) + 1)) AS c",
    )
    return df.selectExpr(
        "*",
        "CAST(a + IF(c = 'y', 60, 0) > 70 AS INT) AS sale",
        "IF(b > 20, b * 2 + a, 0D) AS revenue",
    ).cache()


SALE = training.ModelSpec("sale", "propensity", "sale", "client", ("a", "b", "c"), ("c",))
REVENUE = training.ModelSpec("revenue", "revenue", "revenue", "client", ("a", "b", "c"), ("c",), scale_target=True)


@pytest.fixture(scope="module")
def final(rows):
    return training.fit_final(rows, SALE, SETTINGS, holdout=rows.where("client < 50"))


def test_spec_is_validated():
    with pytest.raises(ValueError, match="kind"):
        training.ModelSpec("m", "ranking", "y", "k", ("a",))
    with pytest.raises(ValueError, match="categorical"):
        training.ModelSpec("m", "revenue", "y", "k", ("a",), ("b",))


def test_drawn_settings_differ_and_repeat():
    space = training.SPACES["propensity"]
    drawn = training.draw_settings(space, 50, 1)
    assert len({tuple(s.values()) for s in drawn}) == 50
    assert drawn == training.draw_settings(space, 50, 1) != training.draw_settings(space, 50, 2)
    assert all(s[k] in space[k] for s in drawn for k in space)
    small = {"max_depth": [1, 2], "n_estimators": [3]}
    assert sorted(s["max_depth"] for s in training.draw_settings(small, 10, 1)) == [1, 2]


def test_search_scores_are_exact_and_on_the_targets_scale(rows):
    space = {"max_depth": [3], "n_estimators": [3], "learning_rate": [0.3]}
    scaled = training.search(rows, REVENUE, space=space, k_folds=(3,), runs_per_k=1, n_iter=1, importance=False)
    spread = rows.agg(F.stddev_pop("revenue")).first()[0]
    error = scaled.runs.first()["mae_score"]
    assert 1 < error < spread  # in deviations it would be below 1
    plain = training.ModelSpec(**{**REVENUE.__dict__, "scale_target": False})
    same = training.search(rows, plain, space=space, k_folds=(3,), runs_per_k=1, n_iter=1, importance=False)
    assert error == pytest.approx(same.runs.first()["mae_score"], rel=0.5)
    scored = rows.select(F.col("sale").cast("double").alias("label"), F.array(F.lit(0.0), F.col("a") / 101).alias("p"))
    from pyspark.ml.functions import array_to_vector

    scored = scored.select("label", array_to_vector("p").alias("probability"))
    want = training.metrics.roc_auc(rows.withColumn("q", F.col("a") / 101), "sale", "q").first()[0]
    assert training._score(scored, SALE, 1.0) == pytest.approx(want, abs=1e-12)


def test_bins_are_a_setting():
    assert training.estimator(SALE, {}, 10).getMaxBins() == training.MAX_BINS >= 256
    assert training.estimator(SALE, {"max_bins": 64}, 10).getMaxBins() == 64


def _parts(rows, spec):
    data = training.training_set(rows, spec)
    prepared = spec.features.fit(data.rows)
    ready = prepared.transform(data.rows)
    return ready.where("client % 3 <> 0").cache(), ready.where("client % 3 = 0").cache(), data


@pytest.mark.parametrize("spec", [SALE, REVENUE])
def test_staged_scores_are_those_of_fits_of_their_own(rows, spec):
    train, test, data = _parts(rows.where("revenue <> 0") if spec is REVENUE else rows, spec)
    settings = {"max_depth": 3, "learning_rate": 0.3, "colsample_bytree": 0.6}
    scale = data.scaler.std if data.scaler else 1.0
    staged = training.staged_scores(train, test, spec, settings, [1, 7, 3, 7], data.count, scale)
    assert sorted(staged) == [1, 3, 7]
    for n, score in staged.items():
        alone = training.staged_scores(train, test, spec, settings, [n], data.count, scale)
        assert score == pytest.approx(alone[n], rel=1e-12)


def test_staged_margins_stay_arrow_columns(rows):
    train, test, data = _parts(rows, SALE)
    model = training.estimator(SALE, {"max_depth": 2, "n_estimators": 3}, data.count).setParams(leafCol="_leaf").fit(train)
    # more rows than a chunk, in batches of their own, and none at all
    many = model.transform(test.crossJoin(F.broadcast(rows.sparkSession.range(20).coalesce(1)))).coalesce(1)
    margins = many.select(training._staged(model, [1, 3], "_leaf").alias("m"), vector_to_array("rawPrediction")[1].alias("raw"))
    assert f"], {PythonEvalType.SQL_SCALAR_ARROW_UDF}" in margins._jdf.queryExecution().toString()
    found = margins.agg(F.count("m"), F.max(F.abs(F.col("m")[1] - F.col("raw"))), F.min(F.size("m")), F.max(F.size("m"))).first()
    assert found[0] == test.count() * 20 > 2048 and found[1] < 1e-12 and found[2] == found[3] == 2
    assert margins.where("m[0] IS NULL").count() == 0


def test_searches_of_both_kinds_share_the_training_table(spark, monkeypatch):
    writes, searched = [], []
    monkeypatch.setattr(registry, "written", lambda df: writes.append(df) or df)
    monkeypatch.setattr(registry.training, "search", lambda df, spec, **_: searched.append(spec.kind))
    for kept in (registry._search, registry._searched_rows):
        monkeypatch.setattr(registry, kept.__name__, lru_cache(kept.__wrapped__))
    for kind in ("propensity", "revenue"):
        registry._search(spark, "/root/testdata/sf0.001", kind, "o", kind, 2)
    assert searched == ["propensity", "revenue"] and len(writes) == 1


def test_settings_that_differ_in_length_share_a_fit(rows, monkeypatch):
    fits = []
    make = training.estimator
    monkeypatch.setattr(training, "estimator", lambda spec, settings, n: fits.append(dict(settings)) or make(spec, settings, n))
    space = {"max_depth": [1, 2], "n_estimators": [2, 4, 3], "learning_rate": [0.3]}
    found = training.search(rows, SALE, space=space, k_folds=(2,), runs_per_k=2, n_iter=6)
    # two runs of all six settings: one fit for each depth and fold, of the longest
    assert sorted((f["max_depth"], f["n_estimators"]) for f in fits) == [(1, 4)] * 2 + [(2, 4)] * 2
    assert found.settings.count() == 12 and not found.errors
    both = [sorted(r["auc_score"] for r in found.settings.where(f"iteration_id = {k}").collect()) for k in (0, 1)]
    assert both[0] == both[1]


def test_folds_are_fitted_side_by_side(rows, monkeypatch):
    together, fitted = threading.Barrier(3, timeout=120), training.staged_scores

    def meet(*args):
        together.wait()
        return fitted(*args)

    monkeypatch.setattr(training, "staged_scores", meet)
    space = {"max_depth": [2], "n_estimators": [2], "learning_rate": [0.3]}
    found = training.search(rows, SALE, space=space, k_folds=(3,), runs_per_k=1, n_iter=1)
    assert not found.errors


def test_parts_follow_the_cores_not_the_rows(spark, rows):
    cores = spark.sparkContext.defaultParallelism
    many = rows.selectExpr("*", "CAST(sale AS DOUBLE) AS label", "1D AS weight").repartition(3 * cores)
    for n, fits, parts in [(400, 1, 1), (100 * cores * 20_000, 1, 4 * cores), (10 * cores * 20_000, 2, -(-cores // 2))]:
        with training._prepared(SALE, n, many, many, fits=fits) as (_, (train, test)):
            assert train.rdd.getNumPartitions() == min(parts, 3 * cores)
            assert test.count() == 400


def test_final_fits_side_by_side_share_the_cores(rows, monkeypatch):
    asked, parts = [], training._parts
    monkeypatch.setattr(training, "_parts", lambda spark, n, fits=1: asked.append(fits) or parts(spark, n, fits))
    training.fit_final(rows, SALE, {"max_depth": 1, "n_estimators": 1}, fits=3)
    assert asked[0] == 3


def test_rows_keep_their_nodes_in_deep_trees_alone(spark):
    assert [training.estimator(SALE, {"max_depth": d}, 100).getCacheNodeIds() for d in (5, 10, 11, 25)] == [False, False, True, True]


def test_staged_drawing():
    space = training.SPACES["propensity"]
    drawn = training.draw_settings(space, 20, 3, staged=True)
    assert len(drawn) == 20 and all(list(s) == list(space) for s in drawn)
    bases = {tuple(v for n, v in s.items() if n != "n_estimators") for s in drawn}
    assert len(bases) == 3 and {s["n_estimators"] for s in drawn} == set(space["n_estimators"])
    assert len({tuple(s.values()) for s in drawn}) == 20


def test_search_and_lookup(rows):
    space = {"max_depth": [1, 3], "n_estimators": [3], "learning_rate": [0.3]}
    result = training.search(rows, SALE, space=space, k_folds=(2, 3), runs_per_k=1, n_iter=2, importance=True)
    runs = [r.asDict() for r in result.runs.collect()]
    assert not result.errors and {r["k_folds"] for r in runs} == {2, 3}
    assert [r["auc_score"] for r in runs] == sorted((r["auc_score"] for r in runs), reverse=True)
    assert result.settings.count() == 4
    # A run keeps its best setting.
    best = {r["iteration_id"]: r["best"] for r in result.settings.groupBy("iteration_id").agg(F.max("auc_score").alias("best")).collect()}
    assert all(best[r["iteration_id"]] == r["auc_score"] for r in runs)
    assert training.best_parameters(result.runs, SALE)["max_depth"] == runs[0]["max_depth"]
    top = training.top_settings(result, SALE, 1).collect()
    assert len(top) == 2 and {r["rank"] for r in top} == {1}
    for row in result.importance.groupBy("iteration_id").agg(F.sum("explained_variance"), F.count("*")).collect():
        assert row[1] == pytest.approx(1.0) and row[2] == 5
    again = training.search(rows, SALE, space=space, k_folds=(2, 3), runs_per_k=1, n_iter=2, importance=False)
    assert [r["auc_score"] for r in again.runs.collect()] == [r["auc_score"] for r in runs]


def test_failing_run_is_reported(rows):
    mixed = {"max_depth": [99, 2], "n_estimators": [2]}
    result = training.search(rows, SALE, space=mixed, k_folds=(2,), runs_per_k=4, n_iter=1)
    depths = [training.draw_settings(mixed, 1, SALE.seed + run)[0]["max_depth"] for run in range(4)]
    assert set(depths) == {99, 2} and set(result.errors) == {r for r in range(4) if depths[r] == 99}
    assert result.runs.count() == depths.count(2)
    space = {"max_depth": [99], "n_estimators": [2]}
    with pytest.raises(RuntimeError, match="no run"):
        training.search(rows, SALE, space=space, k_folds=(2,), runs_per_k=1, n_iter=1)


def test_final_model(rows, final):
    row = final.metrics.first().asDict()
    assert row["auc_score"] > 0.9 and row["training_samples"] == 400
    assert row["true_positives"] + row["false_negatives"] == row["positive_class_count"]
    assert row["holdout_positive_class_count"] == rows.where("client < 50 AND sale = 1").count()
    history = final.history_row()
    assert training.latest_predictors(history) == ["a", "b", "c"]
    assert history.first()["param_max_depth"] == 3.0


def test_holdout_keeps_the_classes_of_training(rows):
    """A holdout with one class only, also of a text target, is labelled as the training rows are."""
    text = rows.withColumn("sale", F.when(F.col("sale") == 1, "yes").otherwise("no"))
    for value, column in (("yes", "holdout_positive_class_count"), ("no", "holdout_negative_class_count")):
        only = text.where(F.col("sale") == value)
        row = training.fit_final(text, SALE, SETTINGS, holdout=only).metrics.first()
        assert row[column] == only.count() and row["holdout_auc_score"] is None


def test_scores(rows, final):
    scored = training.score_propensity(final.model, rows.select("client", "a", "b", "c"), "client")
    stats = scored.agg(F.count("*"), F.min("predicted_probability"), F.max("predicted_probability")).first()
    assert stats[0] == 400 and 0 <= stats[1] < stats[2] <= 1
    assert scored.where("predicted_class <> CAST(predicted_probability > 0.5 AS INT)").count() == 0


def test_revenue_model_is_saved_with_its_scaler(spark, rows, tmp_path):
    buyers = rows.where("revenue <> 0")
    final = training.fit_final(buyers, REVENUE, SETTINGS)
    assert final.metrics.first()["mean_actual"] == pytest.approx(buyers.agg(F.avg("revenue")).first()[0])
    training.save_model(final, str(tmp_path / "m"))
    model, scaler = training.load_model(spark, str(tmp_path / "m"), scaled=True)
    one = training.score_revenue(final.model, rows, "predicted", final.scaler)
    two = training.score_revenue(model, rows, "predicted", scaler)
    assert one.columns == [*rows.columns, "predicted"]
    assert one.exceptAll(two).count() == 0 and one.count() == 400


def test_attributions_add_up(rows, final):
    detail = attribution.attribute(final.model, rows, rows, "client", sample_size=None).cache()
    assert detail.count() == 400 * 5
    sums = detail.groupBy("instance_id").agg(
        F.sum("contribution").alias("s"), F.first("base_value").alias("b"), F.first("margin").alias("m")
    )
    raw = final.model.transform(rows).select(
        F.col("client").alias("instance_id"), vector_to_array("rawPrediction")[1].alias("raw")
    )
    worst = sums.join(raw, "instance_id").agg(
        F.max(F.abs(F.col("s") + F.col("b") - F.col("m"))), F.max(F.abs(F.col("raw") - F.col("m"))), F.count("*")
    ).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9 and worst[2] == 400
    summary = attribution.attribution_summary(detail).collect()
    assert [r["feature_rank"] for r in summary] == [1, 2, 3, 4, 5]
    assert summary[0]["feature_name"] in ("a", "c_y")
    sampled = attribution.attribute(final.model, rows, rows, "client", sample_size=20)
    assert sampled.select("instance_id").distinct().count() == 20


def test_attributions_equal_the_definition(final):
    """Every subset of features, every background row: the Shapley value written out."""
    leaves = attribution.leaves_of(final.model.stages[-1])
    stacks = attribution.stacked(leaves)
    rng = np.random.default_rng(0)
    x, z = (np.hstack([rng.normal(size=(n, 2)), rng.integers(0, 2, (n, 3))]) for n in (8, 6))
    n = x.shape[1]
    want = np.zeros_like(x)
    for i, row in enumerate(x):
        for other in z:
            value = {
                taken: attribution.margin(leaves, np.where(np.array(taken, bool), row, other)[None])[0]
                for taken in product((0, 1), repeat=n)
            }
            for taken, without in value.items():
                size = sum(taken)
                share = factorial(size) * factorial(n - size - 1) / factorial(n) if size < n else 0.0
                for j in (j for j in range(n) if not taken[j]):
                    with_j = value[taken[:j] + (1,) + taken[j + 1 :]]
                    want[i, j] += share * (with_j - without) / len(z)
    assert np.abs(attribution.contributions(stacks, z, x) - want).max() < 1e-12


def test_many_deep_trees_are_attributed_quickly():
    """100 trees of depth 6 over 1,024 rows and 100 background rows; contributions add up."""
    import time

    rng = np.random.default_rng(0)
    leaves = []
    for _ in range(100):
        for code in range(64):
            features, at = np.arange(6) + rng.integers(0, 15), rng.standard_normal(6)
            side = np.array([code >> j & 1 for j in range(6)], dtype=bool)
            leaves.append(
                attribution.Leaf(float(rng.standard_normal()), features, np.where(side, -np.inf, at), np.where(side, at, np.inf))
            )
    x, z = rng.standard_normal((1024, 21)), rng.standard_normal((100, 21))
    start = time.monotonic()
    phi = attribution.contributions(attribution.stacked(leaves), z, x)
    assert time.monotonic() - start < 60
    want = attribution.margin(leaves, x) - attribution.margin(leaves, z).mean()
    assert np.abs(phi.sum(axis=1) - want).max() < 1e-9


def test_wide_categories_are_attributed_sparsely(spark):
    """A predictor with very many categories: tasks see the features that leaves use, and no others."""
    n = 20_000
    df = spark.range(n).selectExpr(
        "id AS client", "CAST(id % 97 AS DOUBLE) AS a", "concat('c', id % 5000) AS wide", "CAST(id % 97 > 50 OR id % 5000 < 40 AS INT) AS sale"
    )
    spec = training.ModelSpec("w", "propensity", "sale", "client", ("a", "wide"), ("wide",))
    final = training.fit_final(df, spec, {"max_depth": 2, "n_estimators": 3, "learning_rate": 0.5})
    some = df.where("client < 60")
    sparse = attribution.attribute(final.model, df, some, "client", zeros=False)
    whole = attribution.attribute(final.model, df, some, "client")
    used, _ = attribution._used(attribution.leaves_of(final.model.stages[-1]))
    assert sparse.count() == 60 * len(used) < 60 * 12 and whole.count() == 60 * 5000
    key = ["instance_id", "feature_name", "feature_value", "contribution", "base_value", "margin"]
    rest = whole.select(key).exceptAll(sparse.select(key))
    assert rest.count() == 60 * (5000 - len(used)) and rest.where("contribution <> 0").count() == 0
    # the zero rows have the values of their features: one category, or none for the first
    ones = whole.where("feature_name LIKE 'wide%'").groupBy("instance_id").agg(F.sum("feature_value").alias("s")).groupBy("s").count()
    assert {r["s"]: r["count"] for r in ones.collect()} == {0.0: 1, 1.0: 59}
    sums = whole.groupBy("instance_id").agg((F.sum("contribution") + F.first("base_value") - F.first("margin")).alias("off"))
    assert sums.agg(F.max(F.abs("off"))).first()[0] < 1e-9
    # brute force: the definition over dense vectors
    leaves = attribution.leaves_of(final.model.stages[-1])
    dense = lambda d: np.array(
        [r[0] for r in final.model.transform(d).orderBy("client").select(vector_to_array("features")).collect()]
    )
    background = dense(attribution.prep.sample_rows(df, "client", attribution.BACKGROUND_SIZE, 42))
    want = attribution.contributions(attribution.stacked(leaves), background, dense(some))
    got = {(r["instance_id"], r["feature_name"]): r["contribution"] for r in sparse.collect()}
    names = attribution.prep.feature_names(final.model)
    assert max(abs(got[i, names[j]] - want[i, j]) for i in range(60) for j in used) < 1e-12


def test_the_latest_of_equal_time_stamps_is_settled(spark):
    rows = [("t1", "a", "x"), ("t2", "b", "y"), ("t2", "c", "x"), ("t2", None, "z")]
    for part in (1, 3):
        history = spark.createDataFrame(rows, "model_timestamp string, predictive_variables string, z string").repartition(part)
        assert training.latest_predictors(history) == ["c"]
