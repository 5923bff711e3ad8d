"""All stages, one after the other, over a store of Parquet tables."""

import pytest

from propense.operators.quality import FieldSpec, Rule
from propense.operators.training import ModelSpec
from propense.operators import training
from propense.plans import stages
from propense.sources.tables import TableStore

SPACE = {"max_depth": [2, 3], "n_estimators": [2], "learning_rate": [0.3]}


def test_programme(spark, roles, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    with pytest.raises(ValueError, match="bronze.sales"):
        stages.build_train(store)
    names = stages.Names()
    for role in ("sales", "flows", "balances", "profile"):
        store.replace(getattr(roles, role), "bronze", getattr(names, role))

    specs = [
        FieldSpec("client", "profile", "client", (Rule("unique"), Rule("non_null"))),
        FieldSpec("gone", "profile", "gone", (Rule("non_null"),)),
    ]
    summary, failures = stages.check(store, specs)
    assert [r["check_type"] for r in summary.collect()] == ["non_null", "unique"] and list(failures) == ["gone"]
    assert store.read("dq", "dq_results").where("records_failed = 0").count() == 2

    assert stages.build_train(store) == roles.sales.count()
    assert stages.build_holdout(store) == roles.holdout.count() > 0
    train = store.read("silver", "train")
    assert train.columns[:2] == ["client", "sale_o"] and len(train.columns) == 26

    stages.profile(store)
    numeric = store.read("profile", "numerical_profiling_results")
    assert numeric.count() == 25 and numeric.first()["name_of_profile"] == "silver_train_numerical_profile"
    assert store.read("profile", "categorical_profiling_results").where("data_field_name = 'segment'").count() == 1

    products = {}
    for p in ("o", "f"):
        propensity = ModelSpec(f"{p}_sales", "propensity", f"sale_{p}", "client", ("acctbal", "segment"), ("segment",))
        revenue = ModelSpec(f"{p}_revenue", "revenue", f"revenue_{p}", "client", ("acctbal", f"bal_{p}"), scale_target=True)
        for spec in (propensity, revenue):
            settings = {"n_estimators": 2}
            if p == "o":  # the other product skips the search
                assert stages.search(store, spec, space=SPACE, k_folds=(2,), runs_per_k=1, n_iter=1) == {}
                settings = None
                small = {**training.SPACES[f"{spec.kind}_top"], "n_estimators": [2], "max_depth": [3]}
                assert stages.search_top(store, spec, n=2, space=small, k_folds=(2, 3), runs_per_k=1, n_iter=2) == {}
                top = store.read("models", f"{spec.name}_top_search")
                assert {(r["k_folds"], r["rank"]) for r in top.collect()} == {(2, 1), (2, 2), (3, 1), (3, 2)}
            final = stages.fit(store, spec, str(tmp_path / spec.name), settings)
            assert final.settings["n_estimators"] == 2
            assert spark.read.json(str(tmp_path / spec.name / "metrics")).count() == 1
            assert stages.score(store, spec, str(tmp_path / spec.name), str(tmp_path / "csv")) == roles.holdout.count()
        products[p] = (propensity.name, revenue.name)
    assert store.exists("models", "o_revenue_importance") and store.exists("models", "o_sales_top")

    metrics = stages.explain(store, propensity, {"n_estimators": 2}).first()
    assert 0 <= metrics["holdout_accuracy"] <= 1
    detail = store.read("models", f"attribution_{propensity.name}_detailed")
    assert detail.select("feature_name").distinct().count() == 5
    assert store.read("models", f"attribution_{propensity.name}_summary").count() == 5

    mix, totals = stages.decide(store, products, threshold=0.3)
    assert sum(r["count"] for r in mix.collect()) == roles.holdout.count()
    assert totals.first()["min_expected_revenue"] >= 0


def test_profiles_hold_no_distribution_in_a_cell(spark, tmp_path):
    """A column of keys has as many categories as rows: they are rows of the long table alone."""
    store = TableStore(spark, str(tmp_path))
    keys = spark.range(3000).selectExpr("id AS client", "concat('k', id) AS name")
    store.replace(keys, "silver", "train")
    stages.profile(store)
    summary = store.read("profile", "categorical_profiling_results")
    assert "category_distribution" not in summary.columns and summary.first()["unique_values_count"] == 3000
    assert store.read("profile", "category_distribution").where("count = 1").count() == 3000
