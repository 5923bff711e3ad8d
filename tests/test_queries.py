"""Every registered query: against its SQL where there is one, else against what must hold."""

import math

import pytest

import __spark_entry__ as entry
from tests.oracle import differences

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    values = [r["max_expected_revenue"] for r in rows]
    assert 0 < len(rows) <= 100
    assert values == sorted(values, reverse=True) and min(values) > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, con, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_holds(name, spark, sf_dir, roles):
    rows = [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]
    assert rows
    for row in rows:
        for column in ("auc_score", "predicted_probability", "accuracy", "precision", "recall"):
            if row.get(column) is not None:
                assert 0.0 <= row[column] <= 1.0
        if "margin" in row:
            assert math.isfinite(row["contribution"])
    if name.startswith("score_"):
        assert len(rows) == roles.holdout.count()
    if name == "attribution_all_rows":
        by_row = {}
        for row in rows:
            by_row.setdefault(row["instance_id"], []).append(row)
        assert len(by_row) == roles.holdout.count()
        for parts in by_row.values():
            total = sum(p["contribution"] for p in parts) + parts[0]["base_value"]
            assert total == pytest.approx(parts[0]["margin"], abs=1e-9)
    if name == "model_history":
        assert len(rows) == 2 and {r["response_variable"] for r in rows} == {"sale_o", "sale_f"}
        assert rows[0]["latest_predictors"].startswith("segment,")
    if name == "feature_importance":
        by_run = {}
        for row in rows:
            by_run.setdefault(row["iteration_id"], []).append(row)
        assert len(by_run) == 6
        for run in by_run.values():
            assert sorted(r["feature_importance_rank"] for r in run) == list(range(1, len(run) + 1))
            assert sum(r["explained_variance"] for r in run) == pytest.approx(1.0)
    if name in ("top_settings", "search_top"):
        assert {r["k_folds"] for r in rows} == {3, 4, 5} and {r["rank"] for r in rows} >= {1, 2}
