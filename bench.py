"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Every query runs
in full, into a sink that discards its rows; the better of two runs counts, so that the time is the
query's and not that of starting the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from propense.operators import attribution, training
from propense.plans import registry
from propense.session import cut_lineage, get_spark

HEADLINES = (
    "decide_expected_revenue best_offers top_offer_details product_mix outcome_totals threshold_sweep "
    "combine_scores silver_sales silver_train silver_holdout dq_unique dq_all dq_summary "
    "profile_numeric profile_numeric_lineitem profile_categorical category_distribution_events "
    "mean_baseline_mae standardize one_hot_drop_first kfold_sizes split_sizes classification_metrics "
    "regression_metrics fit_final_propensity fit_final_revenue score_propensity score_revenue "
    "attribution_detail ingest_jobs"
).split()


def saved_model(spark, sf_dir: str) -> dict:
    """Scoring and attribution with a model of 100 trees that is there already; the fits have lines of their own."""
    roles = registry.Roles(spark, sf_dir)
    spec = registry._propensity_spec()
    final = training.fit_final(roles.train, spec, {**registry.FIXED_SETTINGS, "n_estimators": 100})
    holdout = cut_lineage(roles.holdout)
    train = cut_lineage(roles.train)
    return {
        "score_saved_model": lambda: training.score_propensity(final.model, holdout, spec.key),
        "attribute_saved_model": lambda: attribution.attribute(final.model, train, holdout, spec.key),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINES
    spark = get_spark("bench")
    queries = registry.queries()
    runs = {name: lambda name=name: queries[name](spark, sf_dir) for name in names}
    if not sys.argv[1:]:
        runs |= saved_model(spark, sf_dir)
    best: dict[str, float] = {}
    for name, run in runs.items():
        for _ in range(2):
            start = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            best[name] = min(best.get(name, seconds), seconds)
            spark.catalog.clearCache()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in best.items()},
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
