"""The stages of a programme over a table store: each reads its tables, guards them and writes its own."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from propense.operators import attribution, decision, features, profiling, quality, silver, training
from propense.operators.training import ModelSpec
from propense.sources import export, tables
from propense.sources.tables import TableStore


@dataclass(frozen=True)
class Names:
    """Names of the raw tables, and of the key they share."""

    sales: str = "sales"
    flows: str = "flows"
    balances: str = "balances"
    profile: str = "profile"
    key: str = "client"
    buckets: int = 0  # above 0, silver and prediction tables of a catalog are bucketed on the key


def _raw(store: TableStore, names: Names) -> dict[str, DataFrame]:
    raw = {role: getattr(names, role) for role in ("sales", "flows", "balances", "profile")}
    store.require(*[("bronze", table) for table in raw.values()])
    return {role: store.read("bronze", table) for role, table in raw.items()}


def check(store: TableStore, specs: Iterable[quality.FieldSpec]) -> tuple[DataFrame, dict[str, str]]:
    """Run the rules, keep the results in ``dq.dq_results``; returns their summary and what failed to run."""
    results, failures = quality.run_checks(store.read, specs)
    if results is None:
        raise ValueError(f"no check could run: {failures}")
    store.replace(results, "dq", "dq_results")
    return quality.summary(store.read("dq", "dq_results")), failures


def build_train(store: TableStore, names: Names = Names()) -> int:
    raw = _raw(store, names)
    train = silver.train_table(raw["sales"], [raw["flows"], raw["balances"], raw["profile"]], names.key)
    return store.replace(train, "silver", "train", names.key, names.buckets)


def build_holdout(store: TableStore, names: Names = Names()) -> int:
    raw = _raw(store, names)
    rows = silver.holdout_table(raw["profile"], [raw["balances"], raw["flows"]], raw["sales"], names.key)
    return store.replace(rows, "silver", "test", names.key, names.buckets)


def profile(store: TableStore, layer: str = "silver", table: str = "train") -> None:
    """Numeric and categorical profiles, and the whole distribution of every categorical column."""
    store.require((layer, table))
    df = store.read(layer, table)
    where = {"layer": layer, "table": table}
    numeric = profiling.numeric_profile(df, profile=f"{layer}_{table}_numerical_profile", **where)
    store.replace(numeric, "profile", "numerical_profiling_results")
    columns = profiling.category_columns(df)
    if columns:
        name = f"{layer}_{table}_categorical_profile"
        categorical = profiling.categorical_profile(df, columns, profile=name, **where)
        store.replace(categorical, "profile", "categorical_profiling_results")
        store.replace(profiling.category_distribution(df, columns), "profile", "category_distribution")


def training_rows(store: TableStore, spec: ModelSpec) -> DataFrame:
    """All training rows for a propensity; for a revenue only those of buyers."""
    store.require(("silver", "train"))
    non_zero = spec.target if spec.kind == "revenue" else None
    return tables.scan(store.read("silver", "train"), non_zero=non_zero)


def search(store: TableStore, spec: ModelSpec, table: str | None = None, **options) -> dict[int, str]:
    """Search table, best settings per number of folds, and importances; returns runs that failed."""
    table = table or spec.name
    found = training.search(training_rows(store, spec), spec, **options)
    store.replace(found.runs, "models", table)
    store.replace(training.top_settings(found, spec), "models", f"{table}_top")
    if found.importance is not None:
        store.replace(found.importance, "models", f"{table}_importance")
    return found.errors


def search_top(store: TableStore, spec: ModelSpec, table: str | None = None, n: int = 10, **options) -> dict[int, str]:
    """The search that keeps the n best settings per number of folds, over value ranges of its own."""
    options.setdefault("space", training.SPACES[f"{spec.kind}_top"])
    found = training.search(training_rows(store, spec), spec, **options)
    store.replace(training.top_settings(found, spec, n), "models", f"{table or spec.name}_top_search")
    return found.errors


def best_settings(store: TableStore, spec: ModelSpec, table: str | None = None) -> training.Settings:
    store.require(("models", table or spec.name))
    return training.best_parameters(store.read("models", table or spec.name), spec)


def explain(
    store: TableStore,
    spec: ModelSpec,
    settings: training.Settings | None = None,
    *,
    test_share: float = 0.2,
    sample_size: int | None = attribution.SAMPLE_SIZE,
    background_size: int = attribution.BACKGROUND_SIZE,
) -> DataFrame:
    """Fit on one part of the training rows, test and attribute on the other; returns the metrics."""
    settings = settings or best_settings(store, spec)
    rows = training_rows(store, spec)
    strata = spec.target if spec.kind == "propensity" else None
    train, test = features.split(
        features.drop_missing_target(rows, spec.target), spec.key, test_share, spec.seed, strata
    )
    final = training.fit_final(train, spec, settings, holdout=test)
    detail = attribution.attribute(
        final.model,
        train,
        test,
        spec.key,
        sample_size=sample_size,
        background_size=background_size,
        seed=spec.seed,
    )
    store.replace(detail, "models", f"attribution_{spec.name}_detailed")
    detail = store.read("models", f"attribution_{spec.name}_detailed")
    store.replace(attribution.attribution_summary(detail), "models", f"attribution_{spec.name}_summary")
    return final.metrics


def fit(
    store: TableStore, spec: ModelSpec, model_path: str, settings: training.Settings | None = None
) -> training.FinalModel:
    """Final model of all training rows: files below ``model_path`` and a row of history."""
    settings = settings or best_settings(store, spec)
    final = training.fit_final(training_rows(store, spec), spec, settings)
    training.save_model(final, model_path)
    export.export_json(final.metrics, f"{model_path}/metrics")
    store.append(final.history_row(), "models", f"final_{spec.name}")
    return final


def score(
    store: TableStore, spec: ModelSpec, model_path: str, csv_folder: str | None = None, buckets: int = 0
) -> int:
    """Apply a saved model to ``silver.test``: a prediction table and, if wanted, CSV files."""
    store.require(("silver", "test"), ("models", f"final_{spec.name}"))
    predictors = training.latest_predictors(store.read("models", f"final_{spec.name}"))
    rows = tables.select_available(store.read("silver", "test"), spec.key, predictors)
    model, scaler = training.load_model(store.spark, model_path, scaled=spec.scale_target)
    if spec.kind == "propensity":
        scored = training.score_propensity(model, rows, spec.key)
    else:
        scored = training.score_revenue(model, rows, "predicted_revenue", scaler)
    count = store.replace(scored, "predictions", spec.name, spec.key, buckets)
    if csv_folder:
        export.export_scores(store.read("predictions", spec.name), csv_folder, spec.name)
    return count


def decide(
    store: TableStore,
    products: Mapping[str, tuple[str, str]],
    key: str = "client",
    threshold: float = decision.THRESHOLD,
) -> tuple[DataFrame, DataFrame]:
    """``products``: name -> its propensity and its revenue table. Returns product mix and totals."""
    store.require(*[("predictions", table) for pair in products.values() for table in pair])
    read: dict[str, tuple[DataFrame, DataFrame]] = {
        p: (store.read("predictions", a), store.read("predictions", b)) for p, (a, b) in products.items()
    }
    order: Sequence[str] = list(products)
    combined = decision.expected_revenue(decision.combine_scores(read, key), order, threshold)
    store.replace(combined, "predictions", "combined")
    combined = store.read("predictions", "combined")
    store.replace(decision.best_product(combined, order), "predictions", "optimized_outcome")
    outcome = store.read("predictions", "optimized_outcome")
    return decision.product_mix(outcome).orderBy("count", ascending=False), decision.outcome_totals(outcome)
