"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import lru_cache, reduce
from multiprocessing.pool import ThreadPool
from threading import RLock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propense.functions.columns import ident, rounded
from propense.functions.order import rank_by_hash
from propense.operators import (
    attribution,
    decision,
    features,
    metrics,
    profiling,
    quality,
    training,
)
from propense.plans import checks
from propense.plans.roles import PRODUCTS, Roles
from propense.session import scratch_path, written
from propense.sources import export, ingest, tables

Query = Callable[[SparkSession, str], DataFrame]
PRODUCT_NAMES = list(PRODUCTS)
SWEEP = (0.5, 0.6, 0.71, 0.8, 0.9)


def _combined(roles: Roles) -> DataFrame:
    return decision.expected_revenue(roles.scores, PRODUCT_NAMES)


def _outcome(roles: Roles) -> DataFrame:
    return decision.best_product(_combined(roles), PRODUCT_NAMES)


def _partial_scores(roles: Roles) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Six score tables that each lack some customers: only those in all of them are combined."""
    return {
        p: (chance.where(F.col("client") % 7 != i), revenue.where(F.col("client") % 11 != i))
        for i, (p, (chance, revenue)) in enumerate(roles.score_tables().items())
    }


def _on_roles(build: Callable[[Roles], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Roles(spark, sf_dir))


DECISION = {
    "combine_scores": lambda r: decision.combine_scores(r.score_tables(), "client"),
    "combine_partial_scores": lambda r: decision.combine_scores(_partial_scores(r), "client"),
    "decide_expected_revenue": _combined,
    "best_product": _outcome,
    "best_offers": lambda r: decision.top_offers(_outcome(r), "client"),
    "positive_offers": lambda r: decision.positive_offers(_outcome(r), "client"),
    "top_offer_details": lambda r: decision.top_offer_details(_combined(r), _outcome(r), "client"),
    "product_mix": lambda r: decision.product_mix(_outcome(r)),
    "outcome_totals": lambda r: decision.outcome_totals(_outcome(r)),
    "threshold_sweep": lambda r: decision.threshold_sweep(r.scores, PRODUCT_NAMES, SWEEP),
}

SILVER = {
    "silver_train": lambda r: r.train,
    "silver_holdout": lambda r: r.holdout,
    "silver_sales": lambda r: r.sales,
    "buyers_only": lambda r: tables.scan(r.sales, non_zero="revenue_o"),
    "available_predictors": lambda r: tables.select_available(
        r.holdout, "client", ["acctbal", "bal_o", "not_there"]
    ),
}


class _Stored:
    """Tables as checks read them; roles that are built from each other are built and written once."""

    def __init__(self, roles: Roles, *names: str) -> None:
        self.roles, self.names, self.lock = roles, names, RLock()

    def __call__(self, layer: str, table: str) -> DataFrame:
        if layer != "roles":
            return self.roles.table(table)
        if table not in self.names:
            return getattr(self.roles, table)
        with self.lock:
            # in the order in which they are built from each other
            for name in self.names[: self.names.index(table) + 1]:
                stored = f"_stored_{name}"
                if stored not in self.roles.__dict__:
                    self.roles.__dict__[name] = self.roles.__dict__[stored] = written(getattr(self.roles, name), name)
            return getattr(self.roles, table)


def _quality_results(read, specs, failing: tuple[str, ...] = ()) -> DataFrame:
    results, failures = quality.run_checks(read, specs)
    if set(failures) != set(failing):
        raise ValueError(f"specs that cannot run: {failures}")
    return results.drop("check_timestamp")


def _failing_at_run_time(r: Roles) -> DataFrame:
    """Rules on a column that cannot be computed for some rows: all other checks of the table have results."""
    orders = r.table("orders").withColumn("broken", F.col("o_orderstatus").cast("int"))
    specs = [s for s in checks.raw_specs() if s.table == "orders"]
    broken = [replace(s, name=f"broken_{s.field}", field="broken") for s in specs[:2]]
    specs = [specs[0], broken[0], *specs[1:], broken[1]]
    results, failures = quality.run_checks(lambda _layer, _table: orders, specs)
    columns = ["check_name", "total_records", "records_passed", "records_failed"]
    failed = r.spark.createDataFrame([(n, None, None, None) for n in sorted(failures)], results.select(columns).schema)
    return results.select(columns).union(failed)


def _all_specs():
    return checks.role_specs() + checks.raw_specs()


QUALITY = {
    "dq_all": lambda r: _quality_results(_Stored(r, "sales", "train"), _all_specs()),
    "dq_summary": lambda r: quality.summary(_quality_results(_Stored(r, "sales", "train"), _all_specs())),
    # A spec whose column is not there: all the others run.
    "dq_isolated": lambda r: _quality_results(
        _Stored(r, "sales", "train"),
        [replace(_all_specs()[0], name="absent", field="absent"), *_all_specs()],
        ("absent",),
    ),
    "dq_failing_at_run_time": _failing_at_run_time,
    **{
        name: (lambda r, specs=specs: _quality_results(_Stored(r), specs))
        for name, specs in checks.by_rule().items()
    },
}


TRAIN_CATEGORIES = ["segment", "nation", "sale_o", "sale_f", "sale_p"]
REVENUES = [f"revenue_{p}" for p in PRODUCTS]


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, for statistics whose last bits depend on the order of summation.

    Means of two-decimal values often end exactly half-way; the nudge rounds those one way always.
    """
    return df.select(
        *[
            rounded(ident(f.name) + 1e-8, digits).alias(f.name)
            if f.dataType.typeName() == "double"
            else ident(f.name)
            for f in df.schema.fields
        ]
    )


def _without_ids(df: DataFrame) -> DataFrame:
    return df.drop("name_of_profile", "schema_name", "table_field_name")


def _category_columns(r: Roles) -> DataFrame:
    """Which columns of the training table hold categories."""
    found = profiling.category_columns(r.train)
    return r.spark.createDataFrame([(c,) for c in found], "data_field_name string")


PROFILING = {
    "profile_numeric": lambda r: _rounded(_without_ids(profiling.numeric_profile(written(r.train)))),
    "profile_numeric_lineitem": lambda r: _rounded(
        _without_ids(profiling.numeric_profile(r.table("lineitem")))
    ),
    "profile_categorical": lambda r: _without_ids(
        profiling.categorical_profile(r.train, TRAIN_CATEGORIES)
    ),
    "profile_categorical_orders": lambda r: _without_ids(
        profiling.categorical_profile(r.table("orders"))
    ),
    "category_columns": _category_columns,
    "profile_distributions": lambda r: profiling.category_distribution(written(r.train), TRAIN_CATEGORIES),
    "profile_distributions_customers": lambda r: profiling.category_distribution(r.table("orders"), ["o_custkey"]),
    "category_distribution": lambda r: profiling.category_distribution(r.train, TRAIN_CATEGORIES),
    "category_distribution_events": lambda r: profiling.category_distribution(
        r.table("events"), ["event_type", "props"]
    ),
    "value_counts": lambda r: profiling.value_counts(r.table("orders"), "o_orderpriority"),
    "value_counts_customers": lambda r: profiling.value_counts(r.table("orders"), "o_custkey"),
    "mean_baseline_mae": lambda r: _rounded(profiling.mean_baseline_error(r.sales, REVENUES)),
}


PREDICTORS = ["segment", "acctbal", "volume_click", "txn_click", "volume_view", "txn_view", "bal_f", "count_p"]
NUMBERS = [c for c in PREDICTORS if c != "segment"]


def _buyers(r: Roles) -> DataFrame:
    return tables.scan(r.sales, non_zero="revenue_o")


def _target_roundtrip(r: Roles) -> DataFrame:
    buyers = _buyers(r).select("client", "revenue_o")
    scaler = features.TargetScaler.fit(buyers, "revenue_o")
    scaled = buyers.withColumn("scaled", scaler.scale(F.col("revenue_o")))
    return _rounded(scaled.withColumn("restored", scaler.invert(F.col("scaled"))))


def _quantity_text(r: Roles) -> DataFrame:
    """Quantities as text, unreadable for returned lines."""
    returned = F.col("l_returnflag") == "R"
    text = F.when(returned, F.concat(F.lit("n/a "), "l_quantity")).otherwise(F.col("l_quantity").cast("string"))
    return r.table("lineitem").select("l_orderkey", "l_linenumber", text.alias("quantity"))


def _fold_sizes(r: Roles) -> DataFrame:
    """Rows per class and fold, for 3 to 5 folds dealt out exactly."""
    # One ranking serves all k, as it does in a search.
    ranked = rank_by_hash(r.sales.select("client", "sale_o"), "client", 42, "sale_o")
    ks = F.explode(F.array(*(F.lit(k) for k in (3, 4, 5)))).alias("k")
    folds = ranked.select("sale_o", "shuffled_rank", ks)
    fold = F.pmod("shuffled_rank", F.col("k")).cast("int").alias("fold")
    return folds.groupBy("k", "sale_o", fold).agg(F.count(F.lit(1)).alias("rows"))


def _hash_folds(r: Roles) -> DataFrame:
    """Every order is in exactly one of the k hash folds."""
    folds = features.with_folds(r.table("orders").select("o_orderkey"), "o_orderkey", 5)
    return folds.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((F.col("fold") < 0) | (F.col("fold") >= 5)).alias("outside"),
        F.countDistinct("fold").alias("folds"),
    )


def _split_sizes(r: Roles) -> DataFrame:
    sides = features.with_side(r.sales.select("client", "sale_f"), "client", strata="sale_f")
    return sides.groupBy("side", "sale_f").agg(F.count(F.lit(1)).alias("rows"))


FEATURES = {
    "fill_missing": lambda r: features.fill_missing(r.train, PREDICTORS),
    "drop_missing_target": lambda r: features.drop_missing_target(r.train, "count_o"),
    "class_weight": lambda r: features.class_balance(r.train.select("sale_o"), "sale_o"),
    "row_weights": lambda r: features.with_class_weight(r.sales.select("client", "sale_o"), "sale_o", 2.5),
    "standardize": lambda r: _rounded(
        features.standardize(features.fill_missing(r.train.select("client", *PREDICTORS), PREDICTORS), NUMBERS)
    ),
    "one_hot_drop_first": lambda r: features.one_hot(r.train.select("client", "segment"), "segment"),
    "one_hot_unseen": lambda r: features.one_hot(
        r.profile.select("client", "segment"), "segment", known=["AUTOMOBILE", "BUILDING", "FURNITURE"]
    ),
    "top2_binary_target": lambda r: features.binary_target(
        r.table("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority"
    ),
    "top2_languages": lambda r: features.binary_target(r.table("documents").select("doc_id", "lang"), "lang"),
    "numeric_target": lambda r: features.numeric_target(_quantity_text(r), "quantity"),
    "target_scale_roundtrip": _target_roundtrip,
    "kfold_sizes": _fold_sizes,
    "hash_folds": _hash_folds,
    "split_sizes": _split_sizes,
    "sample_rows": lambda r: features.sample_rows(r.train.select("client", "sale_o"), "client", 1000),
}


def _scored(r: Roles) -> DataFrame:
    """(client, product, label, probability, revenue, predicted) for every campaign client and product."""
    rows = [
        F.struct(
            F.lit(p.upper()).alias("product"),
            F.col(f"sale_{p}").alias("label"),
            F.col(f"{p}_predicted_probability").alias("probability"),
            F.col(f"revenue_{p}").alias("revenue"),
            (F.col(f"{p}_predicted_revenue") * 200.0).alias("predicted"),
        )
        for p in PRODUCTS
    ]
    return r.sales.join(r.scores, "client").select("client", F.inline(F.array(*rows)))


METRICS = {
    "classification_metrics": lambda r: _rounded(
        metrics.classification_metrics(_scored(r), "label", "probability", ["product"], cutoff=0.4)
    ),
    "roc_auc": lambda r: _rounded(
        metrics.roc_auc(_scored(r).where("product = 'O'"), "label", "probability")
    ),
    "roc_auc_products": lambda r: _rounded(metrics.roc_auc(_scored(r), "label", "probability", ["product"])),
    "regression_metrics": lambda r: _rounded(
        metrics.regression_metrics(_scored(r).where("revenue <> 0"), "revenue", "predicted", ["product"]),
        digits=3,  # a squared error of 10^8 has no more digits than that to compare
    ),
    "score_distribution": lambda r: _rounded(
        metrics.score_distribution(_scored(r), "probability", ["product"], cutoff=0.4)
    ),
}


# The ranges of a search, but for the number of trees: a tree costs the learner a dozen short jobs, so
# that the hundreds of the full ranges take hours. README has the measured times.
LENGTHS = [3, 6]


def _space(name: str) -> dict[str, list]:
    return {**training.SPACES[name], "n_estimators": LENGTHS}


FIXED_SETTINGS = {"max_depth": 3, "n_estimators": 4, "learning_rate": 0.3}


def _propensity_spec(p: str = "o") -> training.ModelSpec:
    """Predictors leave out what defines the target: the count and value of the same product."""
    others = tuple(f"{c}_{q}" for q in PRODUCTS if q != p for c in ("count", "bal"))
    predictors = ("segment", "acctbal", "volume_click", "txn_view", *others)
    return training.ModelSpec(f"propensity_{p}", "propensity", f"sale_{p}", "client", predictors, ("segment",))


def _revenue_spec(p: str = "o") -> training.ModelSpec:
    predictors = ("segment", "acctbal", f"bal_{p}", f"count_{p}", "volume_purchase")
    return training.ModelSpec(
        f"revenue_{p}", "revenue", f"revenue_{p}", "client", predictors, ("segment",), scale_target=True
    )


def _train_buyers(r: Roles) -> DataFrame:
    return tables.scan(r.train, non_zero="revenue_o")


@lru_cache(maxsize=16)
def _searched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table, written once for the searches of both kinds."""
    return written(Roles(spark, sf_dir).train)


@lru_cache(maxsize=16)
def _search(spark: SparkSession, sf_dir: str, kind: str, product: str, space: str, runs: int) -> training.SearchResult:
    """Runs for each of 3, 4 and 5 folds, kept for the queries that ask for different sides of a search."""
    train = _searched_rows(spark, sf_dir)
    if kind == "propensity":
        spec, rows = _propensity_spec(product), train
    else:
        spec, rows = _revenue_spec(product), tables.scan(train, non_zero=f"revenue_{product}")
    return training.search(rows, spec, space=_space(space), runs_per_k=runs, n_iter=2, parallelism=8, staged=True, importance=kind == "revenue")


def _runs(kind: str, space: str | None = None, runs: int = 2) -> Callable[[Roles], training.SearchResult]:
    return lambda r: _search(r.spark, r.sf_dir, kind, "o", space or kind, runs)


def _best_parameters(r: Roles) -> DataFrame:
    best = training.best_parameters(_runs("propensity")(r).runs, _propensity_spec())
    return r.spark.createDataFrame([tuple(map(float, best.values()))], [*best])


def _best_run(r: Roles) -> DataFrame:
    """The product whose scores rank its buyers best."""
    auc = metrics.roc_auc(_scored(r), "label", "probability", ["product"])
    return _rounded(auc.orderBy(F.desc("auc_score"), "product").limit(1))


def _trials(r: Roles) -> DataFrame:
    """A table of tried settings derived from the customers: many runs, ties and repeated settings."""
    c = F.col("c_custkey")
    return r.table("customer").select(
        (c % 12).cast("int").alias("iteration_id"),
        F.floor(c / 12).cast("int").alias("setting"),
        (3 + c % 12 % 3).cast("int").alias("k_folds"),
        (3 + c % 5).cast("int").alias("max_depth"),
        (1 + c % 7).cast("int").alias("min_child_weight"),
        (100 * (1 + c % 3)).cast("int").alias("n_estimators"),
        (F.floor(F.abs("c_acctbal") / 1000).cast("double") / 10).alias("auc_score"),
    )


def _ranked_settings(r: Roles) -> DataFrame:
    found = training.SearchResult(runs=_trials(r), settings=_trials(r))
    return training.top_settings(found, _propensity_spec(), 7).drop("iteration_id")


def _best_of_trials(r: Roles) -> DataFrame:
    best = training.best_parameters(_trials(r), _propensity_spec())
    return r.spark.createDataFrame([tuple(map(int, best.values()))], ", ".join(f"{c} long" for c in best))


def _ranked_importances(r: Roles) -> DataFrame:
    """Importances derived from sums of orders by status and priority, ranked within each status."""
    rows = r.table("orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select(
        F.ascii("o_orderstatus").alias("iteration_id"),
        F.col("o_orderpriority").alias("feature_name"),
        F.floor(F.col("n") / 50).cast("double").alias("feature_importance"),
        F.lit(0.0).alias("explained_variance"),
    )
    return training.rank_importance(rows).drop("explained_variance")


def _attribution_table(r: Roles) -> DataFrame:
    """Mean absolute contribution by feature, over rows derived from the order lines."""
    parts = {"quantity": "l_quantity - 25", "forward": "l_linenumber - 3", "backward": "3 - l_linenumber"}
    detail = r.table("lineitem").select(
        F.inline(F.array(*(F.struct(F.lit(n).alias("feature_name"), F.expr(e).cast("double").alias("contribution")) for n, e in parts.items())))
    )
    return _rounded(attribution.attribution_summary(detail), 4)


def _latest_model(r: Roles) -> DataFrame:
    """Predictors of the newest row of a history derived from the orders of the nations."""
    history = r.table("orders").groupBy("o_orderpriority").agg(F.max("o_orderkey").alias("last")).select(
        F.col("last").cast("string").alias("key"),
        F.format_string("%020d", "last").alias("model_timestamp"),
        F.concat_ws(" , ", F.lit("a"), "o_orderpriority", F.lit("z")).alias("predictive_variables"),
    )
    names = training.latest_predictors(history)
    return r.spark.createDataFrame([(i, n) for i, n in enumerate(names)], "place long, name string")


def _score_facts(r: Roles) -> DataFrame:
    """Rows scored, and rows whose key, probability or class is not as it must be."""
    scored = _score_propensity(r)
    p = F.col("predicted_probability")
    wrong = F.col("client").isNull() | ~p.between(0.0, 1.0) | ((p > 0.5).cast("int") != F.col("predicted_class"))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("client").alias("clients"), F.count_if(wrong).alias("wrong")
    )


def _attribution_facts(r: Roles) -> DataFrame:
    """Rows explained, features of each, and rows whose contributions do not add up to their margin."""
    detail = _attribution(r, _propensity_spec(), r.train)
    by_row = detail.groupBy("instance_id").agg(
        F.count(F.lit(1)).alias("features"),
        (F.abs(F.sum("contribution") + F.first("base_value") - F.first("margin")) > 1e-9).alias("off"),
    )
    return by_row.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("features").alias("least"),
        F.max("features").alias("most"),
        F.count_if("off").alias("off"),
    )


def _fit_facts(r: Roles) -> DataFrame:
    """What a final fit must say of its rows, for all three products: class counts and the matrix's sums."""
    found = []
    for p in PRODUCTS:
        m = training.fit_final(r.train, _propensity_spec(p), FIXED_SETTINGS).metrics
        found.append(
            m.select(
                F.lit(p).alias("product"),
                "positive_class_count",
                "negative_class_count",
                (F.col("true_positives") + F.col("false_negatives")).alias("positives"),
                (F.col("true_negatives") + F.col("false_positives")).alias("negatives"),
                F.col("training_samples").cast("long").alias("training_samples"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def _history(r: Roles) -> DataFrame:
    """Two final models in a history table, written to shared storage and read back."""
    store = tables.TableStore(r.spark, scratch_path(r.spark, "history"))
    for spec in (_propensity_spec("o"), _propensity_spec("f")):
        final = training.fit_final(r.train, spec, FIXED_SETTINGS)
        store.append(final.history_row(), "models", "final_propensity")
    history = store.read("models", "final_propensity")
    names = training.latest_predictors(history)
    return history.withColumn("latest_predictors", F.lit(",".join(names)))


def _explain_metrics(r: Roles) -> DataFrame:
    """Metrics of the training part and of the held-out part of a stratified split."""
    spec = _propensity_spec()
    train, test = features.split(r.train, spec.key, 0.2, spec.seed, strata=spec.target)
    final = training.fit_final(train, spec, FIXED_SETTINGS, holdout=test)
    return final.metrics.drop("training_time_seconds")


def _score_propensity(r: Roles) -> DataFrame:
    final = training.fit_final(r.train, _propensity_spec(), FIXED_SETTINGS)
    return training.score_propensity(final.model, r.holdout, "client").drop("prediction_timestamp")


def _score_revenue(r: Roles) -> DataFrame:
    """Fit, save, load and apply, as the scoring stage does."""
    final = training.fit_final(_train_buyers(r), _revenue_spec(), FIXED_SETTINGS)
    path = scratch_path(r.spark, "model")
    training.save_model(final, path)
    model, scaler = training.load_model(r.spark, path, scaled=True)
    return training.score_revenue(model, r.holdout, "predicted_revenue_o", scaler)


def _attribution(r: Roles, spec: training.ModelSpec, df: DataFrame, **more) -> DataFrame:
    final = training.fit_final(df, spec, FIXED_SETTINGS)
    return attribution.attribute(final.model, df, r.holdout, "client", **more)


# Models of one categorical predictor, whose trees part all categories: what they predict has a closed form.
EXACT_SETTINGS = {"max_depth": 5, "n_estimators": 50, "learning_rate": 0.1}


def _exact_spec(kind: str, p: str, predictor: str = "segment") -> training.ModelSpec:
    target = f"sale_{p}" if kind == "propensity" else f"revenue_{p}"
    categorical = (predictor,) if predictor == "segment" else ()
    return training.ModelSpec(f"exact_{p}", kind, target, "client", (predictor,), categorical, scale_target=kind == "revenue")


@lru_cache(maxsize=16)
def _exact_models(spark: SparkSession, sf_dir: str, kind: str, predictor: str = "segment") -> dict[str, training.FinalModel]:
    """A model per product, fitted side by side and kept for the queries that use them."""
    train = written(Roles(spark, sf_dir).train)

    def fit(p: str) -> training.FinalModel:
        rows = train if kind == "propensity" else tables.scan(train, non_zero=f"revenue_{p}")
        return training.fit_final(rows, _exact_spec(kind, p, predictor), EXACT_SETTINGS, fits=len(PRODUCTS))

    with ThreadPool(len(PRODUCTS)) as pool:
        return dict(zip(PRODUCTS, pool.map(inheritable_thread_target(spark)(fit), PRODUCTS, chunksize=1)))


def _exact_propensity(r: Roles) -> DataFrame:
    """Probability and class of every holdout client for every product, after 50 trees."""
    scored = [
        training.score_propensity(final.model, r.holdout, "client").select(
            "client", F.lit(p).alias("product"), "predicted_probability", "predicted_class"
        )
        for p, final in _exact_models(r.spark, r.sf_dir, "propensity").items()
    ]
    return _rounded(reduce(DataFrame.unionByName, scored))


def _exact_metrics(r: Roles) -> DataFrame:
    """Metrics of the training rows, and the history row's names and settings."""
    names = "response_variable predictive_variables auc_score accuracy precision recall f1_score true_positives false_positives".split()
    names += ["training_samples", "param_max_depth", "param_n_estimators", "param_learning_rate", "param_gamma"]
    found = []
    for final in _exact_models(r.spark, r.sf_dir, "propensity").values():
        # by way of a table, as history is read back
        path = tables.TableStore(r.spark, scratch_path(r.spark, "history"))
        path.append(final.history_row(), "models", "final")
        history = path.read("models", "final").select(*names)
        found.append(history.withColumn("training_samples", F.col("training_samples").cast("long")))
    return _rounded(reduce(DataFrame.unionByName, found))


def _exact_revenue(r: Roles) -> DataFrame:
    """Revenue of every holdout client for every product, saved, loaded and back on the target's own scale."""
    holdout = r.holdout

    def score(item: tuple[str, training.FinalModel]) -> DataFrame:
        path = scratch_path(r.spark, "model")
        training.save_model(item[1], path)
        model, scaler = training.load_model(r.spark, path, scaled=True)
        rows = training.score_revenue(model, holdout, "predicted_revenue", scaler)
        return rows.select("client", F.lit(item[0]).alias("product"), "predicted_revenue")

    models = _exact_models(r.spark, r.sf_dir, "revenue")
    with ThreadPool(len(models)) as pool:
        scored = pool.map(inheritable_thread_target(r.spark)(score), models.items(), chunksize=1)
    return _rounded(reduce(DataFrame.unionByName, scored), 3)


def _exact_attribution(r: Roles) -> DataFrame:
    """Every training client's contribution of the one predictor, for every product."""
    train = written(r.train)
    parts = []
    for p, final in _exact_models(r.spark, r.sf_dir, "propensity", "sale_f").items():
        detail = attribution.attribute(final.model, train, train, "client")
        parts.append(detail.withColumn("product", F.lit(p)))
    return _rounded(reduce(DataFrame.unionByName, parts))


def _search_facts(r: Roles) -> DataFrame:
    """What a search must hold, by kind: runs, folds, settings, lengths, and runs that do not keep their best setting."""
    found = []
    for kind in ("propensity", "revenue"):
        result = _runs(kind)(r)
        score = training.SCORE[kind]
        best = F.max(score) if kind == "propensity" else F.min(score)
        best = result.settings.groupBy("iteration_id").agg(best.alias("best"))
        runs = result.runs.join(best, "iteration_id")
        facts = runs.agg(
            F.lit(kind).alias("kind"),
            F.count(F.lit(1)).alias("runs"),
            F.countDistinct("k_folds").alias("folds"),
            F.count_if(F.col(score) != F.col("best")).alias("not_best"),
        )
        sizes = result.settings.agg(F.count(F.lit(1)).alias("settings"), F.countDistinct("n_estimators").alias("lengths"))
        found.append(facts.join(F.broadcast(sizes)))
    return reduce(DataFrame.unionByName, found)


def _model_facts(r: Roles) -> DataFrame:
    """The models of all predictors, by product: their metrics against the scores themselves, and a mean's.

    The area under the curve is counted anew by pairs of rows, the error by rows; a model that learns nothing
    is no better than chance or than the mean.
    """
    train = written(r.train)

    def facts(p: str) -> list:
        final = training.fit_final(train, _propensity_spec(p), FIXED_SETTINGS)
        scores = training.score_propensity(final.model, train, "client").join(train.select("client", f"sale_{p}"), "client")
        counts = scores.groupBy("predicted_probability").agg(
            F.count_if(F.col(f"sale_{p}") == 1).alias("pos"), F.count_if(F.col(f"sale_{p}") == 0).alias("neg")
        )
        high, low = counts.where("pos > 0").alias("high"), counts.where("neg > 0").alias("low")
        right = F.when(F.col("high.predicted_probability") > F.col("low.predicted_probability"), 1.0).when(
            F.col("high.predicted_probability") == F.col("low.predicted_probability"), 0.5
        )
        pairs = F.col("high.pos") * F.col("low.neg")
        auc = high.join(low, F.col("high.predicted_probability") >= F.col("low.predicted_probability")).agg(F.sum(right * pairs)).first()[0]
        row = final.metrics.first()
        all_pairs = row["positive_class_count"] * row["negative_class_count"]
        buyers = tables.scan(train, non_zero=f"revenue_{p}")
        revenue = training.fit_final(buyers, _revenue_spec(p), FIXED_SETTINGS)
        predicted = training.score_revenue(revenue.model, buyers, "predicted", revenue.scaler)
        target = F.col(f"revenue_{p}")
        mean = buyers.agg(F.avg(target)).first()[0]
        errors = predicted.agg(F.avg(F.abs(target - F.col("predicted"))), F.avg(F.abs(target - mean))).first()
        tested = revenue.metrics.first()
        return [
            p,
            scores.count(),
            row["positive_class_count"],
            abs(row["auc_score"] - auc / all_pairs) < 1e-9,
            row["auc_score"] > 0.5,
            tested["samples"],
            round(tested["mean_actual"] + 1e-8, 3),
            abs(tested["mae"] - errors[0]) < 1e-6 * errors[0],
            errors[0] < errors[1],
        ]

    with ThreadPool(len(PRODUCTS)) as pool:
        rows = pool.map(inheritable_thread_target(r.spark)(facts), PRODUCTS, chunksize=1)
    columns = "product string, scored long, positives long, auc_agrees boolean, auc_above_chance boolean, buyers long, "
    columns += "mean_actual double, mae_agrees boolean, mae_below_mean boolean"
    return r.spark.createDataFrame(rows, columns)


MODELS = {
    "search_propensity": lambda r: _runs("propensity")(r).runs,
    "search_revenue": lambda r: _runs("revenue")(r).runs,
    "search_facts": _search_facts,
    "top_settings": lambda r: training.top_settings(_runs("propensity")(r), _propensity_spec(), 2),
    "search_top": lambda r: training.top_settings(_runs("propensity", "propensity_top", 1)(r), _propensity_spec(), 3),
    "feature_importance": lambda r: _runs("revenue")(r).importance,
    "exact_propensity": _exact_propensity,
    "exact_metrics": _exact_metrics,
    "exact_revenue": _exact_revenue,
    "exact_attribution": _exact_attribution,
    "model_facts": _model_facts,
    "best_params": _best_parameters,
    "best_run": _best_run,
    "ranked_settings": _ranked_settings,
    "best_of_trials": _best_of_trials,
    "ranked_importances": _ranked_importances,
    "attribution_table": _attribution_table,
    "latest_model": _latest_model,
    "score_facts": _score_facts,
    "attribution_facts": _attribution_facts,
    "fit_facts": _fit_facts,
    "fit_final_propensity": lambda r: training.fit_final(r.train, _propensity_spec(), FIXED_SETTINGS)
    .metrics.drop("training_time_seconds"),
    "fit_final_revenue": lambda r: training.fit_final(_train_buyers(r), _revenue_spec(), FIXED_SETTINGS)
    .metrics.drop("training_time_seconds"),
    "explain_metrics": _explain_metrics,
    "model_history": lambda r: _history(r).drop("model_timestamp", "training_time_seconds"),
    "score_propensity": _score_propensity,
    "score_revenue": _score_revenue,
    "attribution_detail": lambda r: _attribution(r, _propensity_spec(), r.train),
    "attribution_all_rows": lambda r: _attribution(r, _revenue_spec(), _train_buyers(r), sample_size=None),
    "attribution_summary": lambda r: attribution.attribution_summary(
        _attribution(r, _propensity_spec(), r.train)
    ),
}


SHEETS = ("customer", "orders", "nation", "region", "supplier")


def _sheet_jobs(r: Roles, root: str) -> list[ingest.IngestJob]:
    """All columns of the raw tables as text sheets, and the jobs that load them."""
    jobs = []
    for name in SHEETS:
        df = r.table(name)
        export.export_csv(df, f"{root}/raw", f"{name}.csv")
        options = {"multiLine": "true"}
        jobs.append(
            ingest.IngestJob(f"{name}_ingestion", "bronze", name, f"{root}/raw", name, schema=df.schema, options=options)
        )
    return jobs


def _ingest(r: Roles) -> DataFrame:
    """Export the raw tables as text sheets, then ingest them by job file; one job fails on purpose."""
    root = scratch_path(r.spark, "ingest")
    jobs = _sheet_jobs(r, root)
    jobs.insert(1, ingest.IngestJob("absent_ingestion", "bronze", "absent", f"{root}/raw", "absent"))
    store = tables.TableStore(r.spark, f"{root}/lake")
    status = ingest.run_jobs(store, jobs)
    store.require(*[("bronze", name) for name in SHEETS])
    return status.select("job", "layer", "table", "status", "rows", "rejected")


def _ingested_sheet(name: str) -> Query:
    """A table as it is after its way through a sheet: every column, every value."""

    def run(r: Roles) -> DataFrame:
        root = scratch_path(r.spark, "sheets")
        store = tables.TableStore(r.spark, f"{root}/lake")
        jobs = [job for job in _sheet_jobs(r, root) if job.table == name]
        ingest.run_jobs(store, jobs)
        return store.read("bronze", name)

    return run


def _torn_sheet(r: Roles) -> DataFrame:
    """Orders whose sheet has odd cells: those rows are rejected by place, the others are in the table."""
    root = scratch_path(r.spark, "torn")
    odd = F.when(F.col("o_orderkey") % 100 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    sheet = r.table("orders").select("o_orderkey", odd.alias("o_totalprice"), "o_orderstatus")
    export.export_csv(sheet, f"{root}/raw", "orders.csv")
    job = ingest.IngestJob("torn", "bronze", "orders", f"{root}/raw", "orders", schema="o_orderkey long, o_totalprice double, o_orderstatus string")
    store = tables.TableStore(r.spark, f"{root}/lake")
    ingest.run_jobs(store, [job])
    kept = store.read("bronze", "orders").select("o_orderkey", F.lit(None).cast("string").alias("reason"))
    rejected = store.read("bronze", ingest.rejects_table("orders"))
    key = F.get_json_object("text", "$.o_orderkey").cast("long")
    return kept.union(rejected.select(key.alias("o_orderkey"), "reason"))


def _ingested_orders(r: Roles) -> DataFrame:
    root = scratch_path(r.spark, "orders")
    export.export_json(r.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), f"{root}/raw")
    store = tables.TableStore(r.spark, f"{root}/lake")
    schema = "o_orderkey long, o_custkey long, o_totalprice double"
    job = ingest.IngestJob("orders", "bronze", "orders", f"{root}/raw", format="json", schema=schema)
    ingest.run_jobs(store, [job])
    return store.read("bronze", "orders")


def _replaced_from_itself(r: Roles) -> DataFrame:
    """A path table that is replaced from itself, appended to by rows with one more column, and left by a failing write."""
    store = tables.TableStore(r.spark, scratch_path(r.spark, "versions"))
    orders = r.table("orders").select("o_orderkey", "o_orderstatus")
    store.replace(orders, "bronze", "orders")
    store.replace(store.read("bronze", "orders").where("o_orderstatus <> 'P'"), "bronze", "orders")
    late = r.table("orders").where("o_orderstatus = 'P'").select("o_orderkey", F.col("o_orderpriority").alias("priority"))
    store.append(late, "bronze", "orders")
    broken = r.table("orders").selectExpr("o_orderkey", "CAST(o_orderpriority AS INT) AS n")
    try:
        store.replace(broken, "bronze", "orders")
    except Exception:  # noqa: BLE001 - the table stays as it was
        return store.read("bronze", "orders")
    raise ValueError("the broken rows were written")


def _sql_with_repeats(r: Roles) -> DataFrame:
    r.train.createOrReplaceTempView("silver_train")
    text = "SELECT sale_o, count_f, * FROM silver_train WHERE sale_o = 1"
    return export.run_sql(r.spark, text).query


def _sql_status(r: Roles) -> DataFrame:
    """A query that works is exported as CSV and read back; one that fails reports its status."""
    r.table("orders").createOrReplaceTempView("raw_orders")
    good = export.run_sql(
        r.spark,
        "SELECT o_orderstatus, count(*) AS n FROM raw_orders GROUP BY o_orderstatus",
    )
    bad = export.run_sql(r.spark, "SELECT missing_column FROM raw_orders")
    path = export.save_result(good, scratch_path(r.spark, "queried"), "by_status")
    back = r.spark.read.option("header", "true").schema("o_orderstatus string, n long").csv(path)
    return back.withColumns({"good_status": F.lit(good.status), "bad_status": F.lit(bad.status)})


FILES = {
    "ingest_jobs": _ingest,
    "ingested_orders": _ingested_orders,
    "ingested_sheet_orders": _ingested_sheet("orders"),
    "ingested_sheet_customer": _ingested_sheet("customer"),
    "torn_sheet": _torn_sheet,
    "replaced_from_itself": _replaced_from_itself,
    "sql_with_repeats": _sql_with_repeats,
    "sql_status": _sql_status,
}


def queries() -> dict[str, Query]:
    groups = (DECISION, SILVER, QUALITY, PROFILING, FEATURES, METRICS, MODELS, FILES)
    return {name: _on_roles(build) for group in groups for name, build in group.items()}
