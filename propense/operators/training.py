"""Search, fit, keep and apply boosted-tree models: propensity (0/1) and revenue (absolute error).

Rows stay on the executors throughout. The driver holds settings, fitted parameters and scores.
"""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propense.functions.columns import ident, require_columns
from propense.functions.order import rank_by_hash
from propense.operators import features as prep
from propense.operators import metrics
from propense.operators.attribution import leaf_values
from propense.session import written
from propense.sources.export import iso_now, join_names, split_names

Settings = dict[str, float]
SCORE = {"propensity": "auc_score", "revenue": "mae_score"}


def _steps(first: float, step: float, count: int) -> list[float]:
    return [round(first + i * step, 10) for i in range(count)]


def _between(first: float, last: float, count: int) -> list[float]:
    return [first + (last - first) * i / (count - 1) for i in range(count)]


# The values each parameter is searched over, for the two kinds of model, in the wide
# search and in the one that keeps the top settings per number of folds.
SPACES: dict[str, dict[str, list]] = {
    "propensity": {
        "max_depth": list(range(3, 11)),
        "min_child_weight": list(range(1, 26)),
        "gamma": _between(0, 10, 21),
        "colsample_bytree": _between(0.5, 0.8, 4),
        "learning_rate": _steps(0.05, 0.05, 6),
        "n_estimators": [100, 200, 300, 500, 700, 1000, 1500, 2000],
    },
    "propensity_top": {
        "max_depth": list(range(3, 26)),
        "min_child_weight": list(range(1, 6)),
        "gamma": _between(0, 6, 100),
        "colsample_bytree": _between(0.4, 0.7, 4),
        "learning_rate": _steps(0.05, 0.01, 11),
        "n_estimators": list(range(100, 1100, 100)),
    },
    "revenue": {
        "max_depth": list(range(3, 15)),
        "min_child_weight": list(range(1, 11)),
        "gamma": _between(0, 2, 21),
        "colsample_bytree": _between(0.6, 1.0, 5),
        "learning_rate": _steps(0.01, 0.02, 15),
        "n_estimators": [50, 100, 200, 300, 500, 1000],
    },
    "revenue_top": {
        "max_depth": list(range(3, 15)),
        "min_child_weight": list(range(1, 6)),
        "gamma": _between(0, 2, 21),
        "colsample_bytree": _between(0.7, 1.0, 6),
        "learning_rate": _steps(0.01, 0.02, 15),
        "n_estimators": [100, 200, 300, 500, 1000, 2000],
    },
}
# The number of trees. A longer ensemble begins with the trees of a shorter one.
LENGTH = "n_estimators"
DEFAULT_LENGTH = 20
INTEGER_SETTINGS = ("max_depth", "min_child_weight", LENGTH)
# Candidate splits per numeric predictor (the learner bins values; its own default would be 32).
MAX_BINS = 256
# Rows below which a part of the training data is not worth a task of its own, and rows it has at most.
ROWS_OF_A_PART, MOST_ROWS_OF_A_PART = 20_000, 500_000
# Levels of trees that are small enough to be sent to every task.
SHALLOW = 10
# Settings a history row always has a column for.
KNOWN_SETTINGS = tuple(dict.fromkeys([*(n for s in SPACES.values() for n in s), "max_bins", "scale_pos_weight"]))


@dataclass(frozen=True)
class ModelSpec:
    """What to predict, and from what. Each product has a spec of its own."""

    name: str
    kind: str  # "propensity" or "revenue"
    target: str
    key: str
    predictors: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    seed: int = 42
    scale_target: bool = False
    std: str = "population"

    def __post_init__(self) -> None:
        if self.kind not in SCORE:
            raise ValueError(f"kind must be one of {sorted(SCORE)}, not '{self.kind}'")
        unknown = set(self.categorical) - set(self.predictors)
        if unknown:
            raise ValueError(f"categorical columns are not among the predictors: {sorted(unknown)}")

    @property
    def features(self) -> prep.FeaturePrep:
        return prep.FeaturePrep(self.predictors, self.categorical, self.std)


@dataclass
class TrainingSet:
    """Rows ready to train on: key, predictors, ``label`` and, for a propensity, ``weight``."""

    rows: DataFrame
    count: int
    classes: list | None = None
    class_weight: float | None = None
    scaler: prep.TargetScaler | None = None


def _known_targets(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """The columns of the model, in rows whose target is known."""
    require_columns(df, [spec.key, spec.target, *spec.predictors])
    columns = dict.fromkeys([spec.key, *spec.predictors, spec.target])
    rows = prep.drop_missing_target(df.select(*[ident(c) for c in columns]), spec.target)
    return rows if spec.kind == "propensity" else prep.numeric_target(rows, spec.target)


def _labelled(rows: DataFrame, spec: ModelSpec, classes: list | None, scaler) -> DataFrame:
    if spec.kind == "propensity":
        return prep.label_classes(rows, spec.target, classes)
    target = ident(spec.target).cast("double")
    return rows.withColumn("label", scaler.scale(target) if scaler else target)


def training_set(df: DataFrame, spec: ModelSpec) -> TrainingSet:
    """Select, clean and label the rows, and write them out once.

    Boosting rereads its input hundreds of times; the written rows spare it the joins behind the table,
    also when an executor is lost.
    """
    rows = written(_known_targets(df, spec), "training")
    if spec.kind == "propensity":
        classes = prep.binary_classes(rows, spec.target)
        rows = _labelled(rows, spec, classes, None)
        balance = prep.class_balance(rows, "label").first()
        rows = prep.with_class_weight(rows, "label", balance["class_weight"])
        return TrainingSet(rows, sum(balance[:2]), classes, balance["class_weight"])
    scaler = prep.TargetScaler.fit(rows, spec.target) if spec.scale_target else None
    return TrainingSet(_labelled(rows, spec, None, scaler), rows.count(), scaler=scaler)


def draw_settings(space: Mapping[str, Sequence], n: int, seed: int, staged: bool = False) -> list[Settings]:
    """n different settings drawn at random (all of them, where the space has no more).

    ``staged`` draws settings without a number of trees, and takes each of them with all numbers there are:
    those share a fit.
    """
    if staged and LENGTH in space:
        lengths = sorted(space[LENGTH])
        rest = {name: options for name, options in space.items() if name != LENGTH}
        bases = draw_settings(rest, -(-n // len(lengths)), seed)
        return [{name: b.get(name, length) for name in space} for b in bases for length in lengths][:n]
    size = reduce(lambda a, b: a * len(b), space.values(), 1)
    rng = random.Random(seed)
    drawn: dict[tuple, None] = {}
    for place in rng.sample(range(size), min(n, size)):
        values = []
        for options in space.values():
            place, i = divmod(place, len(options))
            values.append(options[i])
        drawn[tuple(values)] = None
    return [dict(zip(space, values)) for values in drawn]


def _length(settings: Settings) -> int:
    return int(settings.get(LENGTH, DEFAULT_LENGTH))


def estimator(spec: ModelSpec, settings: Settings, rows: int):
    """The tree learner for some settings.

    ``gamma`` is a loss reduction over all rows, the learner's minimum gain one per row, hence the
    division. Column sampling is per node here. Penalties on leaf weights have no counterpart.
    """
    shared = dict(
        featuresCol="features",
        labelCol="label",
        seed=spec.seed,
        maxDepth=int(settings.get("max_depth", 5)),
        maxIter=_length(settings),
        stepSize=float(settings.get("learning_rate", 0.1)),
        minInstancesPerNode=int(settings.get("min_child_weight", 1)),
        minInfoGain=float(settings.get("gamma", 0.0)) / max(rows, 1),
        featureSubsetStrategy=str(float(settings.get("colsample_bytree", 1.0))),
        maxBins=int(settings.get("max_bins", MAX_BINS)),
        # In deep trees rows keep the node they are in, so that no level sends the whole tree to its tasks; the
        # checkpoints in spark.checkpoint.dir cut the lineage of those assignments. Shallow fits take longer so.
        cacheNodeIds=int(settings.get("max_depth", 5)) > SHALLOW,
        checkpointInterval=10,
    )
    if spec.kind == "propensity":
        return GBTClassifier(weightCol="weight", **shared)
    return GBTRegressor(lossType="absolute", **shared)


def _score(scored: DataFrame, spec: ModelSpec, scale: float) -> float:
    """Exact area under the ROC curve, or the mean absolute error on the target's own scale."""
    if spec.kind == "propensity":
        scored = scored.select("label", _probability().alias("probability"))
        return metrics.roc_auc(scored, "label", "probability").first()["auc_score"]
    return scored.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0] * scale


def _staged(model, lengths: Sequence[int], column: str):
    """The margins of the first trees, for several numbers of them: an array beside the leaves of ``column``.

    The table of leaf values is as large as the model; a copy goes to every executor. Leaves and margins stay
    Arrow columns; no row becomes an object.
    """
    values = leaf_values(model)
    table = np.zeros((len(values), max(map(len, values))))
    for k, tree in enumerate(values):
        table[k, : len(tree)] = tree
    sent = SparkSession.active().sparkContext.broadcast(table)
    stops = np.minimum(np.array(lengths), len(values)) - 1

    def margins(leaves: pa.Array) -> pa.Array:
        table = sent.value
        trees = np.arange(len(table))
        out = [np.zeros((0, len(stops)))]
        for k in range(0, len(leaves), 1024):
            places = leaves.slice(k, 1024).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            out.append(table[trees, places.reshape(-1, len(table))].cumsum(axis=1)[:, stops])
        ends = np.arange(0, len(leaves) * len(stops) + 1, len(stops), dtype=np.int32)
        return pa.ListArray.from_arrays(ends, np.concatenate(out).ravel())

    # annotations that are text cannot be resolved in a task's copy of the function
    margins.__annotations__ = {"leaves": pa.Array, "return": pa.Array}
    return F.arrow_udf(margins, "array<double>")(vector_to_array(column))


def staged_scores(
    train: DataFrame, test: DataFrame, spec: ModelSpec, settings: Settings, lengths: Sequence[int], rows: int, scale: float = 1.0
) -> dict[int, float]:
    """Scores on ``test`` of one fit on ``train`` for several numbers of trees, in one pass over the test rows.

    Boosting adds tree by tree, so the first of a longer ensemble are the shorter one. Scores are exact.
    """
    lengths = sorted(set(lengths))
    learner = estimator(spec, {**settings, LENGTH: lengths[-1]}, rows)
    if len(lengths) == 1:
        return {lengths[0]: _score(learner.fit(train).transform(test), spec, scale)}
    model = learner.setParams(leafCol="_leaf").fit(train)
    scored = model.transform(test).select("label", _staged(model, lengths, "_leaf").alias("margins"))
    if spec.kind == "revenue":
        errors = [F.avg(F.abs(F.col("label") - F.get("margins", F.lit(k)))) for k in range(len(lengths))]
        return {n: error * scale for n, error in zip(lengths, scored.agg(*errors).first())}
    each = scored.select("label", F.posexplode("margins").alias("stage", "margin"))
    chance = 1.0 / (1.0 + F.exp(-2.0 * F.col("margin")))
    found = metrics.roc_auc(each.withColumn("probability", chance), "label", "probability", ["stage"]).collect()
    return {lengths[r["stage"]]: r["auc_score"] for r in found}


def _parts(spark: SparkSession, rows: int, fits: int = 1) -> int:
    """Parts of the rows of each of ``fits`` fits that go side by side.

    Every part of every level costs a histogram per open node, to be filled, sent and merged, however few rows
    it has. So there are no more parts than it takes to keep all cores busy, unless these were too large.
    """
    cores = -(-spark.sparkContext.defaultParallelism // fits)
    return max(1, min(-(-rows // ROWS_OF_A_PART), cores), -(-rows // MOST_ROWS_OF_A_PART))


@contextmanager
def _prepared(spec: ModelSpec, rows: int, train: DataFrame, *others: DataFrame, fits: int = 1):
    """Preparation fitted on ``train``, and the prepared frames, kept while they are worked on.

    Boosting runs many short jobs over the training part, so it is kept in few parts; ``fits`` are side by side.
    """
    prepared = spec.features.fit(train)
    columns = ["features", "label"] + (["weight"] if spec.kind == "propensity" else [])
    parts = [_parts(train.sparkSession, rows, fits)] + [_parts(train.sparkSession, rows)] * len(others)
    frames = [
        prepared.transform(df).select(*columns).coalesce(n).persist(StorageLevel.MEMORY_AND_DISK)
        for df, n in zip((train, *others), parts)
    ]
    try:
        yield prepared, frames
    finally:
        for frame in frames:
            frame.unpersist()


@dataclass
class Trial:
    """One setting of a run, with its scores so far, by fold."""

    run: int
    settings: Settings
    scores: dict[int, float] = field(default_factory=dict)
    seconds: float = 0.0
    error: str | None = None

    @property
    def mean(self) -> float:
        return sum(self._scores) / len(self.scores)

    @property
    def spread(self) -> float:
        return (sum((s - self.mean) ** 2 for s in self._scores) / len(self.scores)) ** 0.5

    @property
    def _scores(self) -> list[float]:
        """In order of the folds, whatever order they were scored in, so that sums repeat."""
        return [self.scores[i] for i in sorted(self.scores)]


class _Fold:
    """A fold prepared on its training part when its first fit asks for it, and released after its last one."""

    def __init__(self, ranked: DataFrame, spec: ModelSpec, k: int, number: int, rows: int, uses: int, fits: int):
        self.number, self._uses, self._open = number, uses, None
        self._lock, self._stack = threading.Lock(), ExitStack()
        self._make = lambda: self._frames(ranked, spec, k, rows, fits)

    def _frames(self, ranked: DataFrame, spec: ModelSpec, k: int, rows: int, fits: int) -> list[DataFrame]:
        folded = prep.fold_of(ranked, k)
        train, test = folded.where(F.col("fold") != self.number), folded.where(F.col("fold") == self.number)
        return self._stack.enter_context(_prepared(spec, rows, train, test, fits=fits))[1]

    @contextmanager
    def used(self) -> Iterator[list[DataFrame]]:
        try:
            with self._lock:
                if self._open is None:
                    self._open = self._make()
            yield self._open
        finally:
            with self._lock:
                self._uses -= 1
                if not self._uses:
                    self._stack.close()


def cross_validate(
    ranked: DataFrame,
    spec: ModelSpec,
    trials: Mapping[int, Sequence[Trial]],
    rows: int,
    parallelism: int,
    scale: float = 1.0,
) -> None:
    """Score every trial on every fold; ``trials`` by number of folds.

    A fold is prepared once, on its training part, for the trials of all runs. Trials that differ in their
    number of trees alone, in whatever run, share a fit. ``parallelism`` fits go side by side, those of a fold
    one after the other and the longest first, and as soon as a fold has none left those of the next one, also
    of another number of folds. Each fit is a distributed job; folds are released when their last fit is done.
    """
    work: list[tuple[int, int, list[list[Trial]]]] = []
    for k, mine in trials.items():
        groups: dict[tuple, list[Trial]] = {}
        for t in mine:
            groups.setdefault(tuple(sorted((n, v) for n, v in t.settings.items() if n != LENGTH)), []).append(t)
        order = sorted(groups.values(), key=lambda g: -max(_length(t.settings) for t in g))
        work += [(k, i, order) for i in range(k)]
    fits = max(1, min(parallelism, sum(len(order) for _, _, order in work)))
    jobs = []
    for k, i, order in work:
        fold = _Fold(ranked, spec, k, i, rows, len(order), fits)
        jobs += [(fold, group) for group in order]
    lock = threading.Lock()

    def score(job: tuple[_Fold, list[Trial]]) -> None:
        fold, group = job
        start = time.monotonic()
        found, error = {}, None
        try:
            with fold.used() as (train, test):
                group = [t for t in group if t.error is None]
                if not group:
                    return
                lengths = [_length(t.settings) for t in group]
                found = staged_scores(train, test, spec, group[0].settings, lengths, rows, scale)
                if None in found.values():
                    raise ValueError("a fold has rows of one class only")
        except Exception as err:  # noqa: BLE001 - reported with the runs it belongs to
            error = str(err).split("\n")[0]
        with lock:
            for t in group:
                t.seconds += (time.monotonic() - start) / len(group)
                if error is None:
                    t.scores[fold.number] = found[_length(t.settings)]
                else:
                    t.error = t.error or error

    with ThreadPool(fits) as pool:
        pool.map(inheritable_thread_target(ranked.sparkSession)(score), jobs, chunksize=1)


@dataclass
class SearchResult:
    """``runs``: the best setting of each run, best run first; ``settings``: every setting tried, with
    its rank in its run; ``importance``: of each run's best model; ``errors``: runs that failed."""

    runs: DataFrame
    settings: DataFrame
    importance: DataFrame | None = None
    errors: dict[int, str] = field(default_factory=dict)


def search(
    df: DataFrame,
    spec: ModelSpec,
    *,
    space: Mapping[str, Sequence] | None = None,
    k_folds: Sequence[int] = (3, 4, 5),
    runs_per_k: int = 10,
    n_iter: int = 100,
    parallelism: int = 4,
    importance: bool | None = None,
    staged: bool = False,
) -> SearchResult:
    """Randomised search: for each number of folds several runs, each with settings of its own.

    ``staged`` tries every drawn setting with all numbers of trees of the space, for one fit a fold.
    A run that fails is reported and the others go on. With ``importance`` (the default for revenue
    models) the best setting of each run is fitted on all rows for its feature importances.
    """
    space = space or SPACES[spec.kind]
    importance = spec.kind == "revenue" if importance is None else importance
    data = training_set(df, spec)
    strata = "label" if spec.kind == "propensity" else None
    # one ranking for all numbers of folds
    ranked = written(rank_by_hash(data.rows, spec.key, spec.seed, strata), "search")
    by_k: dict[int, list[Trial]] = {}
    folds_of: dict[int, int] = {}
    for k in k_folds:
        runs = range(len(folds_of), len(folds_of) + runs_per_k)
        folds_of.update(dict.fromkeys(runs, k))
        mine = [Trial(run, s) for run in runs for s in draw_settings(space, n_iter, spec.seed + run, staged)]
        by_k.setdefault(k, []).extend(mine)
    cross_validate(ranked, spec, by_k, data.count, parallelism, data.scaler.std if data.scaler else 1.0)
    trials = [t for mine in by_k.values() for t in mine]
    errors = {t.run: t.error for t in trials if t.error is not None}
    trials = [t for t in trials if t.run not in errors]
    if not trials:
        raise RuntimeError(f"no run of the search succeeded: {errors}")
    settings_df = _settings_table(df.sparkSession, spec, list(space), trials, folds_of, data.class_weight)
    ranked = settings_df.withColumn("rank", F.row_number().over(_best_first(spec, "iteration_id")))
    runs_df = ranked.where("rank = 1").drop("rank").orderBy(*_order(spec))
    shares = _best_importances(data, spec, trials, parallelism) if importance else None
    return SearchResult(runs_df, ranked, shares, errors)


def _best_importances(data: TrainingSet, spec: ModelSpec, trials: Sequence[Trial], parallelism: int = 1) -> DataFrame:
    """Importances of the best setting of each run, fitted on all rows; several fits go side by side."""
    sign = -1.0 if spec.kind == "propensity" else 1.0
    best: dict[int, Trial] = {}
    for t in trials:
        if t.run not in best or sign * t.mean < sign * best[t.run].mean:
            best[t.run] = t
    settings = {tuple(sorted(t.settings.items())): t.settings for t in best.values()}
    fits = max(1, min(parallelism, len(settings)))
    with _prepared(spec, data.count, data.rows, fits=fits) as (prepared, (inputs,)):

        def fit(mine: Settings) -> PipelineModel:
            return PipelineModel([*prepared.stages, estimator(spec, mine, data.count).fit(inputs)])

        with ThreadPool(fits) as pool:
            models = pool.map(inheritable_thread_target(inputs.sparkSession)(fit), settings.values(), chunksize=1)
        fitted = dict(zip(settings, models))
        rows = [row for run, t in best.items() for row in _importances(run, fitted[tuple(sorted(t.settings.items()))])]
    return rank_importance(importance_table(data.rows.sparkSession, rows))


def _order(spec: ModelSpec) -> list:
    score = SCORE[spec.kind]
    return [F.desc(score) if spec.kind == "propensity" else F.asc(score), F.asc("iteration_id"), F.asc("setting")]


def _best_first(spec: ModelSpec, *by: str):
    return Window.partitionBy(*by).orderBy(*_order(spec))


def _settings_table(
    spark: SparkSession,
    spec: ModelSpec,
    names: Sequence[str],
    trials: Sequence[Trial],
    folds_of: Mapping[int, int],
    class_weight: float | None,
) -> DataFrame:
    kinds = {n: "int" if n in INTEGER_SETTINGS else "double" for n in names}
    schema = "iteration_id int, setting int, k_folds int, " + ", ".join(f"{n} {t}" for n, t in kinds.items())
    schema += ", scale_pos_weight double" if spec.kind == "propensity" else ", neg_mae_score double"
    schema += f", runtime_seconds double, {SCORE[spec.kind]} double, cv_std double"
    seconds: dict[int, float] = {}
    for t in trials:
        seconds[t.run] = seconds.get(t.run, 0.0) + t.seconds
    rows, numbers = [], {}
    for t in trials:
        number = numbers[t.run] = numbers.get(t.run, -1) + 1
        values = [int(t.settings[n]) if kinds[n] == "int" else float(t.settings[n]) for n in names]
        extra = class_weight if spec.kind == "propensity" else -t.mean
        rows.append((t.run, number, folds_of[t.run], *values, extra, seconds[t.run], t.mean, t.spread))
    return spark.createDataFrame(rows, schema)


def top_settings(result: SearchResult, spec: ModelSpec, n: int = 10) -> DataFrame:
    """The n best settings for each number of folds, each setting once, best first."""
    place = F.row_number().over(_best_first(spec, "k_folds"))
    score = SCORE[spec.kind]
    names = [c for c in result.settings.columns if c not in ("iteration_id", "setting", "rank", "runtime_seconds")]
    distinct = result.settings.withColumn("_copy", F.row_number().over(_best_first(spec, *names)))
    ranked = distinct.where("_copy = 1").withColumn("rank", place).where(F.col("rank") <= n)
    order = F.desc(score) if spec.kind == "propensity" else F.asc(score)
    return ranked.drop("_copy", "setting").orderBy(order, "k_folds", "rank")


def best_parameters(runs: DataFrame, spec: ModelSpec) -> Settings:
    """Settings of the best run of a stored search."""
    row = runs.orderBy(*[o for o in _order(spec)]).first()
    if row is None:
        raise ValueError("the search table is empty")
    names = list(SPACES[spec.kind]) + ["scale_pos_weight"]
    return {n: row[n] for n in names if n in runs.columns and row[n] is not None}


def fit_pipeline(data: TrainingSet, spec: ModelSpec, settings: Settings, fits: int = 1) -> PipelineModel:
    """Preparation and trees, fitted on all rows, as one flat pipeline; ``fits`` of them go side by side."""
    with _prepared(spec, data.count, data.rows, fits=fits) as (prepared, (inputs,)):
        trees = estimator(spec, settings, data.count).fit(inputs)
    return PipelineModel([*prepared.stages, trees])


def _importances(run: int, model: PipelineModel) -> list[tuple]:
    values = model.stages[-1].featureImportances.toArray()
    total = float(values.sum())
    return [
        (run, name, float(v), float(v) / total if total > 0 else float(v))
        for name, v in zip(prep.feature_names(model), values)
    ]


def importance_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    schema = "iteration_id int, feature_name string, feature_importance double, explained_variance double"
    return spark.createDataFrame(rows, schema)


def rank_importance(importances: DataFrame) -> DataFrame:
    """Place of each feature within its run, 1 for the most important."""
    order = Window.partitionBy("iteration_id").orderBy(F.desc("feature_importance"), "feature_name")
    return importances.withColumn("feature_importance_rank", F.row_number().over(order))


@dataclass
class FinalModel:
    """A fitted model with its metrics (one row) and, for a scaled target, the scaler."""

    spec: ModelSpec
    model: PipelineModel
    metrics: DataFrame
    settings: Settings
    scaler: prep.TargetScaler | None = None

    def history_row(self) -> DataFrame:
        """The row to append to the table of final models."""
        names = dict.fromkeys([*KNOWN_SETTINGS, *self.settings])
        params = [F.lit(self.settings.get(n)).cast("double").alias(f"param_{n}") for n in names]
        return self.metrics.select(
            iso_now().alias("model_timestamp"),
            F.lit(self.spec.target).alias("response_variable"),
            F.lit(join_names(self.spec.predictors)).alias("predictive_variables"),
            "*",
            *params,
        )


def fit_final(
    df: DataFrame, spec: ModelSpec, settings: Settings, holdout: DataFrame | None = None, fits: int = 1
) -> FinalModel:
    """Fit on all rows of ``df``; metrics are of those same rows, and ``holdout_*`` ones of a holdout.

    ``fits`` is the number of models that the caller fits side by side.
    """
    data = training_set(df, spec)
    if spec.kind == "propensity" and settings.get("scale_pos_weight"):
        data.rows = prep.with_class_weight(data.rows, "label", settings["scale_pos_weight"])
    start = time.monotonic()
    model = fit_pipeline(data, spec, settings, fits)
    seconds = time.monotonic() - start
    out = evaluate(model, data.rows, spec, data.scaler).select(
        F.lit(spec.name).alias("model_name"),
        "*",
        F.lit(seconds).alias("training_time_seconds"),
        F.lit(data.count).alias("training_samples"),
        *([F.lit(spec.scale_target).alias("response_scaled")] if spec.kind == "revenue" else []),
    )
    if holdout is not None:
        # Classes and scale are those of the training rows.
        rows = _labelled(_known_targets(holdout, spec), spec, data.classes, data.scaler)
        tested = evaluate(model, rows, spec, data.scaler).first().asDict()
        out = out.withColumns({f"holdout_{k}": F.lit(v) for k, v in tested.items()})
    return FinalModel(spec, model, out, dict(settings), data.scaler)


def evaluate(
    model: PipelineModel, rows: DataFrame, spec: ModelSpec, scaler: prep.TargetScaler | None = None
) -> DataFrame:
    """Metrics of a model on labelled rows, for revenue on the original scale."""
    scored = model.transform(rows)
    if spec.kind == "propensity":
        scored = scored.select("label", _probability().alias("probability"))
        return metrics.classification_metrics(scored, "label", "probability")
    undo = scaler.invert if scaler else lambda c: c
    scored = scored.select(undo(F.col("label")).alias("actual"), undo(F.col("prediction")).alias("predicted"))
    return metrics.regression_metrics(scored, "actual", "predicted")


def _probability():
    return vector_to_array("probability")[1]


def score_propensity(model: PipelineModel, df: DataFrame, key: str) -> DataFrame:
    """Key, probability and class of every row. Missing predictors are filled by the model itself."""
    scored = model.transform(df).select(ident(key), _probability().alias("predicted_probability"))
    return scored.select(
        "*",
        (F.col("predicted_probability") > 0.5).cast("int").alias("predicted_class"),
        iso_now().alias("prediction_timestamp"),
    )


def score_revenue(
    model: PipelineModel, df: DataFrame, column: str, scaler: prep.TargetScaler | None = None
) -> DataFrame:
    """All input columns plus the prediction, on the original scale."""
    prediction = F.col("prediction")
    scored = model.transform(df)
    return scored.select(
        *[ident(c) for c in df.columns], (scaler.invert(prediction) if scaler else prediction).alias(column)
    )


def save_model(final: FinalModel, path: str) -> None:
    """The pipeline, with the target scaler beside it."""
    final.model.write().overwrite().save(f"{path}/model")
    if final.scaler:
        final.scaler.save(final.metrics.sparkSession, f"{path}/target_scaler")


def load_model(spark: SparkSession, path: str, scaled: bool = False):
    """(pipeline, scaler or None)"""
    model = PipelineModel.load(f"{path}/model")
    return model, prep.TargetScaler.load(spark, f"{path}/target_scaler") if scaled else None


def latest_predictors(history: DataFrame) -> list[str]:
    """Predictor list of the newest row of a table of final models.

    Of rows with the same time stamp the one whose other columns sort last is taken, whatever order they
    are read in.
    """
    ties = [F.desc(ident(c)) for c in sorted(history.columns) if c != "model_timestamp"]
    latest = history.orderBy(F.desc("model_timestamp"), *ties).limit(1)
    row = latest.select(split_names(F.col("predictive_variables")).alias("names")).first()
    if row is None:
        raise ValueError("the table of final models is empty")
    return list(row["names"])
