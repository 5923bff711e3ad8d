"""Quality of scores: one aggregate each, over any number of models at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propense.functions.columns import ident


# The helpers below travel to the tasks with the job, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ratio(top, bottom):
    """0 where the denominator is empty."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def _score_counts(scored: DataFrame, label: str, probability: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score: a hot score is one row from here on."""
    score = ident(probability).cast("double")
    known = scored.where(score.isNotNull() & ident(label).isNotNull())
    return known.groupBy(*by, score.alias("score")).agg(
        F.count_if(ident(label) == 1).alias("pos"), F.count_if(ident(label) != 1).alias("neg")
    )


def _run_starts(by: pa.RecordBatch) -> np.ndarray:
    """Where runs of equal rows begin."""
    ends = [np.zeros(0, np.int64)]
    for column in by.columns:
        ends.append(np.asarray(pc.run_end_encode(column, run_end_type=pa.int64()).run_ends)[:-1])
    return np.unique(np.concatenate([np.zeros(1, np.int64), *ends]))


COUNTS = ("pos", "neg", "pos_above", "neg_above")


def _run_totals(counts: DataFrame, by: Sequence[str], cutoff: float) -> DataFrame:
    """Class counts, counts of either class above the cutoff, and the number of (positive, negative) pairs
    ranked right, ties counted half, of the scores of each group that lie in one task.

    Scores are dealt out by ranges, so that they spread over all tasks however crowded they are, and only
    the sums of a task leave it. What the negatives of lower ranges add is made up for from those sums.
    """
    by = list(by)
    dealt = counts.repartitionByRange(*by, "score").sortWithinPartitions(*by, "score")
    dealt = dealt.withColumn("part", F.spark_partition_id())
    types = ", ".join(f"`{c}` {dealt.schema[c].dataType.simpleString()}" for c in [*by, "part"])

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, open_sums = None, None

        def closed() -> pa.RecordBatch:
            columns = [*open_key.columns, *(pa.array([x], kind) for x, kind in zip(open_sums, [pa.int64()] * 4 + [pa.float64()]))]
            return pa.RecordBatch.from_arrays(columns, names=[*by, "part", *COUNTS, "right"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.select([*by, "part"])
            starts = _run_starts(batch.select(by)) if by else np.zeros(1, np.int64)
            score, pos, neg = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("score", "pos", "neg"))
            below = np.cumsum(neg) - neg
            lengths = np.diff(np.append(starts, len(neg)))
            below = below - np.repeat(below[starts], lengths)
            right = pos * (below + neg / 2.0)
            above = score > cutoff
            sums = [np.add.reduceat(x, starts) for x in (pos, neg, pos * above, neg * above, right)]
            for k, start in enumerate(starts.tolist()):
                key, mine = keys.slice(start, 1), [x[k].item() for x in sums]
                if open_key is not None and open_key.equals(key):
                    # the run goes on from the batch before
                    mine[4] += mine[0] * open_sums[1]
                    open_sums = [a + b for a, b in zip(open_sums, mine)]
                    continue
                if open_key is not None:
                    yield closed()
                open_key, open_sums = key, mine
        if open_key is not None:
            yield closed()

    parts = dealt.mapInArrow(sum_up, f"{types}, {', '.join(f'{c} long' for c in COUNTS)}, right double")
    # a row per task and group
    lower = F.sum("neg").over(Window.partitionBy(*by).orderBy("part")) - F.col("neg")
    return parts.withColumn("right", F.col("right") + F.col("pos") * lower)


def _auc():
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return F.try_divide(F.sum("right"), pairs).alias("auc_score")


def roc_auc(scored: DataFrame, label: str, probability: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs ranked right."""
    runs = _run_totals(_score_counts(scored, label, probability, by), by, 0.5)
    return runs.groupBy(*by).agg(_auc())


def classification_metrics(
    scored: DataFrame, label: str, probability: str, by: Sequence[str] = (), cutoff: float = 0.5
) -> DataFrame:
    """Confusion matrix and what follows from it, plus the area under the ROC curve, in one pass."""
    runs = _run_totals(_score_counts(scored, label, probability, by), by, cutoff)
    count = lambda name: F.coalesce(F.sum(name), F.lit(0))
    matrix = runs.groupBy(*by).agg(
        count("pos_above").alias("true_positives"),
        (count("neg") - count("neg_above")).alias("true_negatives"),
        count("neg_above").alias("false_positives"),
        (count("pos") - count("pos_above")).alias("false_negatives"),
        _auc(),
    )
    tp, tn = F.col("true_positives"), F.col("true_negatives")
    fp, fn = F.col("false_positives"), F.col("false_negatives")
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return matrix.select(
        *by,
        "auc_score",
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * precision * recall, precision + recall).alias("f1_score"),
        "true_positives",
        "true_negatives",
        "false_positives",
        "false_negatives",
        (tp + fn).alias("positive_class_count"),
        (tn + fp).alias("negative_class_count"),
    )


def regression_metrics(scored: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Errors on the original scale. The spread of the actuals is the sample one.

    ``mae_percentage`` is infinite where the mean of the actuals is 0.
    """
    y = ident(actual).cast("double")
    error = y - ident(predicted).cast("double")
    base = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.avg(y).alias("mean_actual"),
        F.stddev_samp(y).alias("std_actual"),
        F.var_pop(y).alias("_variance"),
    )
    return base.select(
        *by,
        "samples",
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        (1.0 - F.try_divide(F.col("mse"), F.col("_variance"))).alias("r2_score"),
        F.coalesce(
            F.try_divide(F.col("mae"), F.col("mean_actual")) * 100.0, F.lit(float("inf"))
        ).alias("mae_percentage"),
        "mean_actual",
        "std_actual",
    )


def score_distribution(scored: DataFrame, score: str, by: Sequence[str] = (), cutoff: float | None = None) -> DataFrame:
    """Range, mean and spread of scores; with a cutoff also how many fall into either class."""
    s = ident(score)
    aggregates = [
        F.count(s).alias("scores"),
        F.min(s).alias("min_score"),
        F.max(s).alias("max_score"),
        F.avg(s).alias("mean_score"),
        F.stddev_samp(s).alias("std_score"),
    ]
    if cutoff is not None:
        aggregates += [F.count_if(s > cutoff).alias("class_1"), F.count_if(s <= cutoff).alias("class_0")]
    return scored.groupBy(*by).agg(*aggregates)
