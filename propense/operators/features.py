"""Model input: filling, targets, scaling, encoding, folds, splits and samples."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propense.functions.casting import NUMBER_PATTERN
from propense.functions.columns import TEXTUAL, ident, require_columns, resolve
from propense.functions.order import rank_by_hash
from propense.session import written

# What a missing predictor becomes.
MISSING_TEXT = "Unknown"
MISSING_NUMBER = 0
# Columns made for the model carry this prefix, in front of the feature's name.
# Columns that a one-hot table is made of at most.
MAX_COLUMNS = 10_000
PREFIX = "z__"
# Marks of the columns a category column goes through; no made name ends like this, as '%' is encoded.
TEXT_MARK = "%text"


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(resolve(df, column).dataType, TEXTUAL)


def fill_missing(df: DataFrame, predictors: Sequence[str]) -> DataFrame:
    """NULL (and NaN) predictors become 'Unknown' or 0; other columns are left alone."""
    require_columns(df, list(predictors))
    values = {c: MISSING_TEXT if _is_text(df, c) else MISSING_NUMBER for c in predictors}
    return df.fillna(values)


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    require_columns(df, [target])
    return df.where(ident(target).isNotNull())


def binary_classes(df: DataFrame, target: str) -> list:
    """The target's two most frequent values in sort order; all that travels through the driver.

    On equal frequency the value that sorts first is kept.
    """
    counts = df.where(ident(target).isNotNull()).groupBy(ident(target).alias("v")).count()
    return sorted(r["v"] for r in counts.orderBy(F.desc("count"), "v").limit(2).collect())


def label_classes(df: DataFrame, target: str, classes: Sequence, label: str = "label") -> DataFrame:
    """Rows of these classes only; the label is 1.0 for the second. A lone 0/1 class keeps its meaning."""
    if len(classes) == 2:
        value = (ident(target) == classes[1]).cast("double")
    else:
        value = F.lit(0.0) if _is_text(df, target) else ident(target).cast("double")
    return df.where(ident(target).isin(list(classes))).withColumn(label, value)


def binary_target(df: DataFrame, target: str, label: str = "label") -> DataFrame:
    """A label out of any target, by its two most frequent values."""
    return label_classes(df, target, binary_classes(df, target), label)


def numeric_target(df: DataFrame, target: str) -> DataFrame:
    """Text target read as a number; rows where that fails are dropped."""
    if _is_text(df, target):
        # Spark alone would read '1d' as 1.
        reads = F.when(ident(target).rlike(NUMBER_PATTERN), F.trim(ident(target)))
        df = df.withColumn(target, reads.try_cast("double"))
    return df.where(ident(target).isNotNull() & ~F.isnan(ident(target).cast("double")))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Negatives, positives, and the weight that evens them out (1 if there is no positive)."""
    positive, negative = F.count_if(ident(label) == 1), F.count_if(ident(label) != 1)
    return df.agg(
        negative.alias("negatives"),
        positive.alias("positives"),
        F.coalesce(F.try_divide(negative.cast("double"), positive), F.lit(1.0)).alias("class_weight"),
    )


def with_class_weight(df: DataFrame, label: str, weight: float, column: str = "weight") -> DataFrame:
    return df.withColumn(column, F.when(ident(label) == 1, F.lit(float(weight))).otherwise(1.0))


def moments(df: DataFrame, columns: Sequence[str], std: str = "population") -> dict[str, tuple[float, float]]:
    """Mean and standard deviation of every column, in one pass. A constant column gets deviation 1."""
    deviation = {"population": F.stddev_pop, "sample": F.stddev_samp}[std]
    row = df.agg(
        *[F.avg(ident(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[deviation(ident(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, columns: Sequence[str], std: str = "population") -> DataFrame:
    """The given columns as deviations from their mean in units of their deviation."""
    fitted = moments(df, columns, std)
    scaled = {c: (ident(c) - m) / s for c, (m, s) in fitted.items()}
    return df.withColumns(scaled)


def categories(df: DataFrame, column: str, most: int = MAX_COLUMNS) -> list[str]:
    """Distinct values in sort order: the names of the columns to make, which no table has very many of."""
    values = df.where(ident(column).isNotNull()).select(ident(column).cast("string").alias("v")).distinct()
    found = sorted(r["v"] for r in values.limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"'{column}' has more than {most} categories; FeaturePrep encodes them without columns")
    return found


def one_hot(df: DataFrame, column: str, known: Sequence[str] | None = None) -> DataFrame:
    """A 0/1 column per category but the first; values outside ``known`` get zeros throughout."""
    known = categories(df, column) if known is None else known
    is_it = {
        f"{column}_{v}": F.coalesce((ident(column).cast("string") == v).cast("double"), F.lit(0.0))
        for v in known[1:]
    }
    return df.withColumns(is_it) if is_it else df


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _made_name(feature: str) -> str:
    """Column name for a feature; dots and backticks would not be read as part of a name."""
    for mark, code in (("%", "%25"), (".", "%2E"), ("`", "%60")):
        feature = feature.replace(mark, code)
    return PREFIX + feature


def _feature_name(made: str) -> str:
    feature = made.removeprefix(PREFIX)
    for mark, code in (("`", "%60"), (".", "%2E"), ("%", "%25")):
        feature = feature.replace(code, mark)
    return feature


class FeaturePrep(Estimator):
    """Fill, standardise and encode the predictors into one vector.

    Being an estimator, it is fitted inside each fold of a search. Scaling becomes SQL text, categories
    become entries of a sparse vector, however many there are: those in sort order but for the first
    one, which is all zeros, as are values not seen in the fit. Fitted stages are saved with the model.
    """

    def __init__(self, predictors: Sequence[str], categorical: Sequence[str] = (), std: str = "population"):
        super().__init__()
        self.predictors, self.categorical, self.std = list(predictors), list(categorical), std

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        filled = fill_missing(dataset, self.predictors)
        numbers = [c for c in self.predictors if c not in self.categorical]
        made: dict[str, str] = {}
        if numbers:
            for c, (mean, std) in moments(filled, numbers, self.std).items():
                value = f"coalesce(nanvl(CAST({_quote(c)} AS DOUBLE), 0D), 0D)"
                made[_made_name(c)] = f"({value} - CAST('{mean!r}' AS DOUBLE)) / CAST('{std!r}' AS DOUBLE)"
        texts = {
            _made_name(c) + TEXT_MARK: f"coalesce(CAST({_quote(c)} AS STRING), '{MISSING_TEXT}')"
            for c in self.categorical
        }
        columns = ", ".join(f"{sql} AS {_quote(name)}" for name, sql in {**made, **texts}.items())
        stages = [SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")]
        encoded = []
        for c, text in zip(self.categorical, texts):
            index, place, entry = (_made_name(c) + mark for mark in ("%index", "%place", "%entry"))
            prepared = PipelineModel(stages).transform(filled)
            indexer = StringIndexer(inputCol=text, outputCol=index, stringOrderType="alphabetAsc", handleInvalid="keep")
            fitted = indexer.fit(prepared)
            n = max(len(fitted.labels), 1)
            # The first category and unseen values take the place the encoder leaves out.
            moved = f"CASE WHEN {_quote(index)} BETWEEN 1 AND {n - 1} THEN {_quote(index)} - 1 ELSE {n - 1}D END"
            stages += [fitted, SQLTransformer(statement=f"SELECT *, {moved} AS {_quote(place)} FROM __THIS__")]
            if n > 1:
                size = dataset.sparkSession.range(n).select(F.col("id").cast("double").alias(place))
                stages.append(OneHotEncoder(inputCol=place, outputCol=entry, dropLast=True).fit(size))
                encoded.append(entry)
        return PipelineModel(stages + [VectorAssembler(inputCols=[*made, *encoded], outputCol="features")])


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the vector's entries, in order: numbers, then the categories of each text."""
    numbers: list[str] = []
    entries: list[str] = []
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            return feature_names(stage)
        if isinstance(stage, StringIndexerModel):
            column = _feature_name(stage.getInputCol().removesuffix(TEXT_MARK))
            entries += [f"{column}_{v}" for v in stage.labels[1:]]
        if isinstance(stage, VectorAssembler):
            numbers = [_feature_name(c) for c in stage.getInputCols() if not c.endswith("%entry")]
            return numbers + entries
    raise ValueError("the model has no assembled features")


@dataclass(frozen=True)
class TargetScaler:
    """Standardises a regression target, and turns predictions back."""

    mean: float
    std: float

    @classmethod
    def fit(cls, df: DataFrame, target: str) -> TargetScaler:
        return cls(*moments(df, [target])[target])

    def scale(self, target: Column) -> Column:
        return (target - self.mean) / self.std

    def invert(self, prediction: Column) -> Column:
        return prediction * self.std + self.mean

    def save(self, spark: SparkSession, path: str) -> None:
        row = spark.createDataFrame([(self.mean, self.std)], "mean double, std double")
        row.coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TargetScaler:
        row = spark.read.parquet(path).first()
        return cls(row["mean"], row["std"])


def with_side(
    df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42, strata: str | None = None
) -> DataFrame:
    """Adds ``side``, train or test; each stratum is split in the same proportion, exactly."""
    ranked = rank_by_hash(df, key, seed, strata)
    is_test = F.col("shuffled_rank") < F.ceil(F.col("stratum_size") * F.lit(test_share))
    side = F.when(is_test, "test").otherwise("train")
    return ranked.withColumn("side", side).drop("shuffled_rank", "stratum_size")


def split(
    df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42, strata: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the ranking is done once and stored for both."""
    sides = written(with_side(df, key, test_share, seed, strata), "split")
    return tuple(sides.where(F.col("side") == s).drop("side") for s in ("train", "test"))


def fold_of(ranked: DataFrame, k: int) -> DataFrame:
    """Adds ``fold`` to ranked rows, dealt out in turn; one ranking serves any number of folds."""
    return ranked.withColumn("fold", F.pmod(F.col("shuffled_rank"), F.lit(k)).cast("int"))


def with_folds(
    df: DataFrame, key: str, k: int, seed: int = 42, strata: str | None = None, exact: bool = False
) -> DataFrame:
    """Adds ``fold`` in 0..k-1, the same for the same key and seed.

    By default a hash of the key: no shuffle, and folds even (also within each class) in expectation.
    ``exact`` deals the rows of each stratum out in turn, for one shuffle.
    """
    if exact:
        return fold_of(rank_by_hash(df, key, seed, strata), k).drop("shuffled_rank", "stratum_size")
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), ident(key)), F.lit(k)).cast("int"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most n rows without replacement: the first n of a seeded shuffle, by a distributed top-n.

    The shuffle orders by the MD5 sum of "seed:key", which any other engine can repeat.
    """
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), ident(key).cast("string")))
    return df.orderBy(order, ident(key)).limit(n)
