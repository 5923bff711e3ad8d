import math

import pytest
from pyspark.sql import functions as F

from propense.functions.order import rank_by_hash
from propense.operators import features


def test_fill_touches_predictors_only(spark):
    df = spark.createDataFrame([(None, None, None), ("x", float("nan"), 1)], "t string, n double, other int")
    rows = features.fill_missing(df, ["t", "n"]).collect()
    assert [tuple(r) for r in rows] == [("Unknown", 0.0, None), ("x", 0.0, 1)]
    with pytest.raises(ValueError, match="gone"):
        features.fill_missing(df, ["t", "gone"])


@pytest.mark.parametrize(
    "values, kind, kept",
    [
        (["b", "a", "b", "c", "a", None], "string", {"a": 0.0, "b": 1.0}),
        ([0, 1, 1, 0], "int", {0: 0.0, 1: 1.0}),
        ([3, 7, 7, 3, 5], "int", {3: 0.0, 7: 1.0}),
        ([1, 1], "int", {1: 1.0}),
        ([0, 0], "int", {0: 0.0}),
        (["only"], "string", {"only": 0.0}),
    ],
)
def test_binary_target(spark, values, kind, kept):
    df = spark.createDataFrame([(v,) for v in values], f"y {kind}")
    assert {r["y"]: r["label"] for r in features.binary_target(df, "y").collect()} == kept


def test_numeric_target(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("n/a",), (None,), ("NaN",), ("1d",)], "y string")
    assert [r["y"] for r in features.numeric_target(df, "y").collect()] == [1.5, 2.0]


@pytest.mark.parametrize("negatives, positives, weight", [(776, 193, 776 / 193), (679, 290, 2.3413793103448275), (5, 0, 1.0)])
def test_class_weight(spark, negatives, positives, weight):
    df = spark.createDataFrame([(0,)] * negatives + [(1,)] * positives, "label int")
    assert features.class_balance(df, "label").first()["class_weight"] == weight


def test_scaling_uses_the_population_deviation(spark):
    df = spark.range(290).selectExpr("CAST(id AS DOUBLE) AS v", "7.0D AS same")
    row = features.standardize(df, ["v", "same"]).agg(F.stddev_samp("v"), F.max("same")).first()
    assert row[0] == pytest.approx(math.sqrt(290 / 289)) and row[1] == 0.0
    sample = features.standardize(df, ["v"], std="sample").agg(F.stddev_samp("v")).first()
    assert sample[0] == pytest.approx(1.0)


def test_target_scaler(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (2.0,), (6.0,)], "y double")
    scaler = features.TargetScaler.fit(df, "y")
    scaler.save(spark, str(tmp_path / "scaler"))
    assert features.TargetScaler.load(spark, str(tmp_path / "scaler")) == scaler
    back = df.select(scaler.invert(scaler.scale(F.col("y")))).collect()
    assert [r[0] for r in back] == pytest.approx([1.0, 2.0, 6.0])


def test_prepared_features(spark):
    train = spark.createDataFrame(
        [("a", 1.0), ("b", 2.0), ("it's", 3.0), (None, None)], "c string, `odd name` double"
    )
    model = features.FeaturePrep(["odd name", "c"], ["c"]).fit(train)
    assert features.feature_names(model) == ["odd name", "c_a", "c_b", "c_it's"]
    unseen = spark.createDataFrame([("it's", 1.5), ("new", None)], "c string, `odd name` double")
    rows = [r["features"].toArray().tolist() for r in model.transform(unseen).collect()]
    mean, std = 1.5, math.sqrt((1 + 4 + 9) / 4 - 1.5**2)
    assert rows[0] == pytest.approx([0.0, 0.0, 0.0, 1.0])
    assert rows[1] == pytest.approx([(0 - mean) / std, 0.0, 0.0, 0.0])


def test_category_names_may_hold_any_mark(spark):
    marks = ["a", "v1.0", "ba`ck", "100%2E", "q'uote", "b\\s"]
    train = spark.createDataFrame([(m,) for m in marks], "c string")
    model = features.FeaturePrep(["c"], ["c"]).fit(train)
    names = features.feature_names(model)
    assert names == [f"c_{m}" for m in sorted(marks)[1:]]
    for row in model.transform(train).collect():
        want = [1.0 if f"c_{row['c']}" == n else 0.0 for n in names]
        assert row["features"].toArray().tolist() == want


def test_any_number_of_categories_is_encoded(spark):
    df = spark.range(4500).selectExpr("CAST(id AS DOUBLE) AS n", "CAST(id % 1500 AS STRING) AS c", "'only' AS one")
    model = features.FeaturePrep(["n", "c", "one"], ["c", "one"]).fit(df)
    names = features.feature_names(model)
    order = sorted(str(i) for i in range(1500))
    assert names == ["n", *(f"c_{v}" for v in order[1:])]
    for row in model.transform(df.where("id % 97 = 0" if "id" in df.columns else "n % 97 = 0")).collect():
        vector = row["features"]
        entries = {names[i]: v for i, v in zip(vector.indices.tolist(), vector.values.tolist()) if i}
        assert entries == ({} if row["c"] == order[0] else {f"c_{row['c']}": 1.0})
    unseen = spark.createDataFrame([(1.0, "new", None)], "n double, c string, one string")
    assert not model.transform(unseen).first()["features"].toArray()[1:].any()


def test_a_null_stratum_is_kept(spark):
    df = spark.range(100).selectExpr("id", "IF(id % 10 = 0, NULL, CAST(id % 2 AS STRING)) AS `s.t`")
    train, test = features.split(df, "id", 0.2, strata="s.t")
    assert train.count() + test.count() == 100
    assert test.where("`s.t` IS NULL").count() == 2
    folds = features.with_folds(df, "id", 5, strata="s.t", exact=True)
    assert {r["count"] for r in folds.where("`s.t` IS NULL").groupBy("fold").count().collect()} == {2}


def test_rank_by_hash_is_a_permutation_of_each_stratum(spark):
    df = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 'hot', CAST(id % 7 AS STRING)) AS s")
    ranked = rank_by_hash(df, "id", 1, "s")
    for row in ranked.groupBy("s").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("shuffled_rank").alias("d"), F.min("shuffled_rank").alias("lo"),
        F.max("shuffled_rank").alias("hi"), F.max("stratum_size").alias("size"),
    ).collect():
        assert row["n"] == row["d"] == row["size"] == row["hi"] + 1 and row["lo"] == 0
    again = rank_by_hash(df.repartition(5), "id", 1, "s")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, ranked.collect()))
    other = rank_by_hash(df, "id", 2, "s")
    assert sorted(map(tuple, other.collect())) != sorted(map(tuple, ranked.collect()))


def test_folds_and_splits(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 10 < 3 AS INT) AS y")
    exact = features.with_folds(df, "id", 4, strata="y", exact=True)
    sizes = {(r["y"], r["fold"]): r["count"] for r in exact.groupBy("y", "fold").count().collect()}
    assert all(sizes[1, f] == 75 and sizes[0, f] == 175 for f in range(4))
    hashed = features.with_folds(df, "id", 4)
    assert {r["fold"] for r in hashed.select("fold").distinct().collect()} == {0, 1, 2, 3}
    train, test = features.split(df, "id", 0.2, strata="y")
    assert (train.count(), test.count()) == (800, 200)
    assert test.where("y = 1").count() == 60
    assert train.join(test, "id").count() == 0


def test_sample(spark):
    df = spark.range(500)
    once = features.sample_rows(df, "id", 50).collect()
    assert len(set(once)) == 50
    assert once == features.sample_rows(df.repartition(7), "id", 50).collect()
    assert features.sample_rows(df, "id", 5000).count() == 500


def test_ranks_read_their_input_once(spark, tmp_path):
    """The rows to rank are computed once, however many things are asked of the ranks."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(500).selectExpr("id", "id % 3 AS s").mapInArrow(count, "id long, s long")
    ranked = rank_by_hash(df, "id", 1, "s")
    folds = [features.fold_of(ranked, k) for k in (3, 4, 5)]
    for k, folded in zip((3, 4, 5), folds):
        sizes = {(r["s"], r["fold"]): r["count"] for r in folded.groupBy("s", "fold").count().collect()}
        assert len(sizes) == 3 * k and max(sizes.values()) - min(sizes.values()) <= 1
    train, test = features.split(df, "id", 0.2, 7, strata="s")
    assert train.count() + test.count() == 500
    assert seen.value == 1000


def test_one_hot_columns_are_bounded(spark):
    df = spark.range(50).selectExpr("concat('c', id) AS c")
    assert len(features.categories(df, "c")) == 50 == len(features.categories(df, "c", most=50))
    with pytest.raises(ValueError, match="more than 49"):
        features.categories(df, "c", most=49)
