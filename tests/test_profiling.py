import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from propense.functions import columnwise
from propense.operators import profiling


def profile(spark, values, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return profiling.numeric_profile(df).first().asDict()


def test_known_binary_column(spark):
    row = profile(spark, [1] * 193 + [0] * 776, "long")
    assert row["skewness"] == pytest.approx(1.5088015888272286, rel=1e-12)
    assert row["kurtosis"] == pytest.approx(0.2770497974363411, rel=1e-11)
    assert (row["count_non_zero"], row["mode"], row["median_value"]) == (193, 0.0, 0.0)
    assert row["skewness_non_zero"] is None and row["kurtosis_non_zero"] is None
    assert row["iqr_non_zero"] == 0.0


def test_empty_and_all_zero_columns(spark):
    df = spark.createDataFrame([(None, 0.0, float("nan"))] * 3, "a double, b double, c float")
    rows = {r["data_field_name"]: r for r in profiling.numeric_profile(df).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert rows["a"]["min_value"] is None and rows["a"]["count_non_zero"] == 0
    assert rows["c"]["min_value"] is None
    assert rows["b"]["mode"] == 0.0 and rows["b"]["median_value_non_zero"] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([-7.25, -1.0, 0.0, 0.5, 3.0, 1e6]), min_size=1, max_size=6))
def test_small_samples_agree_with_sql(spark, values):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?)", [(v,) for v in values])
    row = profile(spark, values)
    for end, source in (("", "v"), ("_non_zero", "nullif(v, 0)")):
        want = con.execute(
            f"SELECT median({source}), quantile_cont({source}, 0.25), quantile_cont({source}, 0.75), "
            f"mode() WITHIN GROUP (ORDER BY {source}), avg({source}) FROM t"
        ).fetchone()
        names = ("median_value", "25_percentile_value", "75_percentile_value", "mode", "mean_value")
        for name, value in zip(names, want):
            assert row[name + end] == (None if value is None else pytest.approx(value))


@pytest.mark.parametrize("slot_bits, head_bits, candidates", [(13, 14, 256), (6, 8, 2), (4, 4, 1)])
def test_percentiles_of_awkward_shapes(spark, monkeypatch, slot_bits, head_bits, candidates):
    """Long tails, near-equal values and a hot value; few slots force many rounds of narrowing."""
    monkeypatch.setattr(columnwise, "SLOT_BITS", slot_bits)
    monkeypatch.setattr(columnwise, "MORE_BITS", slot_bits)
    monkeypatch.setattr(columnwise, "HEAD_BITS", head_bits)
    monkeypatch.setattr(columnwise, "CANDIDATES", candidates)
    rng = random.Random(1)
    columns = {
        "tail": [math.exp(rng.gauss(0, 6)) for _ in range(300)],
        "close": [1e6 + rng.random() * 1e-6 for _ in range(300)],
        "hot": [0.0 if i % 3 else rng.uniform(-5, 5) for i in range(300)],
        "signed": [rng.gauss(0, 1) * 10 ** rng.randint(-8, 8) for _ in range(300)],
        "outlier": [1e-300, 1e300, *[float(i) for i in range(298)]],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    for row in profiling.numeric_profile(df).collect():
        values = np.array(columns[row["data_field_name"]])
        for end, part in (("", values), ("_non_zero", values[values != 0])):
            for name, q in profiling.QUARTILES.items():
                assert row[name + end] == pytest.approx(np.quantile(part, q), rel=1e-12, abs=1e-300)
            found, counts = np.unique(part, return_counts=True)
            assert row["mode" + end] == found[counts == counts.max()].min()
            assert (row["min_value" + end], row["max_value" + end]) == (part.min(), part.max())


def test_modes_by_candidates(spark, monkeypatch):
    """Frequent values need no full count, however many others there are; nearly distinct ones get it."""
    monkeypatch.setattr(columnwise, "CANDIDATES", 8)
    counted = []
    full = columnwise._full_modes
    monkeypatch.setattr(columnwise, "_full_modes", lambda df, name: counted.append(name) or full(df, name))
    rng = random.Random(4)
    columns = {
        "hot": [7.5] * 400 + [float(i) for i in range(600)],
        "two": [2.0] * 300 + [-1.0] * 300 + [i / 3 + 0.1 for i in range(400)],
        "few": [float(i % 6) for i in range(1000)],
        "distinct": [rng.random() for _ in range(1000)],
        "zero": [0.0] * 500 + [i + 0.5 for i in range(500)],
        "late": [float(i) for i in range(998)] + [5.0, 5.0],
    }
    rows = list(zip(*columns.values()))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(7)
    got = {r["data_field_name"]: (r["mode"], r["mode_non_zero"]) for r in profiling.numeric_profile(df).collect()}
    least = min(columns["distinct"])
    assert got == {"hot": (7.5, 7.5), "two": (-1.0, -1.0), "few": (0.0, 1.0), "distinct": (least, least), "zero": (0.0, 0.5), "late": (5.0, 5.0)}
    assert sorted(counted) == ["_3", "_4", "_5"]
    # no cells are taken apart on the way
    plan = columnwise._first_pass(df.select("hot"), 1)._jdf.queryExecution().toString()
    assert "Generate" not in plan and "MapInArrow" in plan


@pytest.mark.parametrize("kind, values", [("decimal(12,2)", "0.25"), ("byte", "3"), ("float", "0.1"), ("long", "9007199254740993")])
def test_kinds_of_numbers(spark, kind, values):
    df = spark.sql(f"SELECT CAST({values} AS {kind}) AS v UNION ALL SELECT NULL UNION ALL SELECT CAST(0 AS {kind})")
    row = profiling.numeric_profile(df).first()
    want = float(np.float32(0.1)) if kind == "float" else float(values)
    assert (row["max_value"], row["mode_non_zero"], row["median_value"], row["count_non_zero"]) == (want, want, want / 2, 1)


def test_means_over_many_tasks(spark):
    df = spark.range(5000).selectExpr("id % 40 AS a", "id * 0.37 AS b", "CAST(NULL AS DOUBLE) AS c")
    got = {r["data_field_name"]: r for r in profiling.numeric_profile(df).collect()}
    values = np.arange(5000) * 0.37
    assert got["b"]["median_value"] == pytest.approx(np.median(values), rel=1e-14)
    assert got["b"]["mean_value"] == pytest.approx(values.mean(), rel=1e-12)
    assert (got["a"]["mode"], got["a"]["25_percentile_value"], got["c"]["mode"]) == (0.0, 9.75, None)


def test_categorical_facts(spark):
    rows = [("M",)] * 515 + [("F",)] * 452 + [(None,)] * 2
    df = spark.createDataFrame(rows, "sex string").selectExpr("sex", "CAST(NULL AS STRING) AS empty")
    out = {r["data_field_name"]: r for r in profiling.categorical_profile(df).collect()}
    sex = out["sex"]
    assert (sex["total_records"], sex["null_records"], sex["null_percentage"]) == (969, 2, 0.21)
    assert (sex["most_frequent_category"], sex["least_frequent_category"]) == ("M", "F")
    assert sex["balance_ratio"] == pytest.approx(1.1393805309734513) and sex["is_balanced"]
    shares = {(r["data_field_name"], r["category_value"]): (r["count"], r["percentage"]) for r in profiling.category_distribution(df).collect()}
    assert shares == {("sex", "M"): (515, 53.26), ("sex", "F"): (452, 46.74)}
    empty = out["empty"]
    assert (empty["unique_values_count"], empty["balance_ratio"], empty["is_balanced"]) == (0, 0.0, True)
    assert empty["most_frequent_category"] is None and empty["null_percentage"] == 100.0


def test_distributions_of_any_number_of_categories(spark):
    df = spark.range(3000).selectExpr("CAST(id % 3 AS STRING) AS few", "CAST(id % 1500 AS STRING) AS many")
    out = {r["data_field_name"]: r for r in profiling.categorical_profile(df).collect()}
    assert (out["few"]["unique_values_count"], out["many"]["unique_values_count"]) == (3, 1500)
    rows = profiling.category_distribution(df, ["many"]).collect()
    assert len(rows) == 1500 and {r["count"] for r in rows} == {2}


def test_infinite_and_tiny_values_are_ranked(spark):
    inf, tiny = float("inf"), 5e-324
    columns = {
        "low": [-inf] * 30 + [float(i) for i in range(70)],
        "high": [inf] * 60 + [float(i) for i in range(40)],
        "both": [-inf] * 20 + [inf] * 20 + [i / 7 for i in range(60)],
        "far": [-1.7e308, 1.7e308, -inf, inf] * 25,
        "tiny": [tiny * (i % 20) for i in range(100)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    for row in profiling.numeric_profile(df).collect():
        values = sorted(columns[row["data_field_name"]])
        for name, q in profiling.QUARTILES.items():
            place = (len(values) - 1) * q
            low, high = values[math.floor(place)], values[math.ceil(place)]
            if low == high:
                assert row[name] == low
            elif math.isfinite(low) and math.isfinite(high):
                assert row[name] == pytest.approx(low + (place % 1) * (high - low))


def test_integer_categories_are_found_exactly(spark):
    df = spark.range(2000).selectExpr(
        "id", "id % 20 AS twenty", "CAST(id % 21 AS INT) AS twenty_one", "CAST(id % 2 AS BYTE) AS two",
        "id % 2 = 0 AS flag", "id * 0.5 AS number", "CAST(NULL AS INT) AS nothing",
    )
    assert profiling.category_columns(df) == ["twenty", "two", "flag", "nothing"]


def test_mean_baseline(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 0.0), (None, 5.0), (0.0, None)], "a double, b double")
    got = {r["data_field_name"]: (r["rows"], r["mean_value"], r["mae"]) for r in profiling.mean_baseline_error(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 2.0, 1.0), "b": (2, 5.0, 0.0)}
