"""Column profiles: all numeric, or all categorical, columns of a table in one go.

The numeric profile sums up its columns in the tasks that read them; only those sums are shuffled. The
categorical one starts from a frequency table (field, value, count), whose shuffle carries each distinct
value of a field once per task, so a value that fills the table costs one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propense.functions.columns import (
    ident,
    integral_columns,
    numeric_columns,
    require_columns,
    rounded,
    text_columns,
)
from propense.functions.columnwise import ALL, NON_ZERO, summarise
from propense.functions.columnwise import Column as ColumnFacts
from propense.functions.moments import sample_kurtosis, sample_skewness
from propense.session import written

# Statistics over all values, and again over the non-zero ones.
ENDS = ("", "_non_zero")
QUARTILES = {"25_percentile_value": 0.25, "median_value": 0.5, "75_percentile_value": 0.75}
# Integer columns with at most this many values count as categories.
MAX_INTEGER_CATEGORIES = 20


def _long(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """(field_id, value) for the given columns; the id is the place in ``columns``."""
    cells = F.array(*[ident(c).cast(dtype) for c in columns])
    return df.select(F.posexplode(cells).alias("field_id", "value"))


def _fields(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per profiled column, so that a column without any value still gets its row."""
    names = F.array(*[F.lit(c) for c in columns])
    ids = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("field_id"))
    return ids.withColumn("data_field_name", F.element_at(names, F.col("field_id") + 1))


def numeric_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    profile: str = "numerical_profile",
    layer: str = "silver",
    table: str = "train",
) -> DataFrame:
    """11 statistics per numeric column over its values, the same over its non-zero values, and how
    many those are; all exact.

    Runs its jobs at once and returns one row per column. They read ``df`` two or three times, so a table
    that is dear to derive is better stored before. Between the jobs only a few numbers per column pass
    through the driver: counts, moments, candidates for the mode and the ranges its percentiles are in.
    """
    columns = list(columns or numeric_columns(df))
    require_columns(df, columns)
    cells = df.select(*[ident(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    rows = []
    for name, found in zip(columns, summarise(cells, _quartile_ranks)):
        row = [profile, layer, table, name]
        for over in (ALL, NON_ZERO):
            facts = found.moments.get(over, {})
            low, middle, high = _quartiles(found, over)
            row += [
                facts.get("lo"),
                facts.get("hi"),
                _difference(facts.get("hi"), facts.get("lo")),
                middle,
                facts.get("mean"),
                found.modes.get(over),
                low,
                high,
                _difference(high, low),
                sample_skewness(facts),
                sample_kurtosis(facts),
            ]
        rows.append((*row, found.n(NON_ZERO)))
    return df.sparkSession.createDataFrame(rows, _profile_schema())


def _places(n: int, q: float) -> tuple[int, int, float]:
    """The two ranks a percentile lies between, and how far from the first."""
    place = (n - 1) * q
    return math.floor(place), math.ceil(place), place - math.floor(place)


def _rank_among_all(rank: int, found: ColumnFacts, over: int) -> int:
    """A rank among the non-zero values as one among all: the zeros sit between negatives and positives."""
    return rank + found.zeros if over == NON_ZERO and rank >= found.negatives else rank


def _quartile_ranks(found: ColumnFacts) -> list[int]:
    ranks = []
    for over in (ALL, NON_ZERO):
        if found.n(over):
            for q in QUARTILES.values():
                ranks += [_rank_among_all(r, found, over) for r in _places(found.n(over), q)[:2]]
    return ranks


def _quartiles(found: ColumnFacts, over: int) -> list[float | None]:
    """Interpolated between the values at the two neighbouring ranks."""
    if not found.n(over):
        return [None] * len(QUARTILES)
    out = []
    for q in QUARTILES.values():
        low, high, fraction = _places(found.n(over), q)
        a, b = (found.at[_rank_among_all(r, found, over)] for r in (low, high))
        out.append(a if a == b else a + fraction * (b - a))
    return out


def _profile_schema() -> T.StructType:
    # Column names of a stored profile.
    schema = T.StructType()
    for name in ("name_of_profile", "schema_name", "table_field_name", "data_field_name"):
        schema.add(name, "string")
    statistics = (
        "min_value max_value min_max_range median_value mean_value mode 25_percentile_value "
        "75_percentile_value iqr skewness kurtosis"
    )
    for end in ENDS:
        for name in statistics.split():
            schema.add(name + end, "double")
    return schema.add("count_non_zero", "long")


def _difference(high: float | None, low: float | None) -> float | None:
    return None if high is None or low is None else high - low


def category_columns(df: DataFrame, max_integer_values: int = MAX_INTEGER_CATEGORIES) -> list[str]:
    """Text and boolean columns, and integer columns with few distinct values.

    One pass over the integer columns estimates their cardinality. A sketch that has seen at most 20
    values fills at most 20 of its registers and is then read by linear counting, which returns at
    most 20.4 (for n values, m ln(m / (m - n))): columns far above that are out for certain, and only
    the rest are counted exactly.
    """
    integers = integral_columns(df)
    few: set[str] = set()
    if integers:
        sketches = [F.approx_count_distinct(ident(c), 0.05).alias(str(i)) for i, c in enumerate(integers)]
        estimate = df.agg(*sketches).first()
        cutoff = 2 * max_integer_values
        small = [c for c, n in zip(integers, estimate) if n <= cutoff]
        if small:
            distinct = _long(df, small, "long").where("value IS NOT NULL").distinct()
            counts = dict(distinct.groupBy("field_id").count().collect())
            few = {c for i, c in enumerate(small) if counts.get(i, 0) <= max_integer_values}
    texts = set(text_columns(df))
    return [c for c in df.columns if c in texts or c in few]


def category_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field_id, value, count), with the NULLs of a field as a row of their own."""
    cells = _long(df, columns, "string")
    return cells.groupBy("field_id", "value").agg(F.count(F.lit(1)).alias("count"))


def _share(count: Column, total: Column) -> Column:
    return rounded(F.try_divide(count * 100.0, total), 2)


def category_distribution(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every value of every categorical column with count and percentage: the whole distribution."""
    columns = list(columns or category_columns(df))
    require_columns(df, columns)
    freq = category_frequencies(df, columns).where("value IS NOT NULL")
    totals = freq.groupBy("field_id").agg(F.sum("count").alias("total"))
    return (
        freq.join(F.broadcast(totals), "field_id")
        .join(F.broadcast(_fields(df, columns)), "field_id")
        .select(
            "data_field_name",
            F.col("value").alias("category_value"),
            "count",
            _share(F.col("count"), F.col("total")).alias("percentage"),
        )
    )


def categorical_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    profile: str = "categorical_profile",
    layer: str = "silver",
    table: str = "train",
) -> DataFrame:
    """Completeness, most and least frequent value and balance of every categorical column.

    On equal counts the value that sorts first is the more frequent one. How the values are distributed is
    a table of its own, ``category_distribution``: no row here grows with the number of values.
    """
    columns = list(columns or category_columns(df))
    require_columns(df, columns)
    freq = category_frequencies(df, columns)
    known = F.col("value").isNotNull()
    count = F.when(known, F.col("count"))
    by_frequency = F.when(known, F.struct(-F.col("count"), F.col("value")))
    zero = F.lit(0)
    stats = freq.groupBy("field_id").agg(
        F.sum("count").alias("total_records"),
        F.coalesce(F.sum(count), zero).alias("non_null_records"),
        F.coalesce(F.sum(F.when(~known, F.col("count"))), zero).alias("null_records"),
        F.count(count).alias("unique_values_count"),
        F.min_by("value", by_frequency).alias("most_frequent_category"),
        F.coalesce(F.max(count), zero).alias("most_frequent_count"),
        F.max_by("value", by_frequency).alias("least_frequent_category"),
        F.coalesce(F.min(count), zero).alias("least_frequent_count"),
    )
    stats = _fields(df, columns).join(F.broadcast(stats), "field_id", "left")

    number = lambda name: F.coalesce(F.col(name), zero).alias(name)
    non_null = F.col("non_null_records")
    percentage = lambda name: F.coalesce(_share(F.col(name), non_null), F.lit(0.0))
    ratio = F.coalesce(
        F.try_divide(F.col("most_frequent_count").cast("double"), F.col("least_frequent_count")),
        F.lit(0.0),
    )
    return stats.select(
        F.lit(profile).alias("name_of_profile"),
        F.lit(layer).alias("schema_name"),
        F.lit(table).alias("table_field_name"),
        "data_field_name",
        number("total_records"),
        number("non_null_records"),
        number("null_records"),
        F.coalesce(_share(F.col("null_records"), F.col("total_records")), F.lit(0.0)).alias("null_percentage"),
        number("unique_values_count"),
        "most_frequent_category",
        number("most_frequent_count"),
        percentage("most_frequent_count").alias("most_frequent_percentage"),
        "least_frequent_category",
        number("least_frequent_count"),
        percentage("least_frequent_count").alias("least_frequent_percentage"),
        ratio.alias("balance_ratio"),
        (ratio < 2.0).alias("is_balanced"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value of one column, most frequent first.

    The window over all groups would hold a whole high-cardinality column in one task, so the total
    is a one-row aggregate of the groups instead, read as a scalar subquery.
    """
    counts = df.where(ident(column).isNotNull()).groupBy(ident(column).alias("category_value"))
    counts = counts.agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select("*", _share(F.col("count"), total).alias("percentage")).orderBy(
        F.desc("count"), "category_value"
    )


def mean_baseline_error(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean absolute error of predicting each column's mean, over its non-zero values.

    ``df`` is computed once, into a table of these columns; the means and then the errors of all columns are
    one aggregate each. A column without such values has no row.
    """
    columns = list(columns)
    require_columns(df, columns)
    cells = [F.when(ident(c).cast("double") != 0, ident(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)]
    cells = written(df.select(*cells), "baseline")
    names = cells.columns
    # one number per column
    means = cells.agg(*[F.avg(n) for n in names]).first()
    errors = cells.agg(
        *[F.count(n) for n in names], *[F.avg(F.abs(F.col(n) - F.lit(mean))) for n, mean in zip(names, means)]
    ).first()
    rows = [(c, errors[i], means[i], errors[len(names) + i]) for i, c in enumerate(columns) if errors[i]]
    return df.sparkSession.createDataFrame(rows, "data_field_name string, rows long, mean_value double, mae double")
