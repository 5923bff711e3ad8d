"""Train and holdout tables out of the raw tables.

All inputs carry the key once per row (the ``unique`` quality rule), so every join here is one-to-one
and cannot fan out or skew. Spark picks broadcast or sort-merge from sizes; with all inputs hashed (or
bucketed) on the key, each is shuffled at most once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from propense.functions.columns import require_columns


def train_table(sales: DataFrame, details: Sequence[DataFrame], key: str) -> DataFrame:
    """Every sales row, with what the detail tables know of the customer (NULL where nothing)."""
    joined = sales
    for table in [sales, *details]:
        require_columns(table, [key])
    for table in details:
        joined = joined.join(table, key, "left")
    return joined


def holdout_table(
    profile: DataFrame, details: Sequence[DataFrame], sales: DataFrame, key: str
) -> DataFrame:
    """Customers present in all detail tables and absent from sales."""
    for table in [profile, *details, sales]:
        require_columns(table, [key])
    joined = profile.join(sales.select(key), key, "left_anti")
    for table in details:
        joined = joined.join(table, key)
    return joined
