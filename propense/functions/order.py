"""Seeded ranks without sorting a whole group in one task: only rows of one slot are put in order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propense.functions.columns import ident
from propense.session import written

def small_table(spark: SparkSession, columns: str, rows: Iterable[tuple]) -> DataFrame:
    """A handful of numbers held by the driver, as a local relation. ``columns``: "a int, b double"."""
    types = [c.split() for c in columns.split(",")]

    def literal(value, kind: str) -> str:
        return f"CAST({'NULL' if value is None else repr(str(value))} AS {kind})"

    body = ", ".join(
        "(" + ", ".join(literal(v, kind) for v, (_, kind) in zip(row, types)) + ")" for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(name for name, _ in types)})")


def rank_by_hash(df: DataFrame, key: str, seed: int, strata: str | None = None) -> DataFrame:
    """Adds ``shuffled_rank``, each row's 0-based place in a seeded shuffle within its stratum, and
    ``stratum_size``.

    ``key`` must be unique. Hash prefixes serve as slots, and a hash fills them evenly, so each task
    orders about 1/16,384 of the rows, also where one stratum has most of them. A NULL stratum is one of
    its own. ``df`` is read once, into a table of the shared folder; the slots are counted on that. The table
    of slot totals has at most 16,384 rows per stratum; Spark chooses how to join it.
    """
    group = [ident(strata).alias("_stratum")] if strata else []
    names = ["_stratum"] if strata else []
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), ident(key)))
    hashed = written(hashed.withColumn("_slot", F.shiftright("_hash", 50).cast("int")), "ranked")
    totals = hashed.groupBy(*group, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    within = Window.partitionBy(*names)
    totals = totals.select(
        *[F.col(n).alias("_of") for n in names],
        F.col("_slot").alias("_part"),
        (F.sum("_n").over(within.orderBy("_slot")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(within).alias("stratum_size"),
    )
    place = F.row_number().over(
        Window.partitionBy(*[ident(c) for c in ([strata] if strata else [])], "_slot").orderBy("_hash", ident(key))
    )
    same = F.col("_slot") == F.col("_part")
    if strata:
        same &= ident(strata).eqNullSafe(F.col("_of"))
    return (
        hashed.withColumn("_place", place)
        .join(totals, same)
        .withColumn("shuffled_rank", F.col("_before") + F.col("_place") - 1)
        .select(*[ident(c) for c in df.columns], "shuffled_rank", "stratum_size")
    )
