"""Reading and writing layered tables (``bronze``, ``silver``, ``models``, ...)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propense.functions.columns import ident, require_columns
from propense.sources.snapshots import Snapshots


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing cells of a raw file arrive as NaN; every later rule treats them as NULL."""
    return df.select(
        *[
            F.when(~F.isnan(ident(f.name)), ident(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType))
            else ident(f.name)
            for f in df.schema.fields
        ]
    )


def scan(df: DataFrame, non_zero: str | None = None) -> DataFrame:
    """Whole table, or only the rows where ``non_zero`` is neither NULL nor 0."""
    if non_zero is None:
        return df
    require_columns(df, [non_zero])
    return df.where(ident(non_zero).isNotNull() & (ident(non_zero) != 0))


def select_available(df: DataFrame, key: str, wanted: Sequence[str]) -> DataFrame:
    """Key plus those wanted columns that exist; raises where none does."""
    have = {c.lower() for c in df.columns}
    found = [c for c in wanted if c.lower() in have and c.lower() != key.lower()]
    if not found:
        raise ValueError(f"none of the requested columns exists: {list(wanted)}")
    return df.select(ident(key), *[ident(c) for c in found])


def rename_repeats(columns: Sequence[str]) -> list[str]:
    """Names for a select list with repeats, which no table or file could hold: a, a -> a, a_1."""
    taken = {c.lower() for c in columns}
    used: set[str] = set()
    out = []
    for name in columns:
        new, i = name, 0
        while new.lower() in used or (i > 0 and new.lower() in taken):
            i += 1
            new = f"{name}_{i}"
        used.add(new.lower())
        out.append(new)
    return out


@dataclass(frozen=True)
class TableStore:
    """Tables by layer: in the session catalog, or as snapshots below ``root`` where one is given."""

    spark: SparkSession
    root: str | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def snapshots(self, layer: str, table: str) -> Snapshots:
        return Snapshots(self.spark, self.path(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        if self.root is None:
            return self.spark.catalog.tableExists(f"{layer}.{table}")
        return self.snapshots(layer, table).exists()

    def require(self, *names: tuple[str, str]) -> None:
        """Raise with the list of tables a step needs but does not find."""
        missing = [f"{layer}.{table}" for layer, table in names if not self.exists(layer, table)]
        if missing:
            raise ValueError(f"required tables not found: {missing}")

    def read(self, layer: str, table: str) -> DataFrame:
        if self.root is None:
            return self.spark.table(f"{layer}.{table}")
        return self.snapshots(layer, table).read()

    def replace(
        self, df: DataFrame, layer: str, table: str, bucket_by: str | None = None, buckets: int = 0
    ) -> int:
        """Write the table anew; returns the row count, observed during the write itself.

        The old rows stay until the new ones are there, so a write that fails changes nothing and a table
        can be replaced from itself. A catalog table joined on one key over and over is worth bucketing on
        it: the joins of the silver and decision stages then need no shuffle.
        """
        if self.root is not None:
            return self.snapshots(layer, table).replace(df)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        observed = Observation()
        writer = df.observe(observed, F.count(F.lit(1)).alias("rows")).write
        if bucket_by and buckets:
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        # another name first: the old table goes only when the new one is whole
        new = f"{layer}.{table}__{uuid.uuid4().hex}"
        try:
            writer.saveAsTable(new)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {new}")
            raise
        self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}")
        self.spark.sql(f"ALTER TABLE {new} RENAME TO {layer}.{table}")
        return observed.get["rows"]

    def append(self, df: DataFrame, layer: str, table: str) -> None:
        """Add rows to a history table, making it on first use; columns that either side lacks are NULL."""
        if self.root is None:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            name = f"{layer}.{table}"
            if self.spark.catalog.tableExists(name):
                old = {f.name.lower(): f.dataType for f in self.spark.table(name).schema.fields}
                new = [f for f in df.schema.fields if f.name.lower() not in old]
                if new:
                    added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
                    self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
                have = {c.lower() for c in df.columns}
                df = df.withColumns({c: F.lit(None).cast(t) for c, t in old.items() if c not in have})
                df = df.select(*[ident(c) for c in self.spark.table(name).columns])
            df.write.mode("append").saveAsTable(name)
        else:
            self.snapshots(layer, table).append(df)

    def preview(self, layer: str, table: str, n: int = 5) -> DataFrame:
        return self.read(layer, table).limit(n)
