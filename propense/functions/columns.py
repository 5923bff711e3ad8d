"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
TEXTUAL = (T.StringType, T.CharType, T.VarcharType, T.BooleanType)


def ident(name: str) -> Column:
    """Column by literal name, also where the name holds dots or starts with a digit."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def integral_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, INTEGRAL)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TEXTUAL)]


def require_columns(df: DataFrame, names: list[str]) -> None:
    """Raise with every missing name; matching ignores case, as Spark's own resolution does."""
    have = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise ValueError(f"columns not found: {missing}")


def resolve(df: DataFrame, name: str) -> T.StructField | None:
    """The schema field for ``name``, ignoring case."""
    return next((f for f in df.schema.fields if f.name.lower() == name.lower()), None)


def rounded(value: Column, digits: int) -> Column:
    """Half away from zero on the scaled double, as SQL engines with binary rounding do.

    Spark's own ROUND goes by the shortest decimal text: 1.025 becomes 1.03 there and 1.02 here, as the
    double is a little below.
    """
    scale = float(10**digits)
    return F.round(value * scale) / scale
