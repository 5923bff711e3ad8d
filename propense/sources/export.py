"""Query results and metrics to files, and the status envelope of ad-hoc SQL."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propense.functions.columns import ident
from propense.session import cut_lineage, written
from propense.sources.tables import rename_repeats

# Fixed value: time stamp in default file names.
FILE_STAMP = "%Y%m%d_%H%M%S"


@dataclass(frozen=True)
class SqlResult:
    """Status 1 with a frame, or status 0 with the error text."""

    status: int
    query: DataFrame | str


def _kept(df: DataFrame) -> DataFrame:
    """As columns where files can hold its types, else as rows."""
    kinds = {f.name: "string" for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    try:
        return written(df.withColumns({c: ident(c).cast(kind) for c, kind in kinds.items()}), "query")
    except AnalysisException:
        return cut_lineage(df)


def run_sql(spark: SparkSession, text: str) -> SqlResult:
    """Run a query into the shared folder; its frame reads what was written, so it runs once.

    Repeated column names are numbered so they can be saved. An error that only shows while the query runs has
    status 0 as well.
    """
    try:
        df = spark.sql(text)
        if not df.columns:  # a command
            return SqlResult(1, df)
        if len({c.lower() for c in df.columns}) < len(df.columns):
            df = df.toDF(*rename_repeats(df.columns))
        return SqlResult(1, _kept(df))
    except PySparkException as err:
        return SqlResult(0, str(err))


def save_result(result: SqlResult, folder: str, name: str | None = None) -> str:
    """Write a query result as CSV below ``folder``; a failed query raises here."""
    if result.status != 1:
        raise ValueError(f"query failed: {result.query}")
    return export_csv(result.query, folder, name or f"query_result_{datetime.now():{FILE_STAMP}}")


def export_csv(df: DataFrame, folder: str, name: str) -> str:
    """A folder of CSV part files, written by the executors in parallel.

    Empty text and NULL are told apart: NULL is an empty field, empty text is ``""``. A quote inside a text
    is doubled, as other readers expect it; texts with line breaks are read again with ``multiLine``.
    """
    path = f"{folder.rstrip('/')}/{name}"
    options = {"header": "true", "emptyValue": '""', "escape": '"'}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}  # keep blanks
    df.write.mode("overwrite").options(**options).csv(path)
    return path


def export_scores(df: DataFrame, folder: str, name: str) -> str:
    """Scores with the time they were made, in a time-stamped folder."""
    stamped = df
    if "prediction_timestamp" not in df.columns:
        stamped = df.withColumn("prediction_timestamp", iso_now())
    return export_csv(stamped, folder, f"{name}_{datetime.now():{FILE_STAMP}}")


def export_json(df: DataFrame, path: str) -> str:
    """Rows as JSON lines; one row of model metrics is one document."""
    df.write.mode("overwrite").json(path)
    return path


def iso_now():
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def join_names(names) -> str:
    """List of names as the text kept in a history row."""
    return ",".join(names)


def split_names(col):
    """The reverse, tolerant of blanks around the commas."""
    # A lambda of one argument: given F.trim itself, the index would become the characters to trim.
    return F.transform(F.split(col, ","), lambda name: F.trim(name))
