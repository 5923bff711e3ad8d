"""Config-driven ingestion: one file set per table, each job on its own."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from pathlib import PurePosixPath

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propense.functions.columns import ident
from propense.session import scratch_path
from propense.sources.tables import TableStore, nan_to_null

STATUS_SCHEMA = "job string, layer string, table string, status string, rows long, rejected long, error string"


@dataclass(frozen=True)
class IngestJob:
    """Load one named sheet (a file or folder of files) into ``layer.table``, replacing it."""

    name: str
    layer: str
    table: str
    path: str
    sheet: str | None = None
    format: str = "csv"
    schema: str | T.StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    bad_rows: str = "reject"  # or "fail"

    def __post_init__(self) -> None:
        if self.bad_rows not in ("reject", "fail"):
            raise ValueError(f"bad_rows must be 'reject' or 'fail', not '{self.bad_rows}'")

    def location(self) -> str:
        if self.sheet is None:
            return self.path
        base = self.path
        # A workbook is exported as a folder of the same name, with one file per sheet.
        if PurePosixPath(base).suffix.lower() in (".xlsx", ".xls"):
            base = base.rsplit(".", 1)[0]
        return f"{base.rstrip('/')}/{self.sheet}.{self.format}"

    @classmethod
    def from_mapping(cls, raw: Mapping) -> IngestJob:
        # Key names of existing job files, next to the native ones.
        known = {
            "name": ("name", "job_name"),
            "layer": ("layer", "duckdb_schema"),
            "table": ("table", "duckdb_table"),
            "path": ("path", "excel_path"),
            "sheet": ("sheet", "excel_sheetname"),
            "format": ("format",),
            "schema": ("schema",),
            "options": ("options",),
            "bad_rows": ("bad_rows",),
        }
        given = {}
        for target, names in known.items():
            for name in names:
                if raw.get(name) is not None:
                    given[target] = raw[name]
        missing = [k for k in ("name", "layer", "table", "path") if k not in given]
        if missing:
            raise ValueError(f"ingestion job lacks {missing}: {dict(raw)}")
        return cls(**given)


def load_document(path: str, spark: SparkSession | None = None) -> dict:
    """A YAML or JSON job file: on the driver's disk, or with a session wherever Spark can read."""
    if spark is not None:
        text = spark.read.text(path, wholetext=True).first()[0]
    else:
        with open(path, encoding="utf-8") as handle:
            text = handle.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as err:
        raise ImportError("YAML job files need pyyaml; JSON files need nothing") from err
    return yaml.safe_load(text)


def load_jobs(path: str, spark: SparkSession | None = None) -> list[IngestJob]:
    return [IngestJob.from_mapping(raw) for raw in load_document(path, spark)["ingestion_jobs"]]


FILE, RECORD, TEXT = "_file", "_record", "_text"
_TORN = "_torn"
# Cells as the reader takes them from a line; what becomes of them is decided here.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _TORN,
    # Empty fields are NULL, quoted empty ones are empty texts: no text may stand for NULL.
    "nullValue": "\u0000",
}
# Options for values, which the cast applies and not the reader of cells.
VALUE_OPTIONS = ("dateformat", "timestampformat", "inferschema")


@dataclass
class Source:
    """Rows that fit their columns, and those that do not: file, record (of the file, from 1), reason, text."""

    rows: DataFrame
    rejected: DataFrame | None = None


def _csv_cells(spark: SparkSession, job: IngestJob) -> tuple[DataFrame, list[T.StructField] | None]:
    """Every cell as text, with its file and place, written once; and the columns that are asked for.

    A line with too few or too many cells has its text in ``_torn``.
    """
    options = CSV_OPTIONS | {k: v for k, v in job.options.items() if k.lower() not in VALUE_OPTIONS}
    reader = spark.read.options(**options)
    fields = None
    if job.schema is not None:
        wanted = T.StructType.fromDDL(job.schema) if isinstance(job.schema, str) else job.schema
        fields, names = list(wanted.fields), wanted.names
    else:
        names = reader.csv(job.location()).columns  # the header lines only
    cells = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _TORN]])
    place = {FILE: F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    raw = reader.schema(cells).csv(job.location()).withColumns(place | {"_row": F.monotonically_increasing_id()})
    path = scratch_path(spark, "cells")
    raw.write.parquet(path)
    return spark.read.schema(raw.schema).parquet(path), fields


def _found_types(cells: DataFrame, names: list[str]) -> list[T.StructField]:
    """The narrowest type that all cells of a column read as, by one aggregate over the stored cells."""
    tests: dict[str, Callable[[Column], Column]] = {
        "int": lambda c: c.rlike(r"^[+-]?[0-9]+$") & c.try_cast("int").isNotNull(),
        "bigint": lambda c: c.rlike(r"^[+-]?[0-9]+$") & c.try_cast("bigint").isNotNull(),
        "double": lambda c: c.rlike(r"^(?:[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[Nn]a[Nn]|-?Infinity)$"),
        "date": lambda c: c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull(),
        "timestamp": lambda c: c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}") & c.try_cast("timestamp").isNotNull(),
        "boolean": lambda c: F.lower(c).isin("true", "false"),
    }
    sound = cells.where(F.col(_TORN).isNull())
    found = []
    for k, name in enumerate(names):
        cell = F.trim(ident(name))
        there = cell != ""
        found.append(F.count_if(there).alias(f"n{k}"))
        found += [F.count_if(there & test(cell)).alias(f"{kind}{k}") for kind, test in tests.items()]
    row = sound.agg(*found).first()
    kinds = [
        next((kind for kind in tests if row[f"n{k}"] and row[f"{kind}{k}"] == row[f"n{k}"]), "string")
        for k in range(len(names))
    ]
    return list(T.StructType.fromDDL(", ".join(f"c{k} {kind}" for k, kind in enumerate(kinds))).fields)


def _cast(cell: Column, kind: T.DataType, options: Mapping[str, str]) -> Column:
    """NULL where the text is no such value. Blanks around numbers and dates do not count."""
    if isinstance(kind, T.StringType):
        return cell
    given = {k.lower(): v for k, v in options.items()}
    text = F.trim(cell)
    if isinstance(kind, T.DateType) and "dateformat" in given:
        return F.try_to_timestamp(text, F.lit(given["dateformat"])).cast("date")
    if isinstance(kind, T.TimestampType) and "timestampformat" in given:
        return F.try_to_timestamp(text, F.lit(given["timestampformat"]))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # Spark alone would read '1d' as 1
        text = F.when(~text.rlike("[dDfF]$") | text.rlike("^-?[Ii]nf"), text)
    return text.try_cast(kind)


def _records(cells: DataFrame) -> DataFrame:
    """The number of each row in its file. Rows of a block of a file are read one after the other."""
    blocks = cells.groupBy(FILE, "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    end = F.sum("_n").over(Window.partitionBy(FILE).orderBy("_block"))
    return blocks.select(FILE, "_block", (end - F.col("_n") - F.col("_first") + 1).alias("_shift"))


def read_source(spark: SparkSession, job: IngestJob) -> Source:
    """The rows of a job's files.

    CSV files are read once, into cells of text; their types are the job's, or found from the stored cells.
    A row that has too few or too many cells, or a cell that is no value of its column's type, is rejected
    with its file and record; texts with line breaks need the option ``multiLine``. A job whose
    ``bad_rows`` is "fail" fails on the first of those instead. An empty cell is NULL.
    """
    if job.format != "csv":
        reader = spark.read.format(job.format).options(**job.options)
        if job.schema is not None:
            reader = reader.schema(job.schema)
        return Source(nan_to_null(reader.load(job.location())))
    cells, fields = _csv_cells(spark, job)
    names = [c for c in cells.columns if c not in (_TORN, FILE, "_block", "_row")]
    if fields is None:
        fields = _found_types(cells, names)
    values = {name: _cast(ident(name), f.dataType, job.options) for name, f in zip(names, fields)}
    reason = F.when(F.col(_TORN).isNotNull(), F.lit("the line does not have the columns' number of cells"))
    for name, f in zip(names, fields):
        if not isinstance(f.dataType, T.StringType):
            odd = values[name].isNull() & (F.trim(ident(name)) != "")
            reason = reason.when(odd, F.concat(F.lit(f"{name} is no {f.dataType.simpleString()}: "), ident(name)))
    judged = cells.withColumn("_reason", reason)
    rows = judged.where("_reason IS NULL").select(*[value.alias(name) for name, value in values.items()])
    text = F.coalesce(ident(_TORN), F.to_json(F.struct(*[ident(n) for n in names])))
    odd = judged.where("_reason IS NOT NULL")
    rejected = odd.join(_records(cells), [FILE, "_block"]).select(
        F.col(FILE).alias("file"),
        (F.col("_row") + F.col("_shift")).alias("record"),
        F.col("_reason").alias("reason"),
        text.alias("text"),
    )
    if job.bad_rows == "fail":
        first = rejected.orderBy("file", "record").first()
        if first is not None:
            raise ValueError(f"{first['file']}, record {first['record']}: {first['reason']}")
        rejected = None
    return Source(nan_to_null(rows), rejected)


def rejects_table(table: str) -> str:
    return f"{table}_rejected"


def _run(store: TableStore, job: IngestJob) -> tuple:
    where = (job.name, job.layer, job.table)
    try:
        source = read_source(store.spark, job)
        rows = store.replace(source.rows, job.layer, job.table)
        rejected = 0
        if source.rejected is not None and not source.rejected.isEmpty():
            rejected = store.replace(source.rejected, job.layer, rejects_table(job.table))
        return (*where, "ok", rows, rejected, None)
    except Exception as err:  # noqa: BLE001 - any failure belongs to its own job only
        return (*where, "failed", None, None, str(err).split("\n")[0])


def run_jobs(store: TableStore, jobs: Iterable[IngestJob], parallelism: int = 4) -> DataFrame:
    """Run the jobs, several at a time; one that fails is reported and the rest go on.

    Rows that do not fit go to ``<table>_rejected``, with file, record, reason and text.
    """
    jobs = list(jobs)
    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        run = inheritable_thread_target(store.spark)(lambda job: _run(store, job))
        status = pool.map(run, jobs, chunksize=1)
    return store.spark.createDataFrame(status, STATUS_SCHEMA)
