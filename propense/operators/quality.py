"""Declarative data checks, compiled to two aggregations per table.

A spec names a field and its rules. Rules that judge a row by itself become conditional counts, and all
of them on a table share a single scan and a single one-row aggregate; the fields that must be ``unique``
share another scan, as grouping sets of one aggregate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propense.functions.casting import reads_as_datetime, reads_as_number
from propense.functions.columns import TEXTUAL, ident, resolve
from propense.sources.ingest import load_document

# Names of the value types a field can be checked for.
VALUE_TYPES = ("numerical", "datetime", "string")


@dataclass(frozen=True)
class Rule:
    """One rule on a field; ``argument`` is the allowed values, the type name or the partner field."""

    kind: str
    argument: Any = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown rule '{self.kind}', known are {sorted(KINDS)}")
        if self.kind in NEEDS_ARGUMENT and not self.argument:
            raise ValueError(f"rule '{self.kind}' needs {NEEDS_ARGUMENT[self.kind]}")
        if self.kind == "type" and self.argument not in VALUE_TYPES:
            raise ValueError(f"type must be one of {VALUE_TYPES}, not '{self.argument}'")

    @property
    def suffix(self) -> str:
        named = self.kind in ("type", "sync_null", "sync_zero")
        return f"{self.kind}_{self.argument}" if named else self.kind


@dataclass(frozen=True)
class FieldSpec:
    """All rules for one field of one table."""

    name: str
    table: str
    field: str
    rules: tuple[Rule, ...]
    layer: str = "bronze"
    database: str = "lake"

    @classmethod
    def from_mapping(cls, raw: Mapping) -> FieldSpec:
        """Read one entry of a rule file.

        Every enabled rule is validated, also where the entry leaves its argument out altogether.
        """
        # Key names of existing rule files.
        switches = {
            "unique": ("is_check_unique", None),
            "enum": ("is_check_enum", "enum_values"),
            "positive": ("is_check_positive", None),
            "non_null": ("is_check_null", None),
            "type": ("is_check_type", "df_type"),
            "sync_null": ("is_sync_null", "sync_null_field"),
            "sync_zero": ("is_sync_zero", "sync_zero_field"),
            "non_zero": ("is_zero_check", None),
        }
        rules = []
        for kind, (switch, argument) in switches.items():
            if raw.get(switch, False):
                value = raw.get(argument) if argument else None
                rules.append(Rule(kind, tuple(value) if isinstance(value, list) else value))
        return cls(
            name=raw["check_name"],
            table=raw["table_name"],
            field=raw["data_field_name"],
            rules=tuple(rules),
            layer=raw["schema_name"],
            database=raw["database_name"],
        )


def load_specs(path: str) -> list[FieldSpec]:
    return [FieldSpec.from_mapping(raw) for raw in load_document(path)["quality_checks"]]


def _literal(value: Any) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return repr(value)


def _name(field: str) -> str:
    return "`" + field.replace("`", "``") + "`"


def _type(field: str, dtype: T.DataType, name: str) -> str:
    if name == "string":
        return "true"  # every value has a text form
    reads = reads_as_number if name == "numerical" else reads_as_datetime
    return f"{field} IS NULL OR {reads(field, dtype)}"


# What makes a row pass, as SQL text: a rule file of hundreds of checks is then one call per table.
ROW_RULES: dict[str, Callable[[str, T.DataType, Any], str]] = {
    "enum": lambda c, _t, values: f"{c} IN ({', '.join(map(_literal, values))}) OR {c} IS NULL",
    "positive": lambda c, _t, _a: f"{c} >= 0 OR {c} IS NULL",  # "not negative", by its long use
    "non_null": lambda c, _t, _a: f"{c} IS NOT NULL",
    "type": _type,
    "sync_null": lambda c, _t, other: f"({c} IS NULL) = ({_name(other)} IS NULL)",
    "sync_zero": lambda c, _t, other: f"coalesce(({c} = 0) = ({_name(other)} = 0), true)",
    "non_zero": lambda c, _t, _a: f"{c} <> 0 OR {c} IS NULL",
}
KINDS = {"unique", *ROW_RULES}
ON_NUMBERS = {"positive", "sync_zero", "non_zero"}
NEEDS_ARGUMENT = {
    "enum": "a list of allowed values",
    "type": "a type name",
    "sync_null": "a partner field",
    "sync_zero": "a partner field",
}


def _check_applies(df: DataFrame, spec: FieldSpec) -> None:
    """Raise what would otherwise fail in the middle of the shared scan."""
    field = resolve(df, spec.field)
    if field is None:
        raise ValueError(f"{spec.layer}.{spec.table} has no field '{spec.field}'")
    for rule in spec.rules:
        involved = [field]
        if rule.kind in ("sync_null", "sync_zero"):
            partner = resolve(df, rule.argument)
            if partner is None:
                raise ValueError(f"{spec.layer}.{spec.table} has no field '{rule.argument}'")
            involved.append(partner)
        if rule.kind in ON_NUMBERS:
            for f in involved:
                if not isinstance(f.dataType, T.NumericType):
                    raise ValueError(f"rule '{rule.kind}' needs numbers, '{f.name}' is not one")
        if rule.kind == "enum":
            textual = isinstance(field.dataType, TEXTUAL) and not isinstance(field.dataType, T.BooleanType)
            if any(isinstance(v, str) != textual for v in rule.argument):
                raise ValueError(f"allowed values of '{spec.field}' do not match its type")


RESULT = (
    "database_name string, schema_name string, table_name string, data_field_name string, total_records long, "
    "check_type string, records_passed long, records_failed long, check_name string"
)
# Sets of one grouping are told apart by the bits of a long.
GROUPED_AT_ONCE = 32


def _row_counts(df: DataFrame, checks: Sequence[tuple[FieldSpec, Rule]]) -> list[tuple[int, int]]:
    """(rows, rows that pass) of each rule: one scan and a one-row aggregate for all of them."""
    counts = ["count(1) AS total"]
    for i, (spec, rule) in enumerate(checks):
        passes = ROW_RULES[rule.kind](_name(spec.field), resolve(df, spec.field).dataType, rule.argument)
        counts.append(f"count_if({passes}) AS passed_{i}")
    row = df.selectExpr(*counts).first()
    return [(row["total"], row[i + 1]) for i in range(len(checks))]


def _unique_counts(df: DataFrame, checks: Sequence[tuple[FieldSpec, Rule]]) -> list[tuple[int, int]]:
    """(rows, values that occur exactly once) of each field; NULL is one value.

    All fields of a table are grouping sets of one aggregate: one scan and one exchange, to which a value
    that fills a third of the table is one row per task.
    """
    fields = list(dict.fromkeys(resolve(df, spec.field).name for spec, _ in checks))
    found: dict[str, tuple[int, int]] = {}
    for k in range(0, len(fields), GROUPED_AT_ONCE):
        some = fields[k : k + GROUPED_AT_ONCE]
        names = [f"_{i}" for i in range(len(some))]
        cells = df.select(*[ident(f).alias(n) for f, n in zip(some, names)])
        sizes = cells.groupingSets([[n] for n in names], *names).agg(
            F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_size")
        )
        counted = sizes.groupBy("_set").agg(F.sum("_size").alias("total"), F.count_if(F.col("_size") == 1).alias("passed"))
        by_set = {r["_set"]: (r["total"], r["passed"]) for r in counted.collect()}
        # the bit of the one field that is grouped by is not set
        whole = (1 << len(some)) - 1
        found |= {f: by_set.get(whole ^ (1 << len(some) - 1 - i), (0, 0)) for i, f in enumerate(some)}
    return [found[resolve(df, spec.field).name] for spec, _ in checks]


def _measured(df: DataFrame, specs: Sequence[FieldSpec]) -> list[tuple]:
    """Result rows of all rules of the specs, in their order."""
    checks = [(spec, rule) for spec in specs for rule in spec.rules]
    counts: dict[int, tuple[int, int]] = {}
    for measure, unique in ((_row_counts, False), (_unique_counts, True)):
        mine = [i for i, (_, rule) in enumerate(checks) if (rule.kind == "unique") == unique]
        if mine:
            counts |= dict(zip(mine, measure(df, [checks[i] for i in mine])))
    rows = []
    for i, (spec, rule) in enumerate(checks):
        total, passed = counts[i]
        where = (spec.database, spec.layer, spec.table, spec.field)
        rows.append((*where, total, rule.kind, passed, total - passed, f"{spec.name}_{rule.suffix}"))
    return rows


def _reason(err: Exception) -> str:
    return str(err).split("\n")[0]


def _isolated(df: DataFrame, specs: Sequence[FieldSpec], failures: dict[str, str]) -> list[tuple]:
    """Results of the specs that run; where their shared jobs fail, they are halved until the cause is alone."""
    try:
        return _measured(df, specs)
    except Exception as err:  # noqa: BLE001 - a failure belongs to its own spec only
        if len(specs) == 1:
            failures[specs[0].name] = _reason(err)
            return []
    half = len(specs) // 2
    return _isolated(df, specs[:half], failures) + _isolated(df, specs[half:], failures)


def check_table(df: DataFrame, specs: Sequence[FieldSpec]) -> DataFrame:
    """Results of all specs on one table: one scan for rules on rows, one more for all ``unique`` fields."""
    for spec in specs:
        _check_applies(df, spec)
    return df.sparkSession.createDataFrame(_measured(df, specs), RESULT)


def _check_one(read: Callable[[str, str], DataFrame], where: tuple[str, str], specs: Sequence[FieldSpec]):
    """(session, result rows, failures) of one table's specs."""
    failures: dict[str, str] = {}
    try:
        df = read(*where)
    except Exception as err:  # noqa: BLE001 - without its table no spec can run
        return None, [], {spec.name: _reason(err) for spec in specs}
    fitting = []
    for spec in specs:
        try:
            _check_applies(df, spec)
        except Exception as err:  # noqa: BLE001
            failures[spec.name] = _reason(err)
            continue
        fitting.append(spec)
    try:
        rows = _measured(df, fitting)
    except Exception:  # noqa: BLE001 - found out below
        try:
            _row_counts(df, [])
        except Exception as err:  # noqa: BLE001 - the table cannot be read at all
            return df.sparkSession, [], failures | {spec.name: _reason(err) for spec in fitting}
        rows = _isolated(df, fitting, failures) if fitting else []
    return df.sparkSession, rows, failures


def run_checks(
    read: Callable[[str, str], DataFrame], specs: Iterable[FieldSpec], parallelism: int = 8
) -> tuple[DataFrame | None, dict[str, str]]:
    """All specs over all their tables; ``read(layer, table)`` gives a table.

    Tables are read and checked side by side, each in a job group of its own. A spec that cannot run, or
    that fails only while it runs, is returned with its reason and has no results; the rest go on. The
    results, a row per check, have a time stamp; a check passed if and only if it has no failed record.
    """
    by_table: dict[tuple[str, str], list[FieldSpec]] = {}
    for spec in specs:
        by_table.setdefault((spec.layer, spec.table), []).append(spec)
    spark = SparkSession.active()

    def check(where: tuple[str, str]):
        spark.sparkContext.setJobGroup(f"checks-{uuid.uuid4().hex}", f"checks of {'.'.join(where)}")
        return _check_one(read, where, by_table[where])

    rows: list[tuple] = []
    failures: dict[str, str] = {}
    with ThreadPool(max(1, min(parallelism, len(by_table)))) as pool:
        for session, found, failed in pool.map(inheritable_thread_target(spark)(check), by_table, chunksize=1):
            spark = session or spark
            rows += found
            failures |= failed
    if not rows:
        return None, failures
    return spark.createDataFrame(rows, RESULT).withColumn("check_timestamp", F.current_timestamp()), failures


def summary(results: DataFrame) -> DataFrame:
    """Checks, failed records and records looked at, per kind of check."""
    return (
        results.groupBy("check_type")
        .agg(
            F.count(F.lit(1)).alias("total_checks"),
            F.sum("records_failed").alias("total_failures"),
            F.sum("total_records").alias("total_records_checked"),
        )
        .orderBy("check_type")
    )
