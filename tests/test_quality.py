import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from propense.functions.casting import reads_as_datetime, reads_as_number
from propense.operators.quality import FieldSpec, Rule, check_table, run_checks, summary
from propense.plans.oracles import quality_results

NUMBERS = (
    "1|1.5|-1| 2 |+3|1e5|1E-3|.5|5.|1_000|1__0|_1|1d|1f|0x1F|inf|-inf|Infinity|nan|NaN|1,000|||  |e5|1e|"
    "1.e5|1e400|1_000.5_5|1.5_|true|1 2|1e+5|--1|abc|12 months"
).split("|")
DATES = (
    "2024-01-05|2024-1-5|2024/01/05|2024|2024-01|20240105|2024-02-30|24-01-05| 2024-01-05 |"
    "2024-01-05 10:00|2024-01-05 10:00:00|2024-01-05T10:00:00Z|2024-01-05T10:00|2024-01-05 10|"
    "2024-01-05 25:00:00|2024-01-05 10:00:00.123456|2024-01-05 10:00:00+02|2024-01-05 10:00:00+02:30|"
    "epoch|infinity|2024.01.05|2024 01 05|2024-01-05x|12024-01-05|0001-01-01|10:00:00|05/01/2024|"
    "2024-01-05 24:00:00|2024-13-01|2024-01-05T|2024-01-05 10:00:60|2024-01-05 1:2:3|now|99-01-05|abc"
).split("|")


def spec(*rules, field="a", table="t"):
    return FieldSpec(f"{table}_{field}", table, field, rules)


@pytest.mark.parametrize(
    "reads, sql, texts",
    [
        (reads_as_number, "TRY_CAST(a AS DOUBLE) IS NOT NULL", NUMBERS),
        (
            reads_as_datetime,
            "TRY_CAST(a AS DATE) IS NOT NULL OR TRY_CAST(a AS TIMESTAMP) IS NOT NULL",
            DATES,
        ),
    ],
)
def test_reads_as(spark, reads, sql, texts):
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    got = dict(df.selectExpr("a", reads("a", df.schema["a"].dataType)).collect())
    con = duckdb.connect()
    want = {t: con.execute(f"SELECT {sql} FROM (SELECT ?::VARCHAR AS a)", [t]).fetchone()[0] for t in texts}
    assert {t for t in want if got[t] != want[t]} == set()


CELL = st.one_of(st.none(), st.sampled_from([-1.5, 0.0, 0.5, 1.0, 2.0]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(CELL, CELL), max_size=12))
def test_rules_agree_with_sql(spark, rows):
    specs = [
        spec(
            Rule("unique"),
            Rule("enum", (0.0, 1.0)),
            Rule("positive"),
            Rule("non_null"),
            Rule("type", "numerical"),
            Rule("type", "string"),
            Rule("sync_null", "b"),
            Rule("sync_zero", "b"),
            Rule("non_zero"),
        )
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a DOUBLE, b DOUBLE)")
    if rows:
        con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    want = sorted(con.execute(quality_results(specs)).fetchall())
    got = check_table(spark.createDataFrame(rows, "a double, b double"), specs)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_spec_is_validated():
    for bad in (("enum", None), ("type", None), ("type", "money"), ("sync_null", None), ("near", 1)):
        with pytest.raises(ValueError):
            Rule(*bad)
    entry = dict(
        check_name="c", database_name="d", schema_name="s", table_name="t", data_field_name="f"
    )
    with pytest.raises(ValueError):  # the list is left out altogether
        FieldSpec.from_mapping({**entry, "is_check_enum": True})
    read = FieldSpec.from_mapping(
        {**entry, "is_check_enum": True, "enum_values": ["M", "F"], "is_sync_null": False, "is_check_null": True}
    )
    assert [r.kind for r in read.rules] == ["enum", "non_null"]
    assert read.rules[0].argument == ("M", "F")


def test_failing_specs_are_isolated(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "a int, b string")

    def read(layer, table):
        if table != "t":
            raise ValueError(f"no table {table}")
        return df

    good = spec(Rule("non_null"))
    bad = [
        spec(Rule("non_null"), field="missing"),
        spec(Rule("non_null"), table="absent"),
        spec(Rule("positive"), field="b"),
        spec(Rule("enum", (1, 2)), field="b"),
        spec(Rule("sync_null", "gone")),
    ]
    bad = [FieldSpec(f"bad{i}", s.table, s.field, s.rules) for i, s in enumerate(bad)]
    results, failures = run_checks(read, [good, *bad])
    row = results.first()
    assert (row["records_passed"], row["records_failed"], row["check_name"]) == (1, 1, "t_a_non_null")
    assert set(failures) == {s.name for s in bad}
    total = summary(results).first()
    assert (total["total_checks"], total["total_failures"], total["total_records_checked"]) == (1, 1, 2)


def test_names_ignore_case_and_text_is_escaped(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("no",)], "Sex string")
    row = check_table(df, [spec(Rule("enum", ("it's", "a\\b")), field="sex")]).first()
    assert row["records_passed"] == 2


def test_hot_value(spark):
    """A third of the rows share one value: it is one value that is not unique."""
    df = spark.range(30000).selectExpr("if(id % 3 = 0, -1, id) AS a")
    row = check_table(df, [spec(Rule("unique"))]).first()
    assert (row["total_records"], row["records_passed"]) == (30000, 20000)
