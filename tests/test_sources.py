import json
import uuid

import pytest

from propense.session import cut_lineage, scratch_path, shared_folder
from propense.sources import export, ingest, tables


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, None)], "a double, b int")
    assert [tuple(r) for r in tables.nan_to_null(df).collect()] == [(None, 1), (2.0, None)]


def test_scan_and_projection(spark):
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 5.0)], "client int, r double")
    assert [r["client"] for r in tables.scan(df, non_zero="r").collect()] == [3]
    assert tables.select_available(df, "client", ["gone", "R", "client"]).columns == ["client", "R"]
    with pytest.raises(ValueError, match="none of"):
        tables.select_available(df, "client", ["gone"])


def test_filters_and_columns_reach_the_files(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = tables.select_available(tables.scan(lines, non_zero="l_tax"), "l_orderkey", ["l_discount"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(l_tax,0.0))" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_discount:double,l_tax:double>" in plan


def test_repeated_names():
    assert tables.rename_repeats(["a", "b", "A", "a", "a_1"]) == ["a", "b", "A_2", "a_3", "a_1"]


def test_store(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    assert not store.exists("silver", "t")
    with pytest.raises(ValueError, match="silver.t"):
        store.require(("silver", "t"))
    assert store.replace(spark.range(5), "silver", "t") == 5
    assert store.replace(spark.range(3), "silver", "t") == 3
    store.append(spark.range(2), "silver", "t")
    assert store.read("silver", "t").count() == 5
    assert store.preview("silver", "t", 2).count() == 2


def _failing(spark):
    """Rows of which some cannot be computed, after others have been written."""
    return spark.range(1000).selectExpr("id DIV (id - 990) AS id")


def test_a_failed_write_changes_nothing(spark, tmp_path):
    layer = f"fail_{uuid.uuid4().hex}"
    for store in (tables.TableStore(spark, str(tmp_path)), tables.TableStore(spark)):
        store.replace(spark.range(5), layer, "t")
        for write in (store.replace, store.append):
            with pytest.raises(Exception, match="ZERO"):
                write(_failing(spark), layer, "t")
            assert sorted(r[0] for r in store.read(layer, "t").collect()) == list(range(5))
    assert [t.name for t in spark.catalog.listTables(layer) if not t.isTemporary] == ["t"]
    spark.sql(f"DROP DATABASE {layer} CASCADE")
    with pytest.raises(Exception, match="ZERO"):
        tables.TableStore(spark, str(tmp_path)).replace(_failing(spark), layer, "new")
    assert not tables.TableStore(spark, str(tmp_path)).exists(layer, "new")


def test_a_table_replaced_from_itself(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS self_test CASCADE")
    for store in (tables.TableStore(spark, str(tmp_path)), tables.TableStore(spark)):
        store.replace(spark.range(6), "self_test", "t")
        assert store.replace(store.read("self_test", "t").where("id % 2 = 0"), "self_test", "t") == 3
        both = store.read("self_test", "t").union(store.read("self_test", "t"))
        assert store.replace(both, "self_test", "t") == 6
        assert sorted(r[0] for r in store.read("self_test", "t").collect()) == [0, 0, 2, 2, 4, 4]
    spark.sql("DROP DATABASE self_test CASCADE")


def test_appends_of_two_writers_both_stay(spark, tmp_path):
    """Also those that make the table; a reader that began earlier keeps what it saw."""
    from multiprocessing.pool import ThreadPool

    store = tables.TableStore(spark, str(tmp_path))
    with ThreadPool(4) as pool:
        pool.map(lambda k: store.append(spark.range(k * 10, k * 10 + 10), "h", "t"), range(8))
    assert sorted(r[0] for r in store.read("h", "t").collect()) == list(range(80))
    old = store.read("h", "t")
    snapshots = store.snapshots("h", "t")
    base, _ = snapshots._current()
    store.replace(spark.range(3), "h", "t")
    # a writer that still knew the old table comes before the one that replaced it
    snapshots._write(spark.range(7), f"{base}+0-late")
    assert store.read("h", "t").count() == snapshots.rows() == 3 and old.count() == 80
    assert snapshots.expire(3600) == 0
    assert snapshots.expire(-5) == 9 * 2 and store.read("h", "t").count() == 3
    assert snapshots.expire(-5) == 0


def test_reading_opens_no_footers_for_schemas(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    store.append(spark.sql("SELECT 1 AS n, 0.5D AS x"), "h", "t")
    store.append(spark.sql("SELECT 2 AS n, 'b' AS y"), "h", "t")
    store.append(spark.sql("SELECT 3 AS n, 0.25D AS x"), "h", "t")
    df = store.read("h", "t")
    assert df.columns == ["n", "x", "y"] and {tuple(r) for r in df.collect()} == {(1, 0.5, None), (2, None, "b"), (3, 0.25, None)}
    # rows of one schema are one scan
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    with pytest.raises(ValueError, match="no table"):
        store.read("h", "nothing")


def test_catalog_store_with_buckets(spark):
    """Two tables bucketed on their key join without a shuffle."""
    store = tables.TableStore(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("a", "b"):
            assert store.replace(spark.range(100).toDF("client"), "propense_test", name, "client", 4) == 100
        joined = store.read("propense_test", "a").join(store.read("propense_test", "b"), "client")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100 and store.exists("propense_test", "a")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP DATABASE IF EXISTS propense_test CASCADE")


def test_ingestion_isolates_jobs(spark, tmp_path):
    (tmp_path / "book").mkdir()
    (tmp_path / "book" / "People.csv").write_text("client,Age,income\n1,30,NaN\n2,,5.5\n")
    jobs = {
        "ingestion_jobs": [
            {"job_name": "gone", "duckdb_schema": "bronze", "duckdb_table": "gone", "excel_path": str(tmp_path / "no.xlsx"), "excel_sheetname": "X"},
            {"job_name": "people", "duckdb_schema": "bronze", "duckdb_table": "people", "excel_path": str(tmp_path / "book.xlsx"), "excel_sheetname": "People"},
            {"name": "typed", "layer": "bronze", "table": "typed", "path": str(tmp_path / "book" / "People.csv"), "schema": "client long, Age double, income double"},
        ]
    }
    config = tmp_path / "jobs.json"
    config.write_text(json.dumps(jobs))
    store = tables.TableStore(spark, str(tmp_path / "lake"))
    status = {r["job"]: r for r in ingest.run_jobs(store, ingest.load_jobs(str(config))).collect()}
    assert (status["people"]["rejected"], status["gone"]["rejected"]) == (0, None)
    assert status["gone"]["status"] == "failed" and "no/X.csv" in status["gone"]["error"]
    assert (status["people"]["status"], status["people"]["rows"]) == ("ok", 2)
    typed = {r["client"]: r for r in store.read("bronze", "typed").collect()}
    assert typed[1]["income"] is None and typed[2]["Age"] is None and typed[2]["income"] == 5.5
    with pytest.raises(ValueError, match="layer"):
        ingest.IngestJob.from_mapping({"name": "n", "table": "t", "path": "p"})


def test_sql_status_and_export(spark, tmp_path):
    good = export.run_sql(spark, "SELECT 1 AS a, 'x' AS b, 2 AS a")
    assert good.status == 1 and good.query.columns == ["a", "b", "a_1"]
    path = export.save_result(good, str(tmp_path))
    assert path.startswith(f"{tmp_path}/query_result_")
    assert [tuple(r) for r in spark.read.option("header", "true").csv(path).collect()] == [("1", "x", "2")]
    bad = export.run_sql(spark, "SELECT nothing FROM nowhere")
    assert bad.status == 0 and "nowhere" in bad.query
    with pytest.raises(ValueError, match="query failed"):
        export.save_result(bad, str(tmp_path))


def test_texts_with_quotes_and_line_breaks_come_back(spark, sf_dir, tmp_path):
    odd = [(-1, 'say "hi",\nthen go', None), (-2, "", "x"), (-3, 'ends with \\', 'a "q"'), (-4, "\r\n", ""), (-5, '"', "\\\"")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    export.export_csv(docs, str(tmp_path), "documents.csv")
    schema = "doc_id long, text string, lang string"
    jobs = [
        ingest.IngestJob("whole", "b", "whole", str(tmp_path), "documents", schema=schema, options={"multiLine": "true"}),
        ingest.IngestJob("torn", "b", "torn", str(tmp_path), "documents", schema=schema, bad_rows="fail"),
    ]
    store = tables.TableStore(spark, str(tmp_path / "lake"))
    status = {r["job"]: r["status"] for r in ingest.run_jobs(store, jobs).collect()}
    assert status == {"whole": "ok", "torn": "failed"}
    back = {tuple(r) for r in store.read("b", "whole").collect()}
    lines = lambda t: t if t is None else t.replace("\r\n", "\n")
    assert {(i, lines(t), g) for i, t, g in back} == {(r[0], lines(r[1]), r[2]) for r in docs.collect()}


def test_bad_rows_are_rejected_with_their_place(spark, tmp_path):
    """One bad row costs no job: it goes to a table of its own, also where files are read in pieces."""
    folder = tmp_path / "book"
    folder.mkdir()
    lines = [f"{k},{k}.5,2024-01-{k % 28 + 1:02d},name {k}" for k in range(4000)]
    bad = {10: "x,1.5,2024-01-01,a", 11: "11,1d,2024-01-01,b", 700: "1,2", 701: "1,2.0,2024-01-01,c,more", 3999: "3999,1.0,2024-13-01,d"}
    for k, text in bad.items():
        lines[k] = text
    lines[20] = ',,,""'
    lines[21] = " 21 , 1e3 ,2024-01-01,"
    (folder / "Sheet.csv").write_text("client,amount,day,name\n" + "\n".join(lines) + "\n")
    schema = "client long, amount double, day date, name string"
    job = ingest.IngestJob("j", "b", "t", str(folder), "Sheet", schema=schema)
    store = tables.TableStore(spark, str(tmp_path / "lake"))
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        row = ingest.run_jobs(store, [job]).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert (row["status"], row["rows"], row["rejected"]) == ("ok", 3995, 5)
    rejected = {r["record"]: r for r in store.read("b", ingest.rejects_table("t")).collect()}
    assert sorted(rejected) == [k + 1 for k in bad] and all(r["file"].endswith("Sheet.csv") for r in rejected.values())
    assert rejected[701]["text"] == "1,2" and "number of cells" in rejected[702]["reason"]
    assert rejected[11]["reason"] == "client is no bigint: x" and rejected[12]["reason"] == "amount is no double: 1d"
    rows = {r["client"]: tuple(r)[1:] for r in store.read("b", "t").collect()}
    assert rows[None] == (None, None, "") and rows[21][0] == 1000.0 and rows[21][2] is None
    strict = ingest.run_jobs(store, [ingest.IngestJob("j", "b", "t2", str(folder), "Sheet", schema=schema, bad_rows="fail")]).first()
    assert strict["status"] == "failed" and "record 11: client is no bigint" in strict["error"] and not store.exists("b", "t2")
    with pytest.raises(ValueError, match="bad_rows"):
        ingest.IngestJob("j", "b", "t", "p", bad_rows="keep")


def test_types_are_found_from_the_cells(spark, tmp_path):
    """One reading of the CSV, whose cells are stored; no column is taken for less than all its cells are."""
    rows = [
        "i,l,d,x,t,b,day,s,e,z,m",
        "1,3000000000,1.5,NaN,2024-01-05 10:00:00,true,2024-01-05,07x,,,1",
        "-2,1,1e3,2,2024-01-05T11:30:00,FALSE,2024-02-29,b,,,x",
        ',,,,,,,,,"",',
    ]
    (tmp_path / "Sheet.csv").write_text("\n".join(rows) + "\n")
    job = ingest.IngestJob("j", "b", "t", str(tmp_path / "Sheet.csv"))
    source = ingest.read_source(spark, job)
    kinds = dict(source.rows.dtypes)
    assert list(kinds.values()) == ["int", "bigint", "double", "double", "timestamp", "boolean", "date", *["string"] * 4]
    got = source.rows.orderBy("i").collect()
    assert got[0]["i"] is None and got[2]["x"] is None and got[1]["x"] == 2.0 and got[2]["t"].hour == 10
    plan = source.rows._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "csv" not in plan.lower()


def test_job_files_are_read_where_spark_reads(spark, tmp_path):
    (tmp_path / "jobs.json").write_text(json.dumps({"ingestion_jobs": [{"name": "n", "layer": "l", "table": "t", "path": "p"}]}))
    assert ingest.load_jobs(f"file://{tmp_path}/jobs.json", spark) == ingest.load_jobs(str(tmp_path / "jobs.json"))


def test_history_keeps_columns_of_all_rows(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS history_test CASCADE")
    for store in (tables.TableStore(spark, str(tmp_path)), tables.TableStore(spark)):
        store.append(spark.sql("SELECT 1 AS n, 0.5D AS param_x"), "history_test", "models")
        store.append(spark.sql("SELECT 2 AS n, 0.7D AS param_y"), "history_test", "models")
        rows = {r["n"]: (r["param_x"], r["param_y"]) for r in store.read("history_test", "models").collect()}
        assert rows == {1: (0.5, None), 2: (None, 0.7)}
    spark.sql("DROP DATABASE history_test CASCADE")


def test_errors_while_a_query_runs_have_status_0(spark):
    bad = export.run_sql(spark, "SELECT 1 / (id - 3) AS x FROM range(10)")
    assert bad.status == 0 and "ZERO" in bad.query.upper()
    assert export.run_sql(spark, "SELECT id FROM range(3)").query.count() == 3
    assert export.run_sql(spark, "CREATE OR REPLACE TEMP VIEW made AS SELECT 1 AS one").status == 1


def test_score_and_metric_files(spark, tmp_path):
    path = export.export_scores(spark.range(3), str(tmp_path), "scores")
    back = spark.read.option("header", "true").csv(path)
    assert back.columns == ["id", "prediction_timestamp"] and back.count() == 3
    path = export.export_json(spark.sql("SELECT 0.5D AS auc_score"), str(tmp_path / "m"))
    assert spark.read.json(path).first()["auc_score"] == 0.5


def test_name_lists(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a, b ,c",)], "names string")
    assert df.select(export.split_names(F.col("names"))).first()[0] == ["a", "b", "c"]
    assert export.join_names(["a", "b"]) == "a,b"


def test_lineage_is_cut_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir", folder)
    assert scratch_path(spark, "x").startswith(folder.rstrip("/"))
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS v"))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().executedPlan().toString()
