"""Line removal against a plain count of keys in dictionaries."""

import hashlib

import pytest

from propense.llm import lines, queries
from tests.oracle import connect, differences

TO_LOWER = str.maketrans(lines.UPPER, lines.LOWER)
SCHEMA = "doc_id long, text string"


def key(line):
    return line.strip(lines.BLANKS).translate(TO_LOWER)


def brute(rows, min_documents=2, min_chars=10):
    """(id, n_lines, n_dropped, kept) of every row; null ids are one document, the last."""
    last = 1 << 62
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(last if i is None else i)
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [
            line for line in all_lines
            if len(key(line)) < min_chars or len(held[key(line)]) < min_documents
            or min(held[key(line)]) == (last if i is None else i)
        ]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in df.collect()), key=repr)


HARD = [
    (1, "A common line here\nonly mine, number 1\n\n\nA common line here"),
    (2, "\t a COMMON line here \r\nonly mine, number 2\n"),
    (3, "a common line here"), (4, None), (5, ""), (6, "\n"), (7, "short\nshort"), (8, "short"),
    (9, "123456789\n1234567890"), (10, "123456789\n1234567890"), (11, "Ünïcode LINE é\nx"), (12, "ünïcode line é"), (13, "Ünïcode line é"),
    (14, "\x0b\x0c 1234567890 \x0c\ny"), (15, "a\xa0common line here\xa0"), (16, "inner  blanks stay"), (17, "inner blanks stay"),
    (20, "\U0001f600\U0001f600\U0001f600\U0001f600\U0001f600abcde"), (21, "\U0001f600\U0001f600\U0001f600\U0001f600\U0001f600ABCDE\n"),
    (30, "repeated within one document\nrepeated within one document"),
    (31, "the same id twice\nanother of it"), (31, "the same id twice"), (31, "the same id twice"),
    (None, "a line without id\na common line here"), (None, "a line without id"), (None, None),
    (40, "\n".join(f"long document line {k % 700}" for k in range(30000)) + "\na common line here"),
    (41, "\n".join(f"long document line {k}" for k in range(600, 2000))),
    (42, "x" * 300_000), (43, "X" * 300_000),
    *[(100 + k, "found all over the place\nnot elsewhere " + str(k)) for k in range(60)],
]


@pytest.mark.parametrize("min_documents,min_chars", [(2, 10), (3, 10), (2, 1), (4, 12)])
def test_hard_texts(spark, min_documents, min_chars):
    docs = spark.createDataFrame(HARD, SCHEMA).selectExpr("*", "1 AS id", "'k' AS key", "2 AS row_1", "3 AS place", "4 AS line")
    got = lines.drop_repeated(docs.repartition(5), min_documents=min_documents, min_chars=min_chars)
    assert found(got) == brute(HARD, min_documents, min_chars)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert lines.drop_repeated(docs).collect() == []
    assert lines.drop_repeated(docs, min_documents=3).collect() == []


def test_texts_as_ids(spark):
    rows = [("b", "one line in two"), ("a", "one line in two")]
    got = lines.drop_repeated(spark.createDataFrame(rows, "name string, body string"), "name", "body").collect()
    assert {(r.name, r.kept) for r in got} == {("a", "one line in two"), ("b", "")}


def test_no_python_on_the_way(spark, sf_dir):
    plan = queries.op12_line_dedup(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op12_line_dedup(spark, sf_dir).collect()), key=repr)
    want = [(i, n, d, hashlib.sha256(kept.encode()).hexdigest()) for i, n, d, kept in brute(docs)]
    assert got == sorted(want, key=repr)
    assert differences(queries.op12_line_dedup(spark, sf_dir), connect(sf_dir), queries.ORACLE_SQL["op12_line_dedup"]) == []
