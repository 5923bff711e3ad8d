"""Runs a registered query and its SQL side by side and reports how they differ.

As a script: ``python -m tests.oracle [sf_dir] [name ...]``.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if value != value else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, _plain(v)) for k, v in sorted(value.items()))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty where names, rows and values are all equal."""
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_names != want_names:
        return [f"columns: {got_names} != {want_names}"]
    out = []
    if sum(got.values()) != sum(want.values()):
        out.append(f"rows: {sum(got.values())} != {sum(want.values())}")
    if got != want:
        only_got, only_want = got - want, want - got
        out.append(f"{sum(only_got.values())} rows differ in {got_names}")
        key = lambda r: repr(r)
        for a, b in list(zip(sorted(only_got, key=key), sorted(only_want, key=key)))[:3]:
            out.append(f"  spark {a}\n    sql {b}")
    kinds = [{type(v).__name__ for v in col if v is not None} for col in zip(*got)] if got else []
    kinds2 = [{type(v).__name__ for v in col if v is not None} for col in zip(*want)] if want else []
    for n, a, b in zip(got_names, kinds, kinds2):
        if a != b:
            out.append(f"type of {n}: {a} != {b}")
    return out


def main() -> None:
    import __spark_entry__ as e
    from propense.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con = get_spark("oracle"), connect(sf_dir)
    sqls = e.oracle_sql()
    bad = 0
    for name, query in e.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                diff = differences(df, con, sqls[name])
                verdict = "ok" if not diff else "DIFF\n" + "\n".join(diff)
                bad += bool(diff)
            else:
                rows = df.collect()
                verdict = f"rows only: {len(rows)}"
        except Exception as err:  # noqa: BLE001
            bad += 1
            verdict = f"ERROR {type(err).__name__}: {str(err)[:1500]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {verdict}", flush=True)
    missing = set(sqls) - set(e.queries())
    print("sql without query:", missing, "bad:", bad)


if __name__ == "__main__":
    main()
