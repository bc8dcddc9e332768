"""Compare named queries with their SQL twins: ``python tests/oracle_compare.py [folder] [name ...]``."""

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if isinstance(v, Decimal):
        return str(v.normalize() if v else Decimal(0))
    return repr(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, sql):
    """None where both sides agree, else what differs."""
    df = contract.queries()[name](spark, folder)
    got_columns, got = normal(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_columns, want = normal([d[0] for d in rel.description], rel.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}"
    if got != want:
        extra, missing = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
        return f"values differ: spark {extra} sql {missing}"
    return None if got or name in ("row_policy_visitor",) else "no rows"


def types(df, rel):
    return sorted((f.name, f.dataType.simpleString()) for f in df.schema), sorted((d[0], str(d[1])) for d in rel.description)


if __name__ == "__main__":
    from wardflow.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in names:
        start = time.time()
        try:
            sql = contract.oracle_sql().get(name)
            if sql is None:
                n = contract.queries()[name](spark, folder).count()
                print(f"rows {name}: {n} ({time.time() - start:.1f}s)", flush=True)
                continue
            diff = compare(spark, con, folder, name, sql)
        except Exception as exc:
            diff = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name} ({time.time() - start:.1f}s) {diff or ''}", flush=True)
    print(f"{len(names)} queries, {bad} differ")
