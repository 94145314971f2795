"""Compares every registered query with its SQL oracle. Usage: parity.py [sf_dir] [names...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import local_session  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events") + (
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations"
)


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _bag(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = [
        tuple("NULL" if pd.isna(v) else str(v) for v in row)
        for row in frame[columns].astype(object).itertuples(index=False)
    ]
    return sorted(rows)


def _types(arrow_schema) -> dict[str, str]:
    names = {}
    for f in arrow_schema:
        text = str(f.type).replace("large_string", "string")
        names[f.name] = "timestamp" if text.startswith("timestamp") else text
    return names


def compare(spark, con, sf_dir, name) -> tuple[str, float, float]:
    start = time.time()
    got = entry.queries()[name](spark, sf_dir).toArrow()
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows only ({got.num_rows})", took, 0.0
    start = time.time()
    want = con.sql(sql).to_arrow_table()
    oracle = time.time() - start
    if sorted(got.column_names) != sorted(want.column_names):
        return f"COLUMNS {got.column_names} / {want.column_names}", took, oracle
    a, b = _types(got.schema), _types(want.schema)
    if a != b:
        return "TYPES " + str({k: (a[k], b[k]) for k in a if a[k] != b[k]}), took, oracle
    if got.num_rows != want.num_rows:
        return f"ROWS {got.num_rows} / {want.num_rows}", took, oracle
    x, y = _bag(got.to_pandas(timestamp_as_object=True)), _bag(want.to_pandas(timestamp_as_object=True))
    if x != y:
        bad = [(p, q) for p, q in zip(x, y) if p != q]
        return f"VALUES {len(bad)} rows, e.g. {bad[0]}", took, oracle
    return f"ok ({got.num_rows} rows)", took, oracle


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, con = local_session(8), oracle_connection(sf_dir)
    failed = 0
    for name in names:
        try:
            verdict, took, oracle = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the other queries
            verdict, took, oracle = "ERROR " + str(e)[:600], 0.0, 0.0
        failed += not verdict.startswith(("ok", "rows only"))
        print(f"{name:36s} {took:6.2f}s  oracle {oracle:5.2f}s  {verdict}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
