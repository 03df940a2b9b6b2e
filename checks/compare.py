"""Run every query and its SQL on the same tables and compare: python -m checks.compare [sf_dir] [name …]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from newsflow.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> str:
    start = time.time()
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    took = time.time() - start
    head = f"{name:24} {len(mine):8} rows {took:6.1f}s"
    if sql is None:
        return f"{head}  rows only"
    start = time.time()
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    theirs = rows_of(columns, cursor.fetchall())
    head += f" sql {time.time() - start:5.1f}s"
    if sorted(columns) != sorted(df.columns):
        return f"{head}  COLUMNS {sorted(df.columns)} != {sorted(columns)}"
    wide = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = [(c, t, kinds[c]) for c, t in df.dtypes if wide.get(t) != kinds[c]]
    note = f"  types {types}" if types else ""
    if mine != theirs:
        diff = [pair for pair in zip(mine, theirs) if pair[0] != pair[1]][:3]
        return f"{head}  MISMATCH {len(mine)} vs {len(theirs)} {str(diff)[:900]}{note}"
    return f"{head}  ok{note}"


def main() -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        try:
            line = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
        except Exception as error:  # noqa: BLE001
            line = f"{name:24} ERROR {type(error).__name__} {str(error)[:600]}"
        failed += "  ok" not in line and "rows only" not in line
        print(line, flush=True)
    print(f"{len(wanted)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
