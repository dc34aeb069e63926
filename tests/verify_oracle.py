"""Compare queries with their SQL, as rows: python tests/verify_oracle.py [FOLDER] [NAME...]."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def settled(value):
    """A value in a form that both engines share."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(settled, value))
    if isinstance(value, dict):
        return tuple(sorted((k, settled(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return settled(value.asDict())
    if hasattr(value, "as_tuple"):
        return float(f"{float(value):.10g}")
    return value


def connect(folder: str):
    """DuckDB with a view for each table of the folder."""
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in sorted(os.listdir(folder)):
        if name.endswith(".parquet"):
            path = f"{folder}/{name}" + ("/*.parquet" if os.path.isdir(f"{folder}/{name}") else "")
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, folder: str, name: str, query, sql: str) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    df = query(spark, folder)
    columns = sorted(df.columns)
    got = Counter(tuple(settled(r[c]) for c in columns) for r in df.collect())
    rel = con.execute(sql)
    names = [x[0] for x in rel.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = Counter(tuple(settled(r[i]) for i in order) for r in rel.fetchall())
    if got == want:
        return ""
    return f"{sum(got.values())} and {sum(want.values())} rows; only in Spark {list((got - want).items())[:3]}; only in SQL {list((want - got).items())[:3]}"


def main(args: list[str]) -> int:
    import __spark_entry__ as entry
    from voxloom.session import build_session

    folder = args[0] if args else "/root/testdata/sf0.01"
    spark, con = build_session("verify"), connect(folder)
    queries, sqls, bad = entry.queries(), entry.oracle_sql(), 0
    for name in args[1:] or queries:
        began = time.time()
        try:
            said = compare(spark, con, folder, name, queries[name], sqls[name]) if name in sqls else f"no SQL, {queries[name](spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001 - the run goes on with the next query
            said = f"error {str(error)[:600]}"
        bad += bool(said) and not said.startswith("no SQL")
        print(f"{name}: {said or 'ok'} ({time.time() - began:.1f} s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
