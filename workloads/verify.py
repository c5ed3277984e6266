"""Run queries beside their SQL and compare rows, columns, types and values.

    python -m workloads.verify [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import time

import duckdb

from lakeloom.session import session

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "float": "FLOAT"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def compare(df, con, sql: str) -> tuple[str, int]:
    """'' when equal, else what differs; and the number of rows."""
    names = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    if sql is None:
        return "", len(rows)
    cur = con.execute(f"SELECT {', '.join(f'{chr(34)}{n}{chr(34)}' for n in names)} FROM ({sql})")
    types = {d[0]: str(d[1]) for d in cur.description}
    want = [tuple(_norm(v) for v in r) for r in cur.fetchall()]
    n_cols = len(con.execute(f"SELECT * FROM ({sql}) LIMIT 0").description)
    if n_cols != len(names):
        return f"columns: {len(names)} here, {n_cols} in SQL", len(rows)
    off = {f.name: (f.dataType.simpleString(), types[f.name]) for f in df.schema.fields
           if TYPES.get(f.dataType.simpleString()) != types[f.name]}
    if off:
        return f"types: {off}", len(rows)
    if len(rows) != len(want):
        return f"rows: {len(rows)} here, {len(want)} in SQL", len(rows)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    a, b = sorted(rows, key=key), sorted(want, key=key)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"values: {len(bad)} rows differ over {names}, first\n     here {bad[0][0]}\n     SQL  {bad[0][1]}", len(rows)
    return "", len(rows)


def main() -> None:
    import workloads

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = session("verify", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                             "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(opts.sf)
    failed = 0
    for name in opts.names or workloads.QUERIES:
        start = time.time()
        try:
            problem, n = compare(workloads.QUERIES[name](spark, opts.sf), con, workloads.ORACLES.get(name))
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        mark = "ok  " if not problem else "FAIL"
        if not problem and n == 0:
            mark = "zero"
        failed += bool(problem)
        print(f"{mark} {name:28s} rows={n:<8d} {time.time() - start:5.2f}s {'' if workloads.ORACLES.get(name) else '(rows only)'} {problem}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
