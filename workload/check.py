"""Run registered queries against DuckDB on the same parquet files.

    python -m workload.check [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = Path(sf_dir) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value:.9g}" if value != int(value) or abs(value) > 1e15 else str(int(value))
    text = str(value)
    return text[:-9] if text.endswith(" 00:00:00") else text


def canonical(columns, rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when both agree, else a description of the first difference."""
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_cols, want = canonical([d[0] for d in result.description], result.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None


def main() -> None:
    from tidewell.session import build_session
    from workload.registry import registered

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--explain", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("check", master="local[8]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions=8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(args.sf)
    bad = 0
    for name, (run, sql) in registered().items():
        if args.names and name not in args.names:
            continue
        started = time.time()
        try:
            df = run(spark, args.sf)
            if args.explain:
                df.explain("formatted")
            problem = compare(df, con, sql) if sql else f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            problem = f"ERROR {str(error)[:1500]}"
        state = "ok" if problem is None else problem
        bad += state != "ok" and not state.startswith("rows only")
        print(f"{name:28s} {time.time() - started:6.2f}s  {state}", flush=True)
    print(f"{bad} problem(s)")


if __name__ == "__main__":
    main()
