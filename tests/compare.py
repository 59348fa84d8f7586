"""Run queries beside their DuckDB oracle and compare rows. Also a script: compare.py [sf_dir] [names...]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_dir, name)}.parquet')")
    return con


def _plain(value: object) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0) if value != 0 else "0.0"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return str(value)


def normal(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, text: str) -> str | None:
    """None if equal, else what differs."""
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    compare.spark_done = time.time()
    result = con.execute(text)
    columns = [d[0] for d in result.description]
    theirs = normal(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}; ours {ours[:2]} theirs {theirs[:2]}"
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, first {bad[0]}" if bad else None


compare.spark_done = 0.0


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from playrank.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem, kind = compare(df, con, oracles[name]), "oracle"
            else:
                n = df.count()
                compare.spark_done = time.time()
                problem, kind = None if n else "no rows", f"rows only ({n})"
        except Exception as error:  # report and go on
            problem, kind = f"{type(error).__name__}: {str(error)[:1500]}", "error"
        print(f"{'FAIL' if problem else 'ok  '} {name:34s} {time.time() - start:6.1f}s (spark {compare.spark_done - start:5.1f}s) {kind} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
