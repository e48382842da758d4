"""Run registered queries against their SQL in DuckDB and compare names, row counts and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(canonical(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def kind(value) -> str:
    return type(value).__name__


def differences(df, sql: str, con) -> list[str]:
    """Empty when both sides agree."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns: only spark {sorted(set(df.columns) - set(names))}, only sql {sorted(set(names) - set(df.columns))}"]
    left, right = rows_of(df.columns, got), rows_of(names, want)
    if len(left) != len(right):
        problems.append(f"rows: spark {len(left)}, sql {len(right)}")
    cols = sorted(df.columns)
    if left != right:
        in_left, in_right = set(left), set(right)
        only_left, only_right = [r for r in left if r not in in_right][:2], [r for r in right if r not in in_left][:2]
        for a, b in zip(only_left, only_right):
            problems.append("; ".join(f"{c}: {x!r} | {y!r}" for c, x, y in zip(cols, a, b) if x != y or kind(x) != kind(y))[:700])
        if not problems:
            problems.append(f"spark only {only_left[:1]}, sql only {only_right[:1]}"[:700])
    for i, c in enumerate(cols):
        kinds = [{kind(r[i]) for r in side if r[i] is not None} for side in (left, right)]
        if kinds[0] and kinds[1] and kinds[0] != kinds[1]:
            problems.append(f"type of {c}: {kinds}")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    from perigee.bindings.registry import load
    from perigee.runtime import build_session

    spark = build_session("compare", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    bad = 0
    for name, q in load().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = q.run(spark, sf_dir)
            problems, note = differences(df, q.sql, con), ""
        except Exception as error:  # noqa: BLE001
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        print(("ok  " if not problems else "BAD ") + name, f"{time.time() - start:.1f}s", note, *problems, sep="  ", flush=True)
        bad += bool(problems)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
