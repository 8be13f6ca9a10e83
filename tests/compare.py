"""Compare a registered query with its SQL on the given tables.

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None or isinstance(value, (str, bool)) else repr(value)


def normal(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(r[i]) for i in at) for r in rows]
    return [columns[i] for i in at], sorted(table, key=repr)


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """Empty when columns and rows agree exactly."""
    df = query(spark, sf_dir)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = normal([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns: only ours {set(ours[0]) - set(theirs[0])}, only theirs {set(theirs[0]) - set(ours[0])}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"rows: {len(ours[1])} != {len(theirs[1])}"]
    out = []
    for a, b in zip(*[t[1] for t in (ours, theirs)]):
        if a != b:
            out.append("; ".join(f"{c}: {x} != {y}" for c, x, y in zip(ours[0], a, b) if x != y))
    return out


def main() -> None:
    from conftest import session

    from __spark_entry__ import oracle_sql, queries

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con, sql = session(), database(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        if name not in sql:
            print(f"{name:40s} no SQL, {query(spark, sf_dir).count()} rows")
            continue
        started = time.time()
        try:
            diff = differences(spark, con, query, sql[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            diff = [f"{type(e).__name__}: {str(e)[:500]}"]
        bad += bool(diff)
        print(f"{name:40s} {'ok' if not diff else 'DIFFERENT'} {time.time() - started:.1f}s", flush=True)
        for line in diff[:4]:
            print("   ", line[:600])
    print(f"{bad} different")


if __name__ == "__main__":
    main()
