"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows.

Usage: python tools/check_oracles.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronovault.session import build_session  # noqa: E402
from chronovault.suite import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(r[i]) for i in order) for r in rows))


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name not in ORACLES:
        return None if got else "no rows"
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = canonical(result.fetchall(), columns)
    if not want:
        return "oracle has no rows"
    if len(got) != len(want):
        extra = set(got) - set(want), set(want) - set(got)
        return f"{len(got)} rows, oracle {len(want)}; only here {list(extra[0])[:2]}; only oracle {list(extra[1])[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{sorted(columns)}\n      spark {a}\n      duck  {b}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    wrong = {c: (t, types[c]) for c, t in df.dtypes if names.get(t, t) != types[c] and types[c] not in ("NUMBER", "STRING", "DATETIME", "Date", "bool")}
    return f"types {wrong}" if wrong else None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = []
    for name in QUERIES:
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s", *([problem] if problem else []), sep="\n      " if problem else " ", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed of {len(QUERIES)}: {failed}; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
