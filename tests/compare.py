"""Runs a registered query and its checking SQL and compares them value by value.

Usage: python tests/compare.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
    return repr(v)


def _rows(table, names):
    cols = [table.column(n).to_pylist() for n in names]
    return Counter(tuple(_norm(v) for v in r) for r in zip(*cols)) if cols else Counter()


def _type(t) -> str:
    s = str(t)
    return {"large_string": "string", "timestamp[us, tz=UTC]": "timestamp[us]"}.get(s, s)


LAST: dict[str, int] = {}


def compare(spark, con, sf_dir: str, name: str, run, sql: str) -> str | None:
    got = run(spark, sf_dir).toArrow()
    want = con.cursor().sql(sql).to_arrow_table()
    LAST["rows"] = got.num_rows
    names = sorted(got.column_names)
    if names != sorted(want.column_names):
        return f"columns {names} != {sorted(want.column_names)}"
    types = [
        (n, _type(got.schema.field(n).type), _type(want.schema.field(n).type)) for n in names
    ]
    bad = [x for x in types if x[1] != x[2]]
    if bad:
        return f"types differ: {bad}"
    a, b = _rows(got, names), _rows(want, names)
    if a != b:
        more, less = list((a - b).items())[:3], list((b - a).items())[:3]
        return (
            f"rows {got.num_rows} vs {want.num_rows}; {sum((a - b).values())} only in spark, "
            f"e.g. {names} {more} vs {less}"
        )
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tarmac.session import build_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed = oracle_sql(), 0
    for name, run in queries().items():
        if args and not any(name.startswith(p) for p in args):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, name, run, oracles[name])
                n, note = LAST.get("rows"), ""
            else:
                n, problem, note = run(spark, sf_dir).count(), None, " (rows only)"
        except Exception as e:  # report and go on to the next query
            problem, n, note = f"{type(e).__name__}: {str(e)[:1500]}", "?", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={n}{note} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
