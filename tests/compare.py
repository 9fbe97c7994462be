"""Run the registered queries against their SQL and report differences.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else repr(v + 0.0)
        return v if v is None else str(v)

    return Counter(tuple(value(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, sf_dir: str) -> tuple[int, int, list, list]:
    """(rows, rows of the SQL, rows only in Spark, rows only in the SQL)."""
    df = query(spark, sf_dir)
    got = canonical(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    want = canonical(names, cursor.fetchall())
    return sum(got.values()), sum(want.values()), list((got - want).elements()), list((want - got).elements())


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from trendframe.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or [name for name in queries() if name in oracle_sql()]
    spark, con, bad = build_session("compare"), connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        try:
            n, m, extra, missing = compare(spark, con, queries()[name], oracle_sql()[name], sf_dir)
            ok = not extra and not missing
            print(f"{'ok  ' if ok else 'DIFF'} {name} rows={n}/{m} {time.time() - start:.1f}s", flush=True)
            if not ok:
                print("   only spark", len(extra), extra[:2], "\n   only sql  ", len(missing), missing[:2])
        except Exception as e:  # noqa: BLE001
            ok = False
            print(f"FAIL {name} {type(e).__name__} {str(e)[:1500]}", flush=True)
        bad += not ok
    return bad


if __name__ == "__main__":
    sys.exit(main())
