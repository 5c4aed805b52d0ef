"""Run registered queries against DuckDB: ``python tests/check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        name = f.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def _cell(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is not None, type(x).__name__ if x is not None else "", repr(x)) for x in r))
    return [cols[i] for i in order], out


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    sc, srows = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    dc, drows = rows_of(names, cur.fetchall())
    if sc != dc:
        return f"columns differ: {sc} / {dc}"
    if len(srows) != len(drows):
        return f"row count {len(srows)} / {len(drows)}"
    for i, (a, b) in enumerate(zip(srows, drows)):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            bad = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y or type(x) is not type(y)]
            return f"row {i}: {bad[:4]}"
    return None


def main(argv: list[str]) -> int:
    from opsgrain.registry import ORACLE, QUERIES
    from opsgrain.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = [n for a in argv[1:] for n in ([a] if a[0] != "@" else [q for q in QUERIES if QUERIES[q].__module__.endswith("." + a[1:])])]
    names = names or sorted(QUERIES)
    spark = local_session(8)
    con = connect(sf_dir)
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problem = compare(df, con, ORACLE[name])
                note = f"rows {df.count()}" if problem is None else problem
            else:
                problem, note = None, f"no oracle, rows {df.count()}"
        except Exception as e:  # report and go on with the next query
            problem = note = f"{type(e).__name__}: {str(e)[:900]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t0:.1f}s {note}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
