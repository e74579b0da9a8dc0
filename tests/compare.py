"""Run queries next to their SQL in DuckDB and compare the rows.

    python -m tests.compare [sf_dir] [name prefix ...]
"""

import glob
import math
import sys
import time

import duckdb

from catalogue import registry


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = path.rsplit("/", 1)[1].removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def norm(v):
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return ("f", repr(v))
    if isinstance(v, int):
        return ("i", v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, sf_dir, queries, oracles):
    t = time.time()
    df = queries[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - t
    if name not in oracles:
        return f"rows {len(got)}", took, True
    res = con.execute(oracles[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(cols) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(cols)}", took, False
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a == b:
        return f"ok {len(a)}", took, True
    only_a, only_b = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
    return f"DIFF {len(a)} vs {len(b)}\n   spark {only_a}\n   duck  {only_b}", took, False


def main():
    from tests.session import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    spark, con = make_session(), duck(sf_dir)
    queries, oracles = registry.queries(), registry.oracles()
    bad = []
    for name in queries:
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            message, took, ok = compare(spark, con, name, sf_dir, queries, oracles)
        except Exception as e:  # noqa: BLE001
            message, took, ok = f"ERROR {type(e).__name__}: {str(e)[:400]}", 0.0, False
        if not ok:
            bad.append(name)
        print(f"{name:32s} {took:6.2f}s {message}", flush=True)
    print("FAILED:", bad)


if __name__ == "__main__":
    main()
