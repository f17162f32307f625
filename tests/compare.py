"""Run registered queries and their DuckDB statements side by side.

    python tests/compare.py [sf folder] [query ...]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf, name, fn, sql):
    """None when equal, otherwise a short description."""
    t0 = time.time()
    df = fn(spark, sf)
    got = rows_of(df.columns, df.collect())
    t1 = time.time()
    if sql is None:
        return (None if got[1] else "no rows"), t1 - t0, 0.0
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    t2 = time.time()
    problem = None
    if got[0] != want[0]:
        problem = f"columns {got[0]} != {want[0]}"
    elif got[1] != want[1]:
        diff = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:2]
        problem = f"{len(got[1])} rows, expected {len(want[1])}; {str(diff)[:600]}"
    return problem, t1 - t0, t2 - t1


def main():
    import __spark_entry__ as entry
    from textloom.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("compare", master="local[8]", partitions=8, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        try:
            problem, ts, td = compare(spark, con, sf, name, fn, sqls.get(name))
        except Exception as e:  # report and go on
            problem, ts, td = f"{type(e).__name__}: {str(e)[:700]}", 0, 0
        bad += problem is not None
        kind = "rows only" if name not in sqls else ""
        print(f"{'ok ' if problem is None else 'BAD'} {name:24s} spark {ts:6.2f}s duckdb {td:6.2f}s {kind} {problem or ''}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
