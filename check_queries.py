"""Compare registered queries with their SQL in DuckDB: python check_queries.py [sf_dir] [name …]."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from haulbook.catalog import ORACLES, QUERIES
from haulbook.sources.tables import TABLES


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cell(v):
    if v is None or v != v:
        return "~"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    return str(v)


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def main() -> None:
    args = sys.argv[1:]
    path = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = args or list(QUERIES)
    spark = session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{path}/{t}.parquet'")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            df = QUERIES[n](spark, path)
            cols, got = df.columns, [tuple(r) for r in df.collect()]
        except Exception as e:  # report and go on
            print(f"FAIL {n}: {str(e)[:900]}")
            bad += 1
            continue
        secs = time.time() - t0
        if n not in ORACLES:
            print(f"rows {n}: {len(got)} ({secs:.1f}s)")
            continue
        try:
            cur = con.execute(ORACLES[n])
            want_cols, want = [d[0] for d in cur.description], cur.fetchall()
        except Exception as e:
            print(f"SQL  {n}: {str(e)[:700]}")
            bad += 1
            continue
        if sorted(cols) != sorted(want_cols):
            print(f"COLS {n}: {sorted(cols)} against {sorted(want_cols)}")
            bad += 1
            continue
        a, b = rows(cols, got), rows(want_cols, want)
        if a == b:
            print(f"ok   {n}: {len(a)} rows ({secs:.1f}s, sql {time.time() - t0 - secs:.1f}s)")
        else:
            bad += 1
            sa, sb = set(a), set(b)
            print(f"DIFF {n}: {len(a)} rows against {len(b)}; columns {sorted(cols)}")
            print("   spark only:", sorted(sa - sb)[:3])
            print("   sql only:  ", sorted(sb - sa)[:3])
    print(f"{len(names)} checked, {bad} wrong")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
