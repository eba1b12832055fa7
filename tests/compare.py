"""Compare a Spark result with its DuckDB check: columns, rows and values, order ignored.

As a script: ``python tests/compare.py SF_DIR [key-prefix ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return "D" + value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return repr(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(row[i]) for i in order) for row in rows], key=str)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def differences(spark_df, con, sql):
    """Empty string when equal, else a short description."""
    mine = table_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    theirs = table_of([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}; " + first_gap(mine[1], theirs[1])
    if mine[1] != theirs[1]:
        return first_gap(mine[1], theirs[1])
    return ""


def first_gap(a, b):
    only_a, only_b = sorted(set(map(str, a)) - set(map(str, b))), sorted(set(map(str, b)) - set(map(str, a)))
    return f"{len(only_a)}/{len(only_b)} differ, spark {only_a[:2]} sql {only_b[:2]}"


def main():
    from ledgerloom.plans import ORACLES, QUERIES, load_all
    from ledgerloom.session import build_session

    load_all()
    sf_dir, prefixes = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for key, plan in QUERIES.items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        started = time.time()
        try:
            if key in ORACLES:
                found = differences(plan(spark, sf_dir), con, ORACLES[key])
            else:
                found = "" if plan(spark, sf_dir).collect() else "no rows"
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(found)
        mark = "ok  " if not found else "FAIL"
        print(f"{mark} {key} {time.time() - started:.1f}s {'' if key in ORACLES else '(rows only) '}{found}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
