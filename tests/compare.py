"""Run queries and their SQL counterparts side by side and compare whole results."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dict):
        return tuple(sorted(value.items()))
    if isinstance(value, list):
        return tuple(map(plain, value))
    return value


def differences(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None if both sides agree in columns, value kinds and rows, else what differs."""
    left = query(spark, sf_dir)
    cols = sorted(left.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in left.collect())
    right = con.execute(sql)
    names = [d[0] for d in right.description]
    if sorted(names) != cols:
        return f"columns {cols} against {sorted(names)}"
    order = [names.index(c) for c in cols]
    want = Counter(tuple(plain(r[i]) for i in order) for r in right.fetchall())
    kinds = [{type(r[i]) for r in side if r[i] is not None} for side in (got, want) for i in range(len(cols))]
    for i, c in enumerate(cols):
        a, b = kinds[i], kinds[i + len(cols)]
        if a != b:
            return f"{c} holds {a} against {b}"
    if got != want:
        return f"{sum(got.values())} rows against {sum(want.values())}; only ours {list((got - want).items())[:3]}; only SQL {list((want - got).items())[:3]}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(sf), 0
    sqls = contract.oracle_sql()
    chosen = sys.argv[1:] or list(contract.queries())
    for name in chosen:
        start = time.time()
        try:
            if name in sqls:
                found = differences(spark, con, name, contract.queries()[name], sqls[name], sf)
            else:
                found = None if contract.queries()[name](spark, sf).collect() else "no rows"
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:700]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.2f}s"
              f"{'' if name in sqls else ' (no SQL)'}{'' if found is None else ' ' + found}", flush=True)
    print(f"{len(chosen)} queries, {bad} differ, {sum(n not in sqls for n in chosen)} without SQL")
