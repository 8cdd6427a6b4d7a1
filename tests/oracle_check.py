"""Compare each registered Spark query with its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [key ...]

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of the values after sorting columns by name.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from featurelake.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not hasattr(v, "__len__"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v == int(v) and abs(v) < 1e15:
            return repr(float(int(v)))
        return repr(v)
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v))
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return str(v)


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(v) for v in rec))
    return sorted(rows, key=lambda r: tuple("" if x is None else x for x in r))


def compare(spark, sf_dir: str, keys=None, verbose=True):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as se

    qs, sqls = se.queries(), se.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[k] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(k, results[k], flush=True)
            continue
        ts = time.time() - t0
        if k not in sqls:
            results[k] = f"rows-only ({len(sdf)} rows)"
            if verbose:
                print(f"{k:28s} {results[k]}  spark {ts:.1f}s", flush=True)
            continue
        try:
            ddf = con.execute(sqls[k]).df()
        except Exception as e:  # noqa: BLE001
            results[k] = f"SQL ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(k, results[k], flush=True)
            continue
        if sorted(sdf.columns) != sorted(ddf.columns):
            results[k] = f"COLUMNS differ spark={sorted(sdf.columns)} sql={sorted(ddf.columns)}"
        elif len(sdf) != len(ddf):
            results[k] = f"ROWS differ spark={len(sdf)} sql={len(ddf)}"
        else:
            a, b = canon(sdf), canon(ddf)
            if a == b:
                results[k] = f"OK ({len(sdf)} rows)"
            else:
                bad = [(x, y) for x, y in zip(a, b) if x != y][:2]
                results[k] = f"VALUES differ, e.g. {bad}"
        if verbose:
            print(f"{k:28s} {results[k][:400]}  spark {ts:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from featurelake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    ks = sys.argv[2:] or None
    if os.environ.get("ORACLE_PLAIN"):  # a session with Spark's own defaults, as a driver might build it
        from pyspark.sql import SparkSession

        sp = SparkSession.builder.master(os.environ.get("ORACLE_MASTER", "local[8]")).getOrCreate()
    else:
        sp = build_session(os.environ.get("ORACLE_MASTER", "local[8]"),
                           shuffle_partitions=int(os.environ.get("ORACLE_SHUFFLE", "8")))
    res = compare(sp, sf, ks)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
