"""Run registered queries and their reference SQL side by side.

``python -m tests.compare [-d DIR] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        if pdf[c].dtype.kind == "f":
            pdf[c] = pdf[c] + 0.0
        elif pdf[c].dtype == "Int64":  # whole numbers with nulls
            pdf[c] = pdf[c].astype("float64" if pdf[c].isna().any() else "int64")
    return pdf.sort_values(list(pdf.columns), na_position="last").reset_index(drop=True)


def differences(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    """None if both frames hold the same rows, else what differs."""
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} vs {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} vs {len(sql_pdf)}"
    a, b = normal(spark_pdf), normal(sql_pdf)
    for c in a.columns:
        if a[c].dtype != b[c].dtype and not (len(a) and a[c].isna().all() and b[c].isna().all()):
            return f"type of {c}: {a[c].dtype} vs {b[c].dtype}"
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = (~same).idxmax()
            return f"{(~same).sum()} values of {c}, first {a[c][i]!r} vs {b[c][i]!r}"
    return None


def main(argv=None) -> int:
    args = argparse.ArgumentParser()
    args.add_argument("-d", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args(argv)
    import __spark_entry__ as entry
    from gramlark.session import local_session

    spark = local_session("compare", 8)
    con = duck(opts.d)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in opts.names or queries:
        start = time.time()
        try:
            got = queries[name](spark, opts.d).toPandas()
            took = time.time() - start
            if name in sql:
                start = time.time()
                want = con.execute(sql[name]).df()
                took_sql = time.time() - start
                diff = differences(got, want)
                state = "ok" if diff is None else f"DIFF {diff}"
            else:
                took_sql, state = 0.0, f"rows {len(got)}"
        except Exception as e:  # noqa: BLE001
            took = took_sql = time.time() - start
            state = f"FAIL {type(e).__name__}: {str(e)[:600]}"
        bad += state.startswith(("DIFF", "FAIL"))
        print(f"{name:36s} {took:6.2f}s sql {took_sql:5.2f}s  {state}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
