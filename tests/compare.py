"""Compare a Spark result with its DuckDB oracle row by row."""

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(pdf):
    pdf = pdf[sorted(pdf.columns)]

    def text(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, bool) or type(v).__name__ in ("bool_", "bool"):
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf":
            return repr(float(v))
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in pdf.astype(object).itertuples(index=False, name=None))


def difference(spark_df, con, sql):
    """Empty when equal, else a short description."""
    got, want = spark_df.toPandas(), con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return ""
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"rows {len(a)} vs {len(b)}; {sorted(got.columns)}\n spark only {only_a[:2]}\n oracle only {only_b[:2]}"
