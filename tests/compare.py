"""Comparison of a DataFrame with DuckDB's rows for the same SQL."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)):
        return "NULL"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return repr(round(float(v), 6))
    return str(v).removesuffix(" 00:00:00")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(_plain, r)) for r in frame.astype(object).itertuples(index=False, name=None))
