"""Order-insensitive comparison of a Spark result with a DuckDB result."""
from __future__ import annotations

import hashlib

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(df: pd.DataFrame) -> tuple[list[str], int, str]:
    cols = sorted(df.columns)
    rows = []
    for r in df[cols].itertuples(index=False):
        vals = []
        for v in r:
            if v is None or (isinstance(v, float) and v != v) or v is pd.NA:
                vals.append("NULL")
            elif isinstance(v, float):
                vals.append(repr(float(v)))
            else:
                vals.append(str(v))
        rows.append("|".join(vals))
    rows.sort()
    return cols, len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest()
