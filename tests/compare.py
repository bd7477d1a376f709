"""Run registered queries against their SQL: python -m tests.compare [sf] [names...]"""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_frame(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con.execute(sql).df()


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    out = {}
    for name in sorted(frame.columns):
        column = frame[name].reset_index(drop=True)
        if pd.api.types.is_datetime64_any_dtype(column):
            out[name] = column.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(column) and not pd.api.types.is_bool_dtype(column):
            out[name] = column.astype(float).map(lambda v: "NULL" if np.isnan(v) else repr(v + 0.0))
        else:
            out[name] = column.map(lambda v: "NULL" if pd.api.types.is_scalar(v) and pd.isna(v) else str(v))
    made = pd.DataFrame(out)
    return made.sort_values(list(out)).reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """None if both hold the same rows, else what differs first."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns: only ours {set(ours) - set(theirs)}, only sql {set(theirs) - set(ours)}"
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} vs {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    for name in a.columns:
        wrong = a[name] != b[name]
        if wrong.any():
            i = wrong.idxmax()
            return f"{name}: {wrong.sum()} rows differ, e.g. {dict(a.loc[i])} vs {dict(b.loc[i])}"[:1500]
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tideshift.session import build_session

    sf, *names = sys.argv[1:] or ["0.01"]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    oracle, bad = oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            ours = query(spark, sf_dir).toPandas()
            took = time.time() - started
            if name in oracle:
                wrong = difference(ours, oracle_frame(oracle[name], sf_dir))
                status = "ok" if wrong is None else f"DIFF {wrong}"
            else:
                status = "rows"
        except Exception as e:  # noqa: BLE001 - a report of everything that fails
            ours, took, status = pd.DataFrame(), time.time() - started, f"FAIL {type(e).__name__} {str(e)[:1200]}"
        bad += status not in ("ok", "rows")
        print(f"{name:26s} {took:6.2f}s {len(ours):8d} rows  {status}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
