"""Run registered queries against their oracles: python -m checks.compare SF_DIR [NAME ...]"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype(float)
        elif pd.api.types.is_integer_dtype(df[c]):
            df[c] = df[c].astype("int64")
    df = df.astype(object).where(df.notna(), None)
    return df.sort_values(list(df.columns), key=lambda s: s.map(repr), ignore_index=True)


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    a, b = canonical(actual), canonical(expected)
    for c in a.columns:
        same = [x == y or (x is None and y is None) for x, y in zip(a[c], b[c])]
        if not all(same):
            i = same.index(False)
            return f"{len(same) - sum(same)} differ in {c}: {a.iloc[i].to_dict()} != {b.iloc[i].to_dict()}"
        kinds = {type(x) for x in a[c] if x is not None}, {type(x) for x in b[c] if x is not None}
        if kinds[0] != kinds[1]:
            return f"types of {c}: {kinds}"
    return None


def main(folder: str, names: list[str]) -> int:
    from checks.catalog import ORACLES, QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = oracle(folder), 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            actual = QUERIES[name](spark, folder).toPandas()
            took = time.time() - start
            if name in ORACLES:
                problem = difference(actual, con.execute(ORACLES[name]).df())
            else:
                problem = None if len(actual) else "no rows"
        except Exception as e:  # report and go on with the next query
            problem, took, actual = f"{type(e).__name__}: {str(e)[:600]}", time.time() - start, ()
        bad += problem is not None
        state = "ok  " if problem is None else "FAIL"
        kind = "sql" if name in ORACLES else "rows"
        print(f"{state} {took:6.2f}s {kind:4} {len(actual):8} {name} {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
