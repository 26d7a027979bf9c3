"""Run queries in Spark and in DuckDB and compare the results.

``python -m workload.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from workload.oracle import ORACLE
from workload.spark_queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def local_session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted."""
    texts: dict[str, list[str]] = {}
    for c in sorted(df.columns):
        values = [None if pd.isna(v) else v for v in df[c].tolist()]
        texts[c] = [
            "" if v is None else repr(float(v) + 0.0) if isinstance(v, (int, float)) else str(v)
            for v in values
        ]
    out = pd.DataFrame(texts)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def difference(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns: {sorted(set(spark_df.columns) ^ set(duck_df.columns))}"
    if len(spark_df) != len(duck_df):
        return f"rows: {len(spark_df)} and {len(duck_df)}"
    a, b = normal(spark_df), normal(duck_df)
    if a.equals(b):
        return None
    bad = [c for c in a.columns if not a[c].equals(b[c])]
    rows = (a[bad] != b[bad]).any(axis=1)
    first = rows.idxmax()
    shown = [(c, a.at[first, c], b.at[first, c]) for c in bad if a.at[first, c] != b.at[first, c]]
    return f"{int(rows.sum())} of {len(a)} rows, {len(bad)} columns, first: {shown[:4]}"


def main(args: list[str]) -> int:
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con = local_session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        try:
            t0 = time.time()
            got = QUERIES[name](spark, sf_dir).toPandas()
            t1 = time.time()
            want = con.execute(ORACLE[name]).df()
            t2 = time.time()
            diff = difference(got, want)
            size = f"{len(got)} rows, spark {t1 - t0:.1f} s, duckdb {t2 - t1:.1f} s"
        except Exception as error:  # reported, the rest goes on
            diff, size = f"{type(error).__name__}: {str(error)[:900]}", ""
        failed += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name}: {size} {diff or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
