"""Run registered queries and their SQL side by side: ``python -m checks.compare [folder] [names..]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import tempfile
import time

import duckdb
import numpy as np
import pandas as pd

from checks import oracle, registry
from clicktide.session import CLUSTER_CONF

TABLES = ("events", "lineitem", "part", "orders")


def local_session(cores: int | str = 8, shuffle: int = 8):
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.master(f"local[{cores}]").appName("checks")
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clicktide-"))
    builder = builder.config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", str(shuffle))
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, float, np.number)):
        return float(v)  # pandas turns whole numbers with gaps into floats
    return v


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in row) for row in frame.astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """First difference of two results, order of rows and columns aside; None if equal."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} / {sorted(right.columns)}"
    a, b = rows_of(left), rows_of(right)
    if len(a) != len(b):
        return f"{len(a)} / {len(b)} rows"
    for x, y in zip(a, b):
        if repr(x) != repr(y):
            return f"{x}\n    {y}"
    return None


# Spark type -> the other engine's type.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def type_difference(types: list[tuple[str, str]], result: duckdb.DuckDBPyRelation) -> str | None:
    mine = {name: SAME_TYPE[kind] for name, kind in types}
    theirs = {name: str(kind) for name, kind in zip(result.columns, result.types)}
    return None if mine == theirs else f"types {sorted(mine.items() ^ theirs.items())}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(folder)
    sql, bad = oracle.oracle_sql(), 0
    chosen = sys.argv[2:] or list(registry.queries())
    for name in chosen:
        began = time.time()
        try:
            df = registry.queries()[name](spark, folder)
            got = df.toPandas()
            took = time.time() - began
            want = con.sql(sql[name])
            found = difference(got, want.df()) or type_difference(df.dtypes, want)
        except Exception as error:  # report and go on with the next query
            took, found = time.time() - began, f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'DIFF'} {name:26s} {took:6.2f}s {found or ''}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
