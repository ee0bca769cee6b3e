from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.functions.dates import days_between, week_start, weeks_between
from clicktide.functions.nested import has_param, param_int, param_str, repeated_keys, session_key
from clicktide.functions.numeric import lenient_long, money, pct, r2


def test_rounding_matches_scaled_half_away(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.round(rng.uniform(-1000, 1000, 20_000), 3), [0.005, -0.005, 1.005, 2.675, 0.0]])
    frame = pd.DataFrame({"x": values})
    got = spark.createDataFrame(frame).select(r2(F.col("x")).alias("y")).toPandas()["y"]
    want = duckdb.sql("SELECT round(x, 2) AS y FROM frame").df()["y"]
    assert (got.to_numpy() == want.to_numpy()).all()


def test_pct_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(pct(F.col("a"), F.col("b"))).collect()] == [33.33, None]


def test_money(spark):
    df = spark.createDataFrame([("12.5",), ("-3",), ("abc",), (None,), ("",)], "x string")
    assert [r[0] for r in df.select(money(F.col("x"))).collect()] == [12.5, 0.0, 0.0, 0.0, 0.0]


def test_lenient_long(spark):
    text = ["1", "1.9", "2.5", "-2.5", "0.5", "x", None, "7.49"]
    df = spark.createDataFrame([(t,) for t in text], "q string")
    assert [r[0] for r in df.select(lenient_long(df, "q")).collect()] == [1, 2, 3, -3, 1, None, None, 7]
    numbers = [1.5, 2.5, -0.5, -1.5, 3.4, None, float("nan"), 1e300]
    df = spark.createDataFrame([(n,) for n in numbers], T.StructType([T.StructField("q", T.DoubleType())]))
    assert [r[0] for r in df.select(lenient_long(df, "q")).collect()] == [2, 2, 0, -2, 3, None, None, None]
    df = spark.createDataFrame([(4,), (None,)], "q bigint")
    assert [r[0] for r in df.select(lenient_long(df, "q")).collect()] == [4, None]


def test_param_lookups(spark):
    rows = [
        ([("a", (1, None)), ("p", (None, "/x"))],),
        ([("a", (None, None)), ("a", (2, None))],),
        ([("a", None)],),
        ([],),
        (None,),
    ]
    df = spark.createDataFrame(rows, "ps array<struct<key:string,value:struct<int_value:bigint,string_value:string>>>")
    ps = F.col("ps")
    got = df.select(
        param_int(ps, "a"), param_str(ps, "p"), has_param(ps, "a", 1), has_param(ps, "a", 2), repeated_keys(ps, "a")
    ).collect()
    assert [tuple(r) for r in got] == [
        (1, "/x", True, False, 0),
        (None, None, False, True, 1),
        (None, None, False, False, 0),
        (None, None, False, False, 0),
        (None, None, False, False, 0),
    ]


def test_session_key(spark):
    df = spark.createDataFrame([("u", 1), ("u", None), (None, 1)], "u string, n bigint")
    assert [r[0] for r in df.select(session_key(F.col("u"), F.col("n"))).collect()] == ["u-1", None, None]


def test_weeks_start_on_monday(spark):
    df = spark.createDataFrame([("2020-11-01", "2020-11-09")], "a string, b string")
    a, b = F.col("a").cast("date"), F.col("b").cast("date")
    row = df.select(week_start(a), weeks_between(week_start(a), week_start(b)), days_between(a, b)).first()
    assert (str(row[0]), row[1], row[2]) == ("2020-10-26", 2, 8)
