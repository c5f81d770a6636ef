from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions.times import HOUR_US, MINUTE_US
from tickloom.operators import candles, news

T = datetime


def ticks(spark, rows):
    """rows: (symbol, time, price, volume, seq)"""
    return spark.createDataFrame(
        [(s, t, p, p, p, p, v, q) for s, t, p, v, q in rows],
        "symbol string, time timestamp_ntz, open double, high double, low double, "
        "close double, volume double, seq bigint",
    )


def test_first_and_last_follow_time_then_sequence(spark):
    at = T(2024, 1, 1, 9, 0, 20)
    df = ticks(
        spark,
        [
            ("A", T(2024, 1, 1, 9, 0, 40), 7.0, 1.0, 1),
            ("A", at, 5.0, 1.0, 9),
            ("A", at, 4.0, 1.0, 2),
            ("A", T(2024, 1, 1, 9, 0, 40), 8.0, 1.0, 5),
        ],
    ).repartition(4)
    row = candles.rollup(df, MINUTE_US, seq="seq").collect()
    assert [tuple(r) for r in row] == [
        ("A", T(2024, 1, 1, 9, 0, 59, 999000), 4.0, 8.0, 4.0, 8.0, 4.0)
    ]


def test_hour_from_raw_uses_sequence_too(spark):
    at = T(2024, 1, 1, 9, 5)
    df = ticks(spark, [("A", at, 5.0, 1.0, 9), ("A", at, 4.0, 1.0, 2)])
    row = candles.rollup(df, HOUR_US, "start", seq="seq").first()
    assert (row.open, row.close, row.time) == (4.0, 5.0, T(2024, 1, 1, 9))


@pytest.mark.parametrize(
    "closed,label,expected",
    [
        ("left", "start", [T(2024, 1, 1, 9, 0), T(2024, 1, 1, 9, 1)]),
        ("left", "end", [T(2024, 1, 1, 9, 1), T(2024, 1, 1, 9, 2)]),
        ("left", "window_time", [T(2024, 1, 1, 9, 0, 59, 999000), T(2024, 1, 1, 9, 1, 59, 999000)]),
        ("right", "end", [T(2024, 1, 1, 9, 0), T(2024, 1, 1, 9, 1)]),
    ],
)
def test_edges_and_labels(spark, closed, label, expected):
    df = ticks(spark, [("A", T(2024, 1, 1, 9, 0), 1.0, 1.0, 1), ("A", T(2024, 1, 1, 9, 1), 2.0, 1.0, 2)])
    got = candles.rollup(df, MINUTE_US, label, closed).orderBy("time").collect()
    assert [r.time for r in got] == expected


def test_right_closed_bins_equal_pandas(spark):
    start = pd.Timestamp("2024-01-01 09:00:00")
    rows = [("A", (start + pd.Timedelta(seconds=20 * i)).to_pydatetime(), float(i % 17), 1.0, i) for i in range(200)]
    df = ticks(spark, rows)
    pdf = pd.DataFrame(rows, columns=["symbol", "time", "p", "v", "seq"]).set_index("time")
    want = (
        pdf.resample("5min", label="right", closed="right")
        .agg(open=("p", "first"), high=("p", "max"), low=("p", "min"), close=("p", "last"), volume=("v", "sum"))
        .dropna()
        .reset_index()
    )
    got = (
        candles.history_ladder(df).filter("screener = '5m'").drop("screener", "symbol").orderBy("time").toPandas()
    )
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_cascade_equals_direct(spark):
    rows = [(f"S{i % 3}", T(2024, 1, 1, 9 + i // 60 % 5, i % 60, i % 50), float(i * 7 % 101), 1.0, i) for i in range(600)]
    df = ticks(spark, rows)
    a = candles.candle_ladder(df, "seq", label="start")
    b = candles.direct_ladder(df, seq="seq", label="start")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_ladder_places_minute_bars_once(spark):
    df = ticks(spark, [("A", T(2024, 1, 1), 5.0, 1.0, 1)])
    out = candles.candle_ladder(df, seq="seq")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [line.strip(" +-:|") for line in plan.splitlines()]
    exchanges = [x for x in lines if x.lstrip("*()0123456789 ").startswith("Exchange")]
    assert len(exchanges) <= 2, plan
    assert "SortAggregate" not in plan


def test_incomplete_bars_are_dropped(spark):
    df = ticks(spark, [("A", T(2024, 1, 1), 5.0, None, 1), ("A", T(2024, 1, 2), 5.0, 1.0, 1)])
    assert [r.time for r in candles.daily(df).collect()] == [T(2024, 1, 2)]


BIG = (-(2**63), -5, 0, 2**40, 2**62, 2**63 - 1)


@pytest.mark.parametrize("width", [MINUTE_US, 60 * MINUTE_US])
def test_ties_follow_any_sequence_number(spark, width):
    at = datetime(2024, 1, 1, 9, 0, 30)
    rows = [("A", at, float(i), q) for i, q in enumerate(BIG)] + [("B", at, 9.0, 7), ("B", at, 8.0, None)]
    df = spark.createDataFrame(rows[::-1], "symbol string, time timestamp_ntz, close double, seq bigint")
    for c in ("open", "high", "low", "volume"):
        df = df.withColumn(c, F.col("close"))
    got = {r.symbol: (r.open, r.close) for r in candles.rollup(df, width, seq="seq").collect()}
    assert got == {"A": (0.0, 5.0), "B": (8.0, 9.0)}


def test_later_time_beats_a_higher_sequence_number(spark):
    rows = [("A", datetime(2024, 1, 1, 9, 0, 1), 1.0, 2**62), ("A", datetime(2024, 1, 1, 9, 0, 2), 2.0, -7)]
    df = spark.createDataFrame(rows, "symbol string, time timestamp_ntz, close double, seq bigint")
    for c in ("open", "high", "low", "volume"):
        df = df.withColumn(c, F.col("close"))
    row = candles.rollup(df, seq="seq").first()
    assert (row.open, row.close) == (1.0, 2.0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_and_news_impact_hash_their_rows(spark):
    rows = spark.createDataFrame(
        [], "symbol string, time timestamp_ntz, open double, high double, low double, close double, "
        "volume double, seq bigint"
    )
    news_rows = spark.createDataFrame(
        [], "symbol string, id string, event_time timestamp_ntz, title string, link string"
    )
    for df in (candles.rollup(rows, seq="seq"), news.news_impact(news_rows, rows, seq="seq")):
        assert "SortAggregate" not in plan_of(df) and "HashAggregate" in plan_of(df)
