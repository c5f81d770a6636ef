import math
from datetime import datetime as T, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import forecast, research, serving


@pytest.fixture
def days(spark):
    rows = []
    for s, base in (("A", 10.0), ("B", 100.0)):
        for i in range(40):
            c = base + (i * 7 % 11)
            rows.append((s, T(2024, 1, 1) + timedelta(days=i), c, c + 1, c - 1, c, 10.0 + i))
    return spark.createDataFrame(
        rows, "symbol string, time timestamp_ntz, open double, high double, low double, close double, volume double"
    )


def test_volatility_equals_pandas_and_does_not_leak(days):
    got = research.historical_volatility(days).orderBy("symbol", "time").toPandas()
    for _, g in got.groupby("symbol"):
        g = g.reset_index(drop=True)
        ret = (g["close"] / g["close"].shift(1)).apply(lambda x: math.log(x) if pd.notna(x) else x)
        want = (ret.rolling(30, min_periods=1).std() * math.sqrt(252)).bfill()
        pd.testing.assert_series_equal(g["hist_vol"], want, check_names=False)


def test_true_range_starts_anew_for_every_symbol(days):
    got = research.average_true_range(days).orderBy("symbol", "time").toPandas()
    for _, g in got.groupby("symbol"):
        g = g.reset_index(drop=True)
        prev = g["close"].shift(1)
        tr = pd.concat([g["high"] - g["low"], g["high"] - prev, prev - g["low"]], axis=1).max(axis=1)
        tr[0] = float("nan")
        pd.testing.assert_series_equal(g["tr"], tr, check_names=False)
        pd.testing.assert_series_equal(g["atr"], tr.rolling(14).mean(), check_names=False)


def test_wilder_atr(days):
    got = research.average_true_range(days, method="wilder").filter("symbol = 'A'").orderBy("time").toPandas()
    tr = got["tr"].dropna().tolist()
    value = sum(tr[:14]) / 14
    for x in tr[14:]:
        value = (value * 13 + x) / 14
    assert got["atr"].iloc[-1] == pytest.approx(value)


def test_backfill_stays_in_the_symbol(spark):
    df = spark.createDataFrame(
        [("A", T(2024, 1, 1), None), ("A", T(2024, 1, 2), 2.0), ("A", T(2024, 1, 3), None),
         ("B", T(2024, 1, 1), None), ("B", T(2024, 1, 2), 5.0)],
        "symbol string, time timestamp_ntz, x double",
    )
    got = research.backfill(df, "x").orderBy("symbol", "time").collect()
    assert [r.x for r in got] == [2.0, 2.0, None, 5.0, 5.0]


@pytest.mark.parametrize("n", [1, 7, 40])
def test_latest_n_keeps_the_newest_rows_of_every_key(days, n):
    got = serving.latest_n(days, ["symbol"], n)
    assert got.count() == 2 * n
    first = T(2024, 1, 1) + timedelta(days=40 - n)
    assert got.agg(F.min("time").alias("t")).first().t == first


def test_latest_n_is_limited_before_the_shuffle(days):
    plan = serving.latest_n(days, ["symbol"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 3


def test_sample_is_repeatable(spark):
    df = spark.range(100).select(F.concat(F.lit("S"), "id").alias("symbol"))
    a = {r.symbol for r in serving.sample_symbols(df, 18, 1).collect()}
    b = {r.symbol for r in serving.sample_symbols(df.repartition(7), 18, 1).collect()}
    assert a == b and len(a) == 18
    assert a != {r.symbol for r in serving.sample_symbols(df, 18, 2).collect()}


def series(spark, n, screener="5m", symbol="A"):
    return spark.createDataFrame(
        [(screener, symbol, T(2024, 1, 1) + timedelta(minutes=5 * i), 1.0, 1.0, 1.0, float(i), 1.0) for i in range(n)],
        "screener string, symbol string, time timestamp_ntz, open double, high double, low double, "
        "close double, volume double",
    )


def test_forecast_frame_steps_by_the_interval(spark):
    frame = forecast.forecast_frame(series(spark, 150)).orderBy("time_idx").collect()
    assert len(frame) == 130 and [r.time_idx for r in frame] == list(range(130))
    assert frame[0].close == 30.0 and not frame[119].is_decoder and frame[120].is_decoder
    assert frame[129].time == frame[119].time + timedelta(minutes=50)
    assert {r.close for r in frame[119:]} == {149.0}


def test_forecast_frame_is_per_series(spark):
    both = series(spark, 3).unionByName(series(spark, 30, "1m", "B"))
    got = {r.symbol: r["count"] for r in forecast.forecast_frame(both).groupBy("symbol").count().collect()}
    assert got == {"A": 13, "B": 40}


def test_prediction_base_is_the_last_bar_and_models_plug_in(spark):
    frame = forecast.forecast_frame(series(spark, 20))
    row = forecast.predict(frame).first()
    assert row.base_time == T(2024, 1, 1) + timedelta(minutes=95)
    assert row.predictions == pytest.approx([20.0 + i for i in range(10)])
    flat = forecast.predict(frame, lambda seen, n: [float(seen["close"].iloc[-1])] * n, "last", 3).first()
    assert flat.predictions == [19.0] * 3 and flat.model == "last"


def test_scores(spark):
    df = spark.createDataFrame([(10.0, 8.0), (10.0, 12.0)], "close double, close_predict double")
    row = forecast.forecast_errors(df).first()
    assert row.mae == 2.0 and row.mape == pytest.approx(0.2)
    assert row.smape == pytest.approx((4 / 18 + 4 / 22) / 2)
    loss = forecast.quantile_loss(df).first()
    assert loss.pinball_30 == pytest.approx((0.3 * 2 + 0.7 * 2) / 2)
    moves = spark.createDataFrame([(1.0, 2.0), (1.0, -2.0), (1.0, None)], "p double, a double")
    assert forecast.directional_accuracy(moves, "p", "a").first().directional_accuracy == pytest.approx(1 / 3)


def test_last_market_cap_takes_the_first_open_of_the_last_time(spark):
    at = T(2024, 1, 1, 9, 0, 30)
    records = spark.createDataFrame(
        [("A", at, 7.0, 5), ("A", at, 6.0, 3), ("A", T(2024, 1, 1, 9, 0, 20), 1.0, 1),
         ("A", T(2024, 1, 1, 8, 0, 50), 2.0, 0)],
        "symbol string, time timestamp_ntz, open double, seq bigint",
    )
    shares = spark.createDataFrame([("A", 1000.0)], "symbol string, shares double")
    assert research.last_market_cap(records, shares, "seq").first().market_cap == 6.0
    rows = research.market_cap(records, shares, "seq").filter(F.col("time") == F.lit(at)).collect()
    assert [r.market_cap for r in rows] == [6.0]


def test_a_zero_price_gives_null_not_an_error(spark):
    df = spark.createDataFrame(
        [("A", T(2024, 1, i), c, c, c, c, 1.0) for i, c in ((1, 0.0), (2, 5.0), (3, 0.0))],
        "symbol string, time timestamp_ntz, open double, high double, low double, close double, volume double",
    )
    got = research.volatility_features(df).orderBy("time").collect()
    assert [r.tr for r in got] == [None, 1.0, None]


def test_volatility_summary_equals_the_means_of_the_features(spark):
    rows = [
        (s, T(2024, 1, 1 + d, 9 + m), c, c, c + m, c - m, 1.0)
        for s, base in (("A", 10.0), ("B", 50.0))
        for d in range(25)
        for m in range(d % 3 + 1)
        for c in [0.0 if (d, m) == (20, 1) else base + (d * 7 + m * 3) % 5]
    ]
    df = spark.createDataFrame(
        rows, "symbol string, time timestamp_ntz, open double, close double, high double, low double, volume double"
    )
    want = research.volatility_features(df).groupBy("symbol").agg(F.avg("hist_vol"), F.avg("atr"))
    got = {r.symbol: tuple(r)[1:] for r in research.volatility_summary(df).collect()}
    assert len(got) == 2
    for r in want.collect():
        assert got[r.symbol] == pytest.approx(tuple(r)[1:])
