import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.functions import folds
from tickloom.operators import indicators as ind
from tickloom.operators import segments as sg


def loop_ema(xs, n):
    e = xs[0]
    for x in xs[1:]:
        e = 2 / (n + 1) * x + (1 - 2 / (n + 1)) * e
    return e


def loop_rsi(xs, n=14):
    if len(xs) < n + 1:
        return None
    d = [b - a for a, b in zip(xs, xs[1:])]
    up = sum(max(x, 0) for x in d[:n]) / n
    down = sum(max(-x, 0) for x in d[:n]) / n
    for x in d[n:]:
        up, down = (up * (n - 1) + max(x, 0)) / n, (down * (n - 1) + max(-x, 0)) / n
    return 100.0 if down == 0 else 100 - 100 / (1 + up / down)


def walk(n, seed):
    rng = random.Random(seed)
    xs, x = [], 50.0
    for _ in range(n):
        x = max(1.0, round(x + rng.uniform(-2, 2), 2))
        xs.append(x)
    return xs


@pytest.mark.parametrize("block", [300, 512, 2048])
def test_recursive_indicators_equal_a_plain_loop(spark, bars, block):
    series = {"A": walk(1500, 1), "B": walk(301, 2), "C": walk(14, 3), "D": walk(15, 4)}
    df = bars({s: list(enumerate(xs)) for s, xs in series.items()})
    got = ind.recursive_indicators(df, block=block).orderBy("symbol", "time").collect()
    seen = {}
    for r in got:
        xs = seen.setdefault(r.symbol, [])
        prev = xs[-1] if xs else None
        xs.append(r.close)
        past = xs[-300:]
        assert r.ema12 == pytest.approx(loop_ema(past, 12), abs=1e-9)
        assert r.ema26 == pytest.approx(loop_ema(past, 26), abs=1e-9)
        assert r.macd == pytest.approx(r.ema12 - r.ema26, abs=1e-12)
        want = loop_rsi(past)
        assert (r.rsi14 is None) == (want is None)
        if want is not None:
            assert r.rsi14 == pytest.approx(want, abs=1e-9)
        assert r.ret == (None if prev is None else pytest.approx(r.close - prev))
    assert {s: len(x) for s, x in seen.items()} == {s: len(x) for s, x in series.items()}


def test_rsi_is_100_once_the_losses_have_left_the_history(spark, bars):
    closes = [100.0, 10.0] + [10.0 + i for i in range(700)]
    df = bars({"A": list(enumerate(closes))})
    got = [r.rsi14 for r in ind.recursive_indicators(df, block=300).orderBy("time").collect()]
    assert got[301] == 100.0 and got[-1] == 100.0 and got[200] < 100.0


def test_null_closes_stay_out_of_the_history(spark, bars):
    closes = walk(40, 5)
    points = [(2 * i, c) for i, c in enumerate(closes)] + [(2 * i + 1, None) for i in range(40)]
    got = ind.recursive_indicators(bars({"A": points})).orderBy("time").collect()
    assert [r.ema12 for r in got[1::2]] == [None] * 40
    assert got[-2].ema12 == pytest.approx(loop_ema(closes, 12), abs=1e-9)
    assert got[-2].rsi14 == pytest.approx(loop_rsi(closes), abs=1e-9)


def test_short_spans_use_the_fold_and_agree(spark, bars):
    closes = walk(60, 6)
    got = ind.recursive_indicators(bars({"A": list(enumerate(closes))}), fast=2, slow=3, period=5).orderBy("time")
    last = got.collect()[-1]
    assert last.ema2 == pytest.approx(loop_ema(closes, 2))
    assert last.ema3 == pytest.approx(loop_ema(closes, 3))
    assert last.rsi5 == pytest.approx(loop_rsi(closes, 5))


def test_range_frame_includes_both_ends(spark, bars):
    df = bars({"A": [(0, 10.0), (20, 20.0), (21, 60.0)]})
    got = [r.sma20 for r in ind.range_indicators(df).orderBy("time").collect()]
    assert got == [10.0, 15.0, 40.0]


def test_range_indicators_equal_one_window_per_symbol(spark, bars):
    rng = random.Random(3)
    minutes = sorted(rng.sample(range(5000), 1200))
    df = bars({s: list(zip(minutes, walk(1200, i))) for i, s in enumerate("AB")})
    got = ind.range_indicators(df).select("symbol", "time", F.round("sma20", 8), F.round("bb_upper", 8))
    df.createOrReplaceTempView("b")
    want = spark.sql(
        """SELECT symbol, time, round(avg(close) OVER w, 8),
        round(avg(close) OVER w + 2 * stddev_pop(close) OVER w, 8) FROM b
        WINDOW w AS (PARTITION BY symbol ORDER BY time
                     RANGE BETWEEN INTERVAL 20 MINUTES PRECEDING AND CURRENT ROW)"""
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_vwap_is_null_without_volume(spark, bars):
    got = ind.range_indicators(bars({"A": [(0, 10.0), (1, 20.0)]}, volume=0.0)).collect()
    assert [r.vwap for r in got] == [None, None]


def test_row_means_numbers_lags_and_leads_cross_segments(spark, bars):
    rng = random.Random(4)
    minutes = sorted(rng.sample(range(20000), 700))
    closes = walk(700, 7)
    df = bars({"A": list(zip(minutes, closes)), "B": [(5, 1.0)]})
    rows = sg.number_rows(df, ["symbol"], "time", chunk_us=3600 * 10**6).filter("symbol = 'A'").orderBy("time")
    assert [r._row for r in rows.collect()] == list(range(700))
    sma = ind.row_sma(df, (20, 50), block=64).filter("symbol = 'A'").orderBy("time").collect()
    for i in (0, 5, 19, 20, 63, 64, 65, 400, 699):
        assert sma[i].sma_20 == pytest.approx(sum(closes[max(0, i - 19) : i + 1]) / min(20, i + 1))
        assert sma[i].sma_50 == pytest.approx(sum(closes[max(0, i - 49) : i + 1]) / min(50, i + 1))
    ahead = ind.look_ahead(df, 10, block=16).filter("symbol = 'A'").orderBy("time").collect()
    assert [r.close_ahead for r in ahead] == closes[10:] + [None] * 10
    change = ind.price_change(df).filter("symbol = 'A'").orderBy("time").collect()
    assert change[0].price_change == 0.0
    assert [r.price_change for r in change[1:]] == [b - a for a, b in zip(closes, closes[1:])]


def test_array_forms(spark):
    xs = walk(50, 8)
    df = spark.createDataFrame(
        [(0, xs), (1, []), (2, None), (3, [5.0]), (4, [None, *xs, None])], "id int, p array<double>"
    )
    got = {
        r.id: r
        for r in df.select(
            "id", folds.ema(F.col("p"), 12).alias("e"), folds.macd(F.col("p"), 12, 26).alias("m"),
            folds.rsi(F.col("p"), 14).alias("r"), folds.ema(F.col("p"), 0).alias("z"),
        ).collect()
    }
    for i in (0, 4):
        assert got[i].e == pytest.approx(loop_ema(xs, 12))
        assert got[i].m == pytest.approx(loop_ema(xs, 12) - loop_ema(xs, 26))
        assert got[i].r == pytest.approx(loop_rsi(xs))
    assert (got[1].e, got[2].e, got[3].e, got[3].r) == (None, None, 5.0, None)
    assert all(r.z is None for r in got.values())
    assert math.isfinite(got[0].r)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
@pytest.mark.parametrize("block", [2048, 64])
def test_a_bad_close_leaves_after_the_history(spark, bars, bad, block):
    """With 40 closes of history, the 41st row and all after it are right again."""
    closes = [50 + 10 * math.sin(i) for i in range(200)]
    spoilt = closes[:60] + [bad] + closes[61:]

    def values(series):
        df = bars({"A": list(enumerate(series))})
        out = ind.recursive_indicators(df, history=40, block=block).orderBy("time").toPandas()
        return out[["ema12", "ema26", "macd", "rsi14"]]

    got, want = values(spoilt), values(closes)
    assert got.iloc[60:100].isna().all().all()
    for part in (slice(0, 60), slice(100, None)):
        assert np.allclose(got.iloc[part], want.iloc[part], equal_nan=True)
