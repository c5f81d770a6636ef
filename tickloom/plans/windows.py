"""Rolling, recursive and look-ahead windows; run patterns."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tickloom.functions import folds
from tickloom.functions.times import MINUTE_US
from tickloom.operators import indicators as ind
from tickloom.operators import forecast, research, signals
from tickloom.plans import views as v
from tickloom.plans.aggregates import SIGNALS_1H, VOLATILITY
from tickloom.plans.registry import query

W = v.with_
HOURS = (v.TICKS, v.BARS_1H)
IDS = "screener, symbol, time"
R = v.sql_rounded


def ranged(spark, sf):
    return ind.range_indicators(v.hour_bars(spark, sf), v.FRAME_US)


def pick(df, *columns, digits=6):
    return v.rounded(df.select("screener", "symbol", "time", *columns), *columns, digits=digits)


# Short means of prices with two decimals often end in an exact 5 at the seventh
# decimal, so those are compared at eight.
MEANS = 8


def _range(columns: str) -> str:
    return W(*HOURS, v.sql_range("bars_1h")) + f"SELECT {IDS}, {R(columns, MEANS)} FROM ind"


@query("w1_sma_range", _range("sma20"))
def w1(spark, sf):
    return pick(ranged(spark, sf), "sma20", digits=MEANS)


@query("w2_bollinger", _range("bb_mid bb_upper bb_lower"))
def w2(spark, sf):
    return pick(ranged(spark, sf), "bb_mid", "bb_upper", "bb_lower", digits=MEANS)


@query("w3_rolling_vwap", _range("vwap"))
def w3(spark, sf):
    return pick(ranged(spark, sf), "vwap", digits=MEANS)


@query("w4_rolling_volume", _range("avg_volume"))
def w4(spark, sf):
    return pick(ranged(spark, sf), "avg_volume", digits=MEANS)


@query(
    "w1_w4_minute_frame",
    W(v.TICKS, v.BARS_1M, v.sql_range("bars_1m", "20 MINUTE"))
    + f"SELECT {IDS}, {R('sma20 bb_upper bb_lower vwap avg_volume', MEANS)} FROM ind",
)
def w1_w4(spark, sf):
    out = ind.range_indicators(v.minute_bars(spark, sf))
    return pick(out, "sma20", "bb_upper", "bb_lower", "vwap", "avg_volume", digits=MEANS)


def _rows(n: int) -> str:
    return (
        W(*HOURS)
        + f"""SELECT {IDS}, round(avg(close) OVER (PARTITION BY symbol ORDER BY time
  ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), {MEANS}) + 0e0 AS sma_{n} FROM bars_1h"""
    )


@query("w5_sma20_rows", _rows(20))
def w5(spark, sf):
    return pick(ind.row_sma(v.stored_hour_bars(spark, sf), (20,)), "sma_20", digits=MEANS)


@query("w6_sma50_rows", _rows(50))
def w6(spark, sf):
    return pick(ind.row_sma(v.stored_hour_bars(spark, sf), (50,)), "sma_50", digits=MEANS)


def recursive(spark, sf):
    return ind.recursive_indicators(v.stored_hour_bars(spark, sf))


def _rec(columns: str) -> str:
    return W(*HOURS, v.sql_recursive("bars_1h")) + f"SELECT {IDS}, {R(columns)} FROM rec"


@query("w7_ema", _rec("ema12 ema26"))
def w7(spark, sf):
    return pick(recursive(spark, sf), "ema12", "ema26")


@query("w8_macd", _rec("macd"))
def w8(spark, sf):
    return pick(recursive(spark, sf), "macd")


@query("w9_rsi", _rec("rsi14"))
def w9(spark, sf):
    return pick(recursive(spark, sf), "rsi14")


@query(
    "w7_w10_indicator_table",
    W(*HOURS, v.sql_range("bars_1h"), v.sql_recursive("ind"))
    + f"SELECT {IDS}, close, "
    + R("sma20 ema12 ema26 macd rsi14 bb_mid bb_upper bb_lower vwap ret")
    + " FROM rec",
)
def indicator_table(spark, sf):
    out = ind.indicator_table(v.stored_hour_bars(spark, sf), v.FRAME_US)
    return v.rounded(out, *[c for c in ind.INDICATOR_COLUMNS if c not in
                            ("screener", "symbol", "time", "close")])


@query(
    "w10_return",
    W(*HOURS)
    + f"""SELECT {IDS}, round(close - lag(close) OVER (PARTITION BY symbol ORDER BY time), 6)
  + 0e0 AS ret FROM bars_1h""",
)
def w10(spark, sf):
    return pick(ind.returns(v.stored_hour_bars(spark, sf)), "ret")


@query(
    "w11_price_change",
    W(*HOURS)
    + f"""SELECT {IDS}, round(close - prev, 6) + 0e0 AS price_change,
  round((close - prev) / prev * 100, 6) + 0e0 AS price_change_pct
FROM (SELECT *, lag(close, 1, close) OVER (PARTITION BY symbol ORDER BY time) AS prev FROM bars_1h)""",
)
def w11(spark, sf):
    return pick(ind.price_change(v.stored_hour_bars(spark, sf)), "price_change", "price_change_pct")


def volatility_days(spark, sf):
    return research.average_true_range(research.historical_volatility(v.day_bars(spark, sf)))


def _daily(expressions: str) -> str:
    return (
        W(v.TICKS, v.DAYS, VOLATILITY)
        + f"SELECT symbol, day AS time, {expressions} FROM daily"
    )


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0e0 AS {name}"


def daily_pick(df, *columns):
    return v.rounded(df.select("symbol", "time", *columns), *columns)


@query("w12_log_return", _daily(_r("log_return", "log_return")))
def w12(spark, sf):
    return daily_pick(research.log_returns(v.day_bars(spark, sf)), "log_return")


@query("w13_rolling_std", _daily(_r("rolling_std", "rolling_std")))
def w13(spark, sf):
    return daily_pick(volatility_days(spark, sf), "rolling_std")


@query("w14_annual_volatility", _daily(_r("annual_vol", "annual_vol")))
def w14(spark, sf):
    return daily_pick(volatility_days(spark, sf), "annual_vol")


@query("w15_backfill", _daily(", ".join([_r("hist_vol", "hist_vol"), _r("tr_d", "tr"), _r("atr_d", "atr")])))
def w15(spark, sf):
    return daily_pick(research.backfill(volatility_days(spark, sf), "tr", "atr"), "hist_vol", "tr", "atr")


@query("w16_true_range", _daily(_r("tr_raw", "tr")))
def w16(spark, sf):
    return daily_pick(research.true_range(v.day_bars(spark, sf)), "tr")


@query(
    "w17_atr",
    W(v.TICKS, v.DAYS, VOLATILITY)
    + "SELECT symbol, time, round(tr, 6) + 0e0 AS tr, round(atr, 6) + 0e0 AS atr FROM features",
)
def w17(spark, sf):
    return daily_pick(research.volatility_features(v.ticks(spark, sf), "seq"), "tr", "atr")


@query(
    "w17_atr_wilder",
    W(v.TICKS, v.DAYS, VOLATILITY)
    + """SELECT symbol, time, round(CASE WHEN len(l) >= 14 THEN
  list_reduce(list_concat([list_sum(l[1:14]) / 14e0], l[15:]),
              lambda acc, x: (acc * 13 + x) / 14e0) END, 6) + 0e0 AS atr
FROM (SELECT symbol, time, list(tr_raw) FILTER (tr_raw IS NOT NULL) OVER (
        PARTITION BY symbol ORDER BY time ROWS BETWEEN 299 PRECEDING AND CURRENT ROW) AS l
      FROM atrs)""",
)
def w17_wilder(spark, sf):
    return daily_pick(
        research.average_true_range(v.day_bars(spark, sf), method="wilder"), "atr"
    )


@query(
    "w18_time_idx",
    W(v.TICKS)
    + """SELECT symbol, time, row_number() OVER (PARTITION BY symbol ORDER BY time) - 1 AS time_idx
FROM ticks""",
)
def w18(spark, sf):
    rows = v.ticks(spark, sf).select("symbol", "time", "seq")
    return forecast.with_time_idx(rows, tie_breakers=["seq"], chunk_us=MINUTE_US).drop("seq")


@query(
    "w19_first_open",
    W(v.TICKS)
    + """SELECT symbol, time, first_value(open) OVER (PARTITION BY symbol, time ORDER BY seq)
  AS first_open FROM ticks""",
)
def w19(spark, sf):
    t = v.ticks(spark, sf)
    at = Window.partitionBy("symbol", "time").orderBy("seq")
    return t.select("symbol", "time", F.first("open").over(at).alias("first_open"))


@query(
    "w20_look_ahead",
    W(*HOURS)
    + f"SELECT {IDS}, lead(close, 10) OVER (PARTITION BY symbol ORDER BY time) AS close_ahead FROM bars_1h",
)
def w20(spark, sf):
    return ind.look_ahead(v.stored_hour_bars(spark, sf), 10).select("screener", "symbol", "time", "close_ahead")


@query("w21_shared_window", _range("sma20 bb_mid bb_upper bb_lower vwap avg_volume"))
def w21(spark, sf):
    return pick(ranged(spark, sf), "sma20", "bb_mid", "bb_upper", "bb_lower", "vwap", "avg_volume", digits=MEANS)


# ---- run patterns ----------------------------------------------------------


@query("m1_trend_up", W(*HOURS, v.sql_trend("bars_1h", True)) + "SELECT * FROM trend")
def m1(spark, sf):
    return signals.trend_signals(v.stored_hour_bars(spark, sf), True)


@query("m2_trend_down", W(*HOURS, v.sql_trend("bars_1h", False)) + "SELECT * FROM trend")
def m2(spark, sf):
    return signals.trend_signals(v.stored_hour_bars(spark, sf), False)


@query("m1_trend_up_minutes", W(v.TICKS, v.BARS_1M, v.sql_trend("bars_1m", True)) + "SELECT * FROM trend")
def m1_minutes(spark, sf):
    return signals.trend_signals(v.minute_bars(spark, sf), True)


@query("m3_volume_spike", W(*HOURS, *SIGNALS_1H[:2]) + "SELECT * FROM spikes")
def m3(spark, sf):
    return signals.volume_spikes(v.hour_bars(spark, sf), v.FRAME_US)


@query(
    "m4_run_length",
    W(*HOURS, v.sql_trend("bars_1h", True, length=4)) + "SELECT symbol, signal_time, price FROM trend",
)
def m4(spark, sf):
    return signals.trend_signals(v.stored_hour_bars(spark, sf), True, 4).select("symbol", "signal_time", "price")


# ---- array forms -----------------------------------------------------------

# One array of daily closes per symbol: bounded by the calendar.
CLOSES = """closes AS (SELECT symbol, list(close ORDER BY time) AS l FROM days GROUP BY symbol)"""


def day_closes(spark, sf):
    days = v.day_bars(spark, sf).groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("time", "close"))).alias("_days")
    )
    return days.select("symbol", F.col("_days.close").alias("closes"))


def _array(expr: str, name: str) -> str:
    return W(v.TICKS, v.DAYS, CLOSES) + f"SELECT symbol, round({expr}, 6) + 0e0 AS {name} FROM closes"


@query("y1_ema_array", _array(v.sql_ema("l", 12), "ema12"))
def y1(spark, sf):
    out = day_closes(spark, sf).select("symbol", folds.ema(F.col("closes"), 12).alias("ema12"))
    return v.rounded(out, "ema12")


@query("y2_rsi_array", _array(v.sql_rsi("l"), "rsi14"))
def y2(spark, sf):
    out = day_closes(spark, sf).select("symbol", folds.rsi(F.col("closes"), 14).alias("rsi14"))
    return v.rounded(out, "rsi14")


@query("y3_macd_array", _array(f"{v.sql_ema('l', 12)} - {v.sql_ema('l', 26)}", "macd"))
def y3(spark, sf):
    out = day_closes(spark, sf).select("symbol", folds.macd(F.col("closes")).alias("macd"))
    return v.rounded(out, "macd")
