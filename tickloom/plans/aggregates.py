"""Bars, ladders, impact and other aggregations; unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import candles, forecast, news, research, serving, signals
from tickloom.plans import views as v
from tickloom.plans.registry import query

W = v.with_
BAR = "screener, symbol, time, open, high, low, close, volume"


@query("a1_ohlcv_bar", W(v.TICKS, v.BARS_1M) + f"SELECT {BAR} FROM bars_1m")
def a1(spark, sf):
    return v.minute_bars(spark, sf)


@query("a2_ladder", W(v.TICKS, v.LADDER) + f"SELECT {BAR} FROM ladder")
def a2(spark, sf):
    return candles.candle_ladder(v.ticks(spark, sf), seq="seq")


_DIRECT = ",\n".join(v.sql_bars(f"d_{n}", n, m, label="start") for n, m in v.RUNGS.items())


@query(
    "a3_direct_ladder",
    W(v.TICKS, _DIRECT) + " UNION ALL ".join(f"SELECT {BAR} FROM d_{n}" for n in v.RUNGS),
)
def a3(spark, sf):
    return candles.direct_ladder(v.ticks(spark, sf), seq="seq")


_RIGHT = ",\n".join(v.sql_right_bars(f"h_{n}", n, m) for n, m in v.RUNGS.items())


@query(
    "a4_right_closed_bar",
    W(v.TICKS, _RIGHT) + " UNION ALL ".join(f"SELECT {BAR} FROM h_{n}" for n in v.RUNGS),
)
def a4(spark, sf):
    return candles.history_ladder(v.ticks(spark, sf), seq="seq")


@query(
    "a5_daily_bar",
    W(v.TICKS, v.DAYS) + "SELECT symbol, time, open, high, low, close, volume FROM days",
)
def a5(spark, sf):
    return v.day_bars(spark, sf)


IMPACT_OUT = (
    "SELECT symbol, id, news_time, title, link, price_before, price_after, max_price, "
    "min_price, n_candles, round(impact_pct, 6) + 0e0 AS impact_pct FROM impact"
)


@query("a6_news_impact", W(v.TICKS, v.NEWS, v.IMPACT) + IMPACT_OUT)
def a6(spark, sf):
    out = news.news_impact(v.news(spark, sf), v.prices(spark, sf), seq="seq")
    return v.rounded(out, "impact_pct")


@query(
    "a6_news_impact_bars",
    W(v.TICKS, v.BARS_1M,
      v.NEWS.replace("SELECT * FROM ticks WHERE event_type <> 'signup'", "SELECT * FROM bars_1m"),
      v.IMPACT) + IMPACT_OUT,
)
def a6_bars(spark, sf):
    out = news.news_impact(v.news(spark, sf), v.minute_bars(spark, sf))
    return v.rounded(out, "impact_pct")


@query("a7_count", W(v.TICKS) + "SELECT symbol, count(*) AS n FROM ticks GROUP BY symbol")
def a7(spark, sf):
    return v.ticks(spark, sf).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a8_nominal_volume",
    W(v.TICKS, v.DAYS)
    + """SELECT symbol, CAST(floor(median(volume)) AS BIGINT) AS median_volume,
       round(avg(close), 6) + 0e0 AS average_price,
       round(floor(median(volume)) * avg(close), 4) + 0e0 AS nominal_volume
FROM days GROUP BY symbol""",
)
def a8(spark, sf):
    out = research.nominal_volume(v.day_bars(spark, sf))
    return v.rounded(v.rounded(out, "average_price"), "nominal_volume", digits=4)


USER_SHARES = (
    "shares AS (SELECT 'U' || CAST(c_custkey AS VARCHAR) AS symbol, "
    "c_acctbal AS shares FROM customer)"
)
USER_TICKS = (
    "user_ticks AS (SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, ts AS time, "
    "value AS open, value AS close, event_id AS seq FROM events)"
)
CAPS = """caps AS (
  SELECT t.symbol, t.time, first_open, s.shares, first_open * s.shares / 1000 AS market_cap
  FROM (SELECT symbol, time, arg_min(open, seq) AS first_open
        FROM user_ticks GROUP BY symbol, time) t
  JOIN shares s ON t.symbol = s.symbol)"""


def user_ticks(spark, sf):
    return v.table(spark, sf, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("ts").alias("time"),
        F.col("value").alias("open"),
        F.col("value").alias("close"),
        F.col("event_id").alias("seq"),
    )


def user_shares(spark, sf):
    return v.table(spark, sf, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("symbol"),
        F.col("c_acctbal").alias("shares"),
    )


def last_caps(spark, sf):
    return research.last_market_cap(user_ticks(spark, sf), user_shares(spark, sf), "seq")


@query(
    "a9_market_cap",
    W(USER_TICKS, USER_SHARES, CAPS)
    + "SELECT symbol, round(arg_max(market_cap, time), 8) + 0e0 AS market_cap FROM caps GROUP BY symbol",
)
def a9(spark, sf):
    return v.rounded(last_caps(spark, sf), "market_cap", digits=8)


@query(
    "a9_market_cap_rows",
    W(USER_TICKS, USER_SHARES, CAPS)
    + "SELECT symbol, time, round(market_cap, 8) + 0e0 AS market_cap FROM caps",
)
def a9_rows(spark, sf):
    out = research.market_cap(user_ticks(spark, sf), user_shares(spark, sf), "seq")
    return v.rounded(out.select("symbol", "time", "market_cap"), "market_cap", digits=8)


VOLATILITY = """rets AS (
  SELECT *, ln(close / lag(close) OVER s) AS log_return, lag(close) OVER s AS prev
  FROM days WINDOW s AS (PARTITION BY symbol ORDER BY time)),
vols AS (
  SELECT *, stddev_samp(log_return) OVER m AS rolling_std,
         stddev_samp(log_return) OVER m * sqrt(252) AS annual_vol,
         CASE WHEN prev IS NOT NULL
              THEN greatest(high - low, high - prev, prev - low) END AS tr_raw
  FROM rets WINDOW m AS (PARTITION BY symbol ORDER BY time
                         ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
atrs AS (
  SELECT *, CASE WHEN count(tr_raw) OVER m >= 14 THEN avg(tr_raw) OVER m END AS atr_raw
  FROM vols WINDOW m AS (PARTITION BY symbol ORDER BY time
                         ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
daily AS (
  SELECT symbol, time AS day, log_return, rolling_std, annual_vol, tr_raw, atr_raw,
         first_value(annual_vol IGNORE NULLS) OVER f AS hist_vol,
         first_value(tr_raw IGNORE NULLS) OVER f AS tr_d,
         first_value(atr_raw IGNORE NULLS) OVER f AS atr_d
  FROM atrs WINDOW f AS (PARTITION BY symbol ORDER BY time
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
features AS (
  SELECT t.*, hist_vol, tr_d / close AS tr, atr_d / close AS atr
  FROM ticks t LEFT JOIN daily d
    ON t.symbol = d.symbol AND date_trunc('day', t.time) = d.day)"""


@query(
    "a10_volatility_summary",
    W(v.TICKS, v.DAYS, VOLATILITY)
    + """SELECT * FROM (SELECT symbol, round(avg(hist_vol), 6) + 0e0 AS hist_vol,
       round(avg(atr), 6) + 0e0 AS atr FROM features GROUP BY symbol)
WHERE hist_vol IS NOT NULL AND atr IS NOT NULL""",
)
def a10(spark, sf):
    return v.rounded(research.volatility_summary(v.ticks(spark, sf), "seq"), "hist_vol", "atr")


@query(
    "a11_time_bounds",
    W(v.TICKS)
    + "SELECT symbol, min(time) AS first_time, max(time) AS last_time FROM ticks GROUP BY symbol",
)
def a11(spark, sf):
    return serving.edge_times(v.ticks(spark, sf), ["symbol"])


@query(
    "a12_profile",
    W(v.TICKS)
    + """SELECT symbol, count(*) AS n_rows, round(avg(close), 6) + 0e0 AS mean_close,
       round(stddev_samp(close), 6) + 0e0 AS std_close, min(close) AS min_close,
       max(close) AS max_close FROM ticks GROUP BY symbol""",
)
def a12(spark, sf):
    out = v.ticks(spark, sf).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("close").alias("mean_close"),
        F.stddev_samp("close").alias("std_close"),
        F.min("close").alias("min_close"),
        F.max("close").alias("max_close"),
    )
    return v.rounded(out, "mean_close", "std_close")


@query(
    "a13_distinct_symbols",
    W(v.TICKS, v.LADDER) + "SELECT DISTINCT screener, symbol FROM ladder",
)
def a13(spark, sf):
    return a2(spark, sf).select("screener", "symbol").distinct()


NAIVE = """scored AS (
  SELECT * FROM (SELECT screener, symbol, time, close,
         lag(close) OVER (PARTITION BY symbol ORDER BY time) AS close_predict FROM bars_1h)
  WHERE close_predict IS NOT NULL)"""


def naive(spark, sf):
    """One-step forecasts: every bar is predicted by the bar before."""
    from tickloom.operators.segments import with_previous

    bars = with_previous(v.stored_hour_bars(spark, sf), ["symbol"], "time", {"close_predict": "close"})
    return bars.filter(F.col("close_predict").isNotNull())


_ERRORS = """round(avg(abs(close - close_predict)), 6) + 0e0 AS mae,
 round(avg(2 * abs(close - close_predict) / (abs(close) + abs(close_predict) + 1e-8)), 6) + 0e0 AS smape,
 round(avg(abs(close - close_predict) / (abs(close) + 1e-8)), 6) + 0e0 AS mape, count(*) AS n"""


@query(
    "a14_forecast_error",
    W(v.TICKS, v.BARS_1H, NAIVE) + f"SELECT symbol, {_ERRORS} FROM scored GROUP BY symbol",
)
def a14(spark, sf):
    return v.rounded(forecast.forecast_errors(naive(spark, sf), ["symbol"]), "mae", "smape", "mape")


@query("a14_forecast_error_overall", W(v.TICKS, v.BARS_1H, NAIVE) + f"SELECT {_ERRORS} FROM scored")
def a14_overall(spark, sf):
    return v.rounded(forecast.forecast_errors(naive(spark, sf)), "mae", "smape", "mape")


@query(
    "a15_quantile_loss",
    W(v.TICKS, v.BARS_1H, NAIVE)
    + "SELECT symbol, "
    + ", ".join(
        f"round(avg(greatest((close - close_predict) * {q}e0, (close - close_predict) * ({q}e0 - 1))), 6)"
        f" + 0e0 AS pinball_{n}"
        for q, n in ((0.3, 30), (0.5, 50), (0.7, 70))
    )
    + " FROM scored GROUP BY symbol",
)
def a15(spark, sf):
    out = forecast.quantile_loss(naive(spark, sf), ["symbol"])
    return v.rounded(out, "pinball_30", "pinball_50", "pinball_70")


@query(
    "a16_directional_accuracy",
    W(v.TICKS, v.BARS_1H)
    + """SELECT symbol, round(avg(CASE WHEN ahead IS NOT NULL AND sign(close - open) = sign(ahead - open)
       THEN 1e0 ELSE 0e0 END), 6) + 0e0 AS directional_accuracy, count(*) AS n
FROM (SELECT *, lead(close, 10) OVER (PARTITION BY symbol ORDER BY time) AS ahead FROM bars_1h)
GROUP BY symbol""",
)
def a16(spark, sf):
    from tickloom.operators.indicators import look_ahead

    bars = look_ahead(v.stored_hour_bars(spark, sf), 10).select(
        "symbol",
        (F.col("close") - F.col("open")).alias("predicted"),
        (F.col("close_ahead") - F.col("open")).alias("actual"),
    )
    out = forecast.directional_accuracy(bars, "predicted", "actual", ["symbol"])
    return v.rounded(out, "directional_accuracy")


@query(
    "a17_target_scale",
    W(v.TICKS, v.BARS_1H)
    + """SELECT b.symbol, b.time, b.close, round((b.close - center) / scale, 6) + 0e0 AS close_scaled
FROM bars_1h b JOIN (SELECT symbol, avg(close) AS center, stddev_samp(close) AS scale
                     FROM bars_1h GROUP BY symbol) s ON b.symbol = s.symbol""",
)
def a17(spark, sf):
    out = forecast.normalise(v.stored_hour_bars(spark, sf))
    return v.rounded(out.select("symbol", "time", "close", "close_scaled"), "close_scaled")


# ---- unions ----------------------------------------------------------------


@query("u1_union_rungs", W(v.TICKS, v.LADDER)
       + "SELECT screener, count(*) AS n, max(high) AS high FROM ladder GROUP BY screener")
def u1(spark, sf):
    return a2(spark, sf).groupBy("screener").agg(
        F.count(F.lit(1)).alias("n"), F.max("high").alias("high")
    )


SIGNALS_1H = (v.sql_range("bars_1h"), v.SPIKES, v.sql_trend("bars_1h", True, "ups"),
              v.sql_trend("bars_1h", False, "downs"))
SIGNAL_UNION = ("SELECT * FROM ups UNION ALL SELECT * FROM downs UNION ALL SELECT * FROM spikes")


@query("u2_union_signals", W(v.TICKS, v.BARS_1H, *SIGNALS_1H) + SIGNAL_UNION)
def u2(spark, sf):
    return signals.signal_table(v.stored_hour_bars(spark, sf), v.FRAME_US)


@query(
    "u3_concat_parts",
    W(v.TICKS)
    + """SELECT symbol, time, close FROM ticks WHERE time < TIMESTAMP '2024-01-10 00:00:00'
UNION ALL SELECT symbol, time, close FROM ticks WHERE time >= TIMESTAMP '2024-01-10 00:00:00'""",
)
def u3(spark, sf):
    t = v.ticks(spark, sf).select("symbol", "time", "close")
    cut = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    return candles.union_all([t.filter(F.col("time") < cut), t.filter(F.col("time") >= cut)])


@query(
    "u4_all_symbols",
    W(v.TICKS)
    + """SELECT symbol, time, close FROM ticks
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) = 1""",
)
def u4(spark, sf):
    return serving.last_row(v.ticks(spark, sf).select("symbol", "time", "close"), ["symbol"])
