"""Interval, dimension, semi and backfill joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import forecast, indicators, joins, research, serving
from tickloom.plans import views as v
from tickloom.plans.aggregates import USER_SHARES, USER_TICKS, user_shares, user_ticks
from tickloom.plans.registry import query

W = v.with_


@query(
    "j1_interval_join",
    W(v.TICKS, v.NEWS)
    + """SELECT n.symbol, n.id, n.event_time, p.time, p.close FROM news n JOIN prices p
  ON n.symbol = p.symbol AND p.time BETWEEN n.event_time AND n.event_time + INTERVAL 15 MINUTE""",
)
def j1(spark, sf):
    left = v.news(spark, sf).select("symbol", "id", "event_time")
    return joins.within_after(left, v.prices(spark, sf).select("symbol", "time", "close"))


@query(
    "j2_daily_join",
    W(v.TICKS, v.DAYS)
    + """SELECT t.symbol, t.time, t.close, d.close AS day_close FROM ticks t
LEFT JOIN (SELECT * FROM days WHERE volume > 1500) d
  ON t.symbol = d.symbol AND date_trunc('day', t.time) = d.time""",
)
def j2(spark, sf):
    days = v.day_bars(spark, sf).filter(F.col("volume") > 1500).select(
        "symbol", F.col("time").alias("day"), F.col("close").alias("day_close")
    )
    return research.join_daily(v.ticks(spark, sf).select("symbol", "time", "close"), days)


@query(
    "j3_dimension_lookup",
    W(USER_TICKS, USER_SHARES)
    + """SELECT t.symbol, t.seq, s.shares FROM user_ticks t JOIN shares s ON t.symbol = s.symbol""",
)
def j3(spark, sf):
    return user_ticks(spark, sf).select("symbol", "seq").join(user_shares(spark, sf), "symbol")


@query(
    "j4_semi_join_top",
    W(v.TICKS, v.DAYS)
    + """SELECT symbol, time, close FROM ticks WHERE symbol IN (
  SELECT symbol FROM days GROUP BY symbol
  ORDER BY floor(median(volume)) * avg(close) DESC, symbol LIMIT 3)""",
)
def j4(spark, sf):
    ranked = research.nominal_volume(v.day_bars(spark, sf))
    # Three rows, whatever the data: the records stay where they are.
    top = F.broadcast(research.top_symbols(ranked, "nominal_volume", 3).select("symbol"))
    return v.ticks(spark, sf).select("symbol", "time", "close").join(top, "symbol", "left_semi")


@query(
    "j5_predictions_join",
    W(v.TICKS, v.BARS_1H)
    + """, indexed AS (SELECT symbol, time, close,
  row_number() OVER (PARTITION BY symbol ORDER BY time) - 1 AS time_idx FROM bars_1h)
SELECT a.symbol, a.time_idx, a.close, b.close AS close_predict FROM indexed a
LEFT JOIN indexed b ON a.symbol = b.symbol AND a.time_idx = b.time_idx + 1""",
)
def j5(spark, sf):
    rows = forecast.with_time_idx(v.stored_hour_bars(spark, sf)).select("symbol", "time_idx", "close")
    ahead = rows.select(
        "symbol", (F.col("time_idx") + 1).alias("time_idx"), F.col("close").alias("close_predict")
    )
    return forecast.join_actuals(rows, ahead)


STORED = "stored AS (SELECT * FROM ticks WHERE event_type = 'purchase' AND symbol <> 'S0')"


@query(
    "j6_backfill_gap",
    W(v.TICKS, STORED)
    + """, asked AS (SELECT symbol, date_trunc('day', min(time)) AS lo, date_trunc('day', max(time)) AS hi
  FROM ticks GROUP BY symbol),
bounds AS (SELECT a.symbol, min(s.time) FILTER (s.time >= a.lo) AS b0, max(s.time) FILTER (s.time <= a.hi) AS b1
  FROM asked a LEFT JOIN stored s ON a.symbol = s.symbol GROUP BY a.symbol)
SELECT t.symbol, t.time, t.close FROM ticks t JOIN bounds b ON t.symbol = b.symbol
WHERE b0 IS NULL OR b1 IS NULL OR t.time < b0 OR t.time > b1""",
)
def j6(spark, sf):
    t = v.ticks(spark, sf)
    stored = t.filter((F.col("event_type") == "purchase") & (F.col("symbol") != "S0"))
    return joins.outside_stored(t.select("symbol", "time", "close"), stored)


@query(
    "j7_overlay",
    W(v.TICKS, v.BARS_1H, v.sql_range("bars_1h"))
    + """SELECT b.screener, b.symbol, b.time, b.close, round(i.sma20, 8) + 0e0 AS sma20
FROM bars_1h b LEFT JOIN (SELECT * FROM ind WHERE volume > 50) i
  ON b.screener = i.screener AND b.symbol = i.symbol AND b.time = i.time""",
)
def j7(spark, sf):
    bars = v.hour_bars(spark, sf)
    ind = indicators.range_indicators(bars, v.FRAME_US).filter(F.col("volume") > 50)
    keys = ["screener", "symbol", "time"]
    out = serving.overlay(bars.select(*keys, "close"), ind.select(*keys, "close", "sma20"))
    return v.rounded(out, "sma20", digits=8)
