"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import scalars as sc, times
from tickloom.operators import candles, forecast, indicators, serving, signals
from tickloom.plans import views as v
from tickloom.plans.aggregates import SIGNAL_UNION, SIGNALS_1H
from tickloom.plans.registry import query
from tickloom.plans.scalars import MIXED, mixed_text
from tickloom.sources import records

W = v.with_


@query(
    "p1_projection",
    W(v.TICKS, v.BARS_1M)
    + "SELECT '1m' AS label, symbol AS ticker, time AS bar_time, close AS price FROM bars_1m",
)
def p1(spark, sf):
    return v.minute_bars(spark, sf).select(
        F.lit("1m").alias("label"),
        F.col("symbol").alias("ticker"),
        F.col("time").alias("bar_time"),
        F.col("close").alias("price"),
    )


@query(
    "p2_event_time",
    f"""SELECT * FROM (SELECT event_id, TRY_CAST({MIXED} AS TIMESTAMP) AS event_time FROM events)
WHERE event_time IS NOT NULL""",
)
def p2(spark, sf):
    rows = mixed_text(spark, sf).select("event_id", times.event_time("text").alias("event_time"))
    return rows.filter(F.col("event_time").isNotNull())


@query(
    "p3_guarded_division",
    W(v.TICKS)
    + """SELECT seq, CASE WHEN volume - 50 > 0 THEN close / (volume - 50) END AS ratio FROM ticks""",
)
def p3(spark, sf):
    return v.ticks(spark, sf).select(
        "seq", sc.guarded_ratio(F.col("close"), F.col("volume") - 50).alias("ratio")
    )


@query(
    "p4_spike_filter",
    W(v.TICKS, v.BARS_1H, v.sql_range("bars_1h"))
    + """SELECT symbol, time, volume, round(avg_volume, 6) + 0e0 AS avg_volume FROM ind
WHERE avg_volume IS NOT NULL AND volume > 3 * avg_volume""",
)
def p4(spark, sf):
    bars = indicators.range_indicators(v.hour_bars(spark, sf), v.FRAME_US)
    hits = bars.filter(F.col("avg_volume").isNotNull() & (F.col("volume") > 3 * F.col("avg_volume")))
    return v.rounded(hits.select("symbol", "time", "volume", "avg_volume"), "avg_volume")


@query(
    "p5_key_filter",
    W(v.TICKS, v.LADDER)
    + "SELECT time, open, high, low, close, volume FROM ladder WHERE symbol = 'S3' AND screener = '15m'",
)
def p5(spark, sf):
    rungs = candles.candle_ladder(v.ticks(spark, sf), seq="seq")
    return rungs.filter((F.col("symbol") == "S3") & (F.col("screener") == "15m")).select(
        "time", "open", "high", "low", "close", "volume"
    )


@query(
    "p6_time_range",
    W(v.TICKS)
    + """SELECT symbol, time, close FROM ticks
WHERE time >= TIMESTAMP '2024-01-05 00:00:00' AND time <= TIMESTAMP '2024-01-12 12:00:00'""",
)
def p6(spark, sf):
    lo, hi = (F.lit(s).cast("timestamp_ntz") for s in ("2024-01-05 00:00:00", "2024-01-12 12:00:00"))
    t = v.ticks(spark, sf).select("symbol", "time", "close")
    return t.filter((F.col("time") >= lo) & (F.col("time") <= hi))


@query(
    "p7_outside_range",
    W(v.TICKS)
    + """SELECT symbol, time, close FROM ticks
WHERE time < TIMESTAMP '2024-01-05 00:00:00' OR time > TIMESTAMP '2024-01-12 12:00:00'""",
)
def p7(spark, sf):
    lo, hi = (F.lit(s).cast("timestamp_ntz") for s in ("2024-01-05 00:00:00", "2024-01-12 12:00:00"))
    t = v.ticks(spark, sf).select("symbol", "time", "close")
    return t.filter((F.col("time") < lo) | (F.col("time") > hi))


@query(
    "p8_split",
    W(v.TICKS)
    + """SELECT symbol, time, CASE WHEN time < TIMESTAMP '2024-01-20 00:00:00' THEN 'train'
  WHEN time < TIMESTAMP '2024-01-25 00:00:00' THEN 'validation' ELSE 'test' END AS split FROM ticks""",
)
def p8(spark, sf):
    t = v.ticks(spark, sf).select("symbol", "time")
    return forecast.split_by_time(t, "2024-01-20 00:00:00", "2024-01-25 00:00:00")


@query(
    "p9_membership",
    """SELECT event_id, user_id FROM events WHERE user_id IN (
  SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def p9(spark, sf):
    known = v.table(spark, sf, "customer").filter(F.col("c_mktsegment") == "MACHINERY")
    rows = v.table(spark, sf, "events").select("event_id", "user_id")
    return rows.join(known.select(F.col("c_custkey").alias("user_id")), "user_id", "left_semi")


@query(
    "p10_session",
    """SELECT event_id, CASE WHEN isodow(ts) <= 5
  AND (CAST(ts AS TIME) BETWEEN TIME '09:00:00' AND TIME '11:30:00'
    OR CAST(ts AS TIME) BETWEEN TIME '13:00:00' AND TIME '14:30:00')
  THEN 'open' ELSE 'closed' END AS state FROM events""",
)
def p10(spark, sf):
    return v.table(spark, sf, "events").select("event_id", times.session_state("ts").alias("state"))


@query(
    "p11_drop_incomplete",
    W(v.TICKS, v.sql_bars("day_bars", "1D", 1440,
                          "(SELECT * REPLACE (CASE WHEN volume > 50 THEN volume END AS volume) FROM ticks)",
                          "start"))
    + "SELECT symbol, time, open, high, low, close, volume FROM day_bars WHERE volume IS NOT NULL",
)
def p11(spark, sf):
    volume = F.when(F.col("volume") > 50, F.col("volume"))
    return candles.daily(v.ticks(spark, sf).withColumn("volume", volume), seq="seq")


BOOK_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS symbol, l_shipdate AS handle_time,
  l_extendedprice * 1.07e0 AS ceiling, l_extendedprice * 0.93e0 AS floor, l_extendedprice AS reference,
  l_quantity * 10 AS room_foreign, l_quantity AS foreign_buy_volume, l_tax * 100 AS foreign_sell_volume,
  l_extendedprice - 1 AS buy_1, CAST(l_linenumber AS BIGINT) AS buy_1_volume,
  l_extendedprice - 2 AS buy_2, l_partkey AS buy_2_volume,
  l_extendedprice - 3 AS buy_3, l_suppkey AS buy_3_volume,
  l_extendedprice + 1 AS sell_1, CAST(l_linenumber AS BIGINT) AS sell_1_volume,
  l_extendedprice + 2 AS sell_2, l_partkey AS sell_2_volume,
  l_extendedprice + 3 AS sell_3, l_suppkey AS sell_3_volume,
  l_extendedprice + 5 AS highest, l_extendedprice - 5 AS lowest, l_extendedprice AS average
FROM lineitem"""


def book_messages(spark, sf):
    """Line items as nested order-book messages."""
    price = F.col("l_extendedprice")
    volumes = [F.col("l_linenumber").cast("long"), F.col("l_partkey"), F.col("l_suppkey")]

    def depth(side: str, sign: int):
        levels = [(price + sign * i).alias(f"{side}_{i}") for i in (1, 2, 3)]
        return F.struct(*levels, *[c.alias(f"{side}_{i}_volume") for i, c in enumerate(volumes, 1)])

    rows = v.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("string").alias("handle_time"),
        F.col("l_orderkey").cast("string").alias("symbol"),
        (price * 1.07).alias("ceiling"),
        (price * 0.93).alias("floor"),
        price.alias("reference"),
        (F.col("l_quantity") * 10).alias("Room_foreign"),
        F.col("l_quantity").alias("foreign_buy_volume"),
        (F.col("l_tax") * 100).alias("foreign_sell_volume"),
        depth("Buy", -1).alias("Buy"),
        depth("Sell", 1).alias("Sell"),
        (price + 5).alias("highest"),
        (price - 5).alias("lowest"),
        price.alias("average"),
    )
    return records.encode(rows)


@query("p12_flatten_book", BOOK_SQL)
def p12(spark, sf):
    return serving.flatten_book(records.order_book_records(book_messages(spark, sf)))


@query(
    "p13_net_foreign_flow",
    f"""SELECT symbol, handle_time, round(foreign_buy_volume - foreign_sell_volume, 6) + 0e0 AS net_foreign
FROM ({BOOK_SQL})""",
)
def p13(spark, sf):
    out = p12(spark, sf).select("symbol", "handle_time", sc.net_foreign_flow().alias("net_foreign"))
    return v.rounded(out, "net_foreign")


@query(
    "p14_candle_colour",
    W(v.TICKS, v.BARS_1H)
    + "SELECT symbol, time, CASE WHEN close < open THEN 'red' ELSE 'green' END AS colour FROM bars_1h",
)
def p14(spark, sf):
    return v.hour_bars(spark, sf).select("symbol", "time", sc.candle_colour().alias("colour"))


@query(
    "p15_side_label",
    W(v.TICKS, v.BARS_1H, *SIGNALS_1H)
    + "SELECT symbol, signal_time, signal_type, CASE side "
    + " ".join(f"WHEN '{k}' THEN '{label}'" for k, label in sc.SIDE_LABELS.items())
    + f" ELSE side END AS side FROM ({SIGNAL_UNION})",
)
def p15(spark, sf):
    return signals.signal_table(v.stored_hour_bars(spark, sf), v.FRAME_US).select(
        "symbol", "signal_time", "signal_type", sc.side_label().alias("side")
    )


@query(
    "p16_rsi_zone",
    W(v.TICKS, v.BARS_1H, v.sql_recursive("bars_1h"))
    + """SELECT symbol, time, CASE WHEN rsi14 >= 70 THEN 'overbought' WHEN rsi14 <= 30 THEN 'oversold'
  WHEN rsi14 IS NOT NULL THEN 'neutral' END AS zone FROM rec""",
)
def p16(spark, sf):
    bars = indicators.recursive_indicators(v.stored_hour_bars(spark, sf))
    return bars.select("symbol", "time", sc.rsi_zone().alias("zone"))


@query(
    "p17_coercion",
    "SELECT ts AS time, value AS close, CAST(user_id AS VARCHAR) AS symbol FROM events",
)
def p17(spark, sf):
    text = v.table(spark, sf, "events").select(
        F.col("ts").cast("string").alias("time"),
        F.col("value").cast("string").alias("close"),
        F.col("user_id").alias("symbol"),
    )
    return records.coerce(text, ["time"], ["close"], ["symbol"])
