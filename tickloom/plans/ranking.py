"""Latest-N, top-k, sorted and sampled views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import candles, forecast, indicators, news, research, serving, signals
from tickloom.plans import views as v
from tickloom.plans.aggregates import CAPS, NAIVE, SIGNAL_UNION, SIGNALS_1H, USER_SHARES, USER_TICKS, last_caps, naive
from tickloom.plans.registry import query
from tickloom.schemas import TABLES
from tickloom.session import fresh_path
from tickloom.sources import tables

W = v.with_


def ladder(spark, sf):
    return candles.candle_ladder(v.ticks(spark, sf), seq="seq")


def _latest(columns: str, source: str, keys: str, order: str, n: int) -> str:
    return (
        f"SELECT {columns} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) <= {n}"
    )


BAR = "screener, symbol, time, open, high, low, close, volume"


@query(
    "k1_latest_candles",
    W(v.TICKS, v.LADDER) + _latest(BAR, "ladder", "screener, symbol", "time DESC", 500),
)
def k1_candles(spark, sf):
    return serving.latest_n(ladder(spark, sf), ["screener", "symbol"], 500)


@query(
    "k1_latest_of_symbol",
    W(v.TICKS, v.LADDER)
    + f"SELECT {BAR} FROM ladder WHERE screener = '1m' AND symbol = 'S3' ORDER BY time DESC LIMIT 500",
)
def k1_symbol(spark, sf):
    """One symbol's newest bars out of the stored table; only its group is read."""
    root = fresh_path(spark, "tables")
    tables.bulk_write(ladder(spark, sf), root, TABLES["ohlvc"])
    bars = tables.read_key(spark, root, TABLES["ohlvc"], screener="1m", symbol="S3")
    return serving.latest_n(bars, ["screener", "symbol"], 500)


BOOK = """book AS (
  SELECT 'P' || CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS handle_time,
         l_orderkey, l_linenumber, l_partkey, l_extendedprice AS buy_1, l_quantity AS volume
  FROM lineitem)"""


def book(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").alias("handle_time"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("l_extendedprice").alias("buy_1"),
        F.col("l_quantity").alias("volume"),
    )


_BOOK_TIES = ("l_orderkey", "l_linenumber", "l_partkey", "buy_1", "volume")


@query(
    "k1_latest_book",
    W(BOOK)
    + _latest("symbol, handle_time, l_orderkey, buy_1", "book", "symbol",
              "handle_time DESC, " + ", ".join(_BOOK_TIES), 1),
)
def k1_book(spark, sf):
    out = serving.latest_n(book(spark, sf), ["symbol"], 1, "handle_time", _BOOK_TIES)
    return out.select("symbol", "handle_time", "l_orderkey", "buy_1")


@query(
    "k1_latest_indicators",
    W(v.TICKS, v.BARS_1H, v.sql_range("bars_1h"))
    + "SELECT screener, symbol, time, close, " + v.sql_rounded("sma20 bb_upper bb_lower vwap")
    + " FROM ind QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY time DESC) <= 200",
)
def k1_indicators(spark, sf):
    rows = indicators.range_indicators(v.hour_bars(spark, sf), v.FRAME_US).select(
        "screener", "symbol", "time", "close", "sma20", "bb_upper", "bb_lower", "vwap"
    )
    out = serving.latest_n(rows, ["screener", "symbol"], 200)
    return v.rounded(out, "sma20", "bb_upper", "bb_lower", "vwap")


@query(
    "k1_latest_signals",
    W(v.TICKS, v.BARS_1H, *SIGNALS_1H, f"signals AS ({SIGNAL_UNION})")
    + _latest("*", "signals", "symbol", "signal_time DESC, signal_type", 50),
)
def k1_signals(spark, sf):
    rows = signals.signal_table(v.stored_hour_bars(spark, sf), v.FRAME_US)
    return serving.latest_n(rows, ["symbol"], 50, "signal_time", ["signal_type"])


@query(
    "k1_latest_news_impact",
    W(v.TICKS, v.NEWS, v.IMPACT)
    + _latest("symbol, id, news_time, price_before, price_after, n_candles", "impact", "symbol",
              "news_time DESC, id", 20),
)
def k1_impact(spark, sf):
    rows = news.news_impact(v.news(spark, sf), v.prices(spark, sf), seq="seq")
    out = serving.latest_n(rows, ["symbol"], 20, "news_time", ["id"])
    return out.select("symbol", "id", "news_time", "price_before", "price_after", "n_candles")


@query("k2_first_news", W(v.TICKS, v.NEWS) + _latest("symbol, id, title, link", "news", "symbol", "id", 5))
def k2(spark, sf):
    rows = v.news(spark, sf).select("symbol", "id", "title", "link")
    return serving.first_n(rows, ["symbol"], [F.col("id")], 5)


@query(
    "k3_encoder_window",
    W(v.TICKS, v.BARS_1M)
    + f"SELECT {BAR} FROM bars_1m WHERE symbol = 'S3' ORDER BY time DESC LIMIT 120",
)
def k3(spark, sf):
    return serving.latest_of(v.minute_bars(spark, sf), F.col("symbol") == "S3", 120)


@query("k4_last_300", W(v.TICKS, v.LADDER) + _latest(BAR, "ladder", "screener, symbol", "time DESC", 300))
def k4(spark, sf):
    return serving.latest_n(ladder(spark, sf), ["screener", "symbol"], 300)


@query(
    "k5_edge_times",
    W(v.TICKS, v.LADDER)
    + """SELECT screener, symbol, min(time) AS first_time, max(time) AS last_time
FROM ladder GROUP BY screener, symbol""",
)
def k5(spark, sf):
    return serving.edge_times(ladder(spark, sf), ["screener", "symbol"])


@query(
    "k6_top_market_cap",
    W(USER_TICKS, USER_SHARES, CAPS)
    + """SELECT symbol, round(market_cap, 8) + 0e0 AS market_cap
FROM (SELECT symbol, arg_max(market_cap, time) AS market_cap FROM caps GROUP BY symbol)
ORDER BY market_cap DESC, symbol LIMIT 10""",
)
def k6(spark, sf):
    last = last_caps(spark, sf)
    return v.rounded(research.top_symbols(last, "market_cap", 10), "market_cap", digits=8)


@query(
    "k7_worst_forecasts",
    W(v.TICKS, v.BARS_1H, NAIVE)
    + """SELECT symbol, date_trunc('day', time) AS day,
  round(avg(2 * abs(close - close_predict) / (abs(close) + abs(close_predict) + 1e-8)), 6) + 0e0 AS smape
FROM scored GROUP BY symbol, date_trunc('day', time) ORDER BY smape DESC, symbol, day LIMIT 10""",
)
def k7(spark, sf):
    scored = naive(spark, sf).withColumn("day", F.date_trunc("day", "time").cast("timestamp_ntz"))
    errors = v.rounded(forecast.forecast_errors(scored, ["symbol", "day"]), "smape")
    return errors.orderBy(F.desc("smape"), "symbol", "day").limit(10).select("symbol", "day", "smape")


@query("k8_sorted", W(v.TICKS) + "SELECT symbol, time, close FROM ticks ORDER BY time DESC")
def k8(spark, sf):
    return v.ticks(spark, sf).select("symbol", "time", "close").orderBy(F.col("time").desc())


@query(
    "k9_last_row",
    W(v.TICKS, v.LADDER) + _latest(BAR, "ladder", "screener, symbol", "time DESC", 1),
)
def k9(spark, sf):
    return serving.last_row(ladder(spark, sf), ["screener", "symbol"])


PREDICTIONS = """stored AS (
  SELECT symbol, time, unnest(range(1, 4)) AS step, close FROM bars_1h),
predictions AS (
  SELECT symbol, '60m' AS screener, time, time + step * INTERVAL 60 MINUTE AS time_step,
         close + step AS close_predict FROM stored)"""


def predictions(spark, sf):
    """Three-step forecasts at every hourly bar."""
    steps = F.array(*[F.col("close") + F.lit(float(i)) for i in (1, 2, 3)])
    return forecast.explode_predictions(
        v.hour_bars(spark, sf).select(
            "symbol",
            F.col("time").alias("base_time"),
            F.lit(60).alias("interval"),
            steps.alias("predictions"),
        )
    )


@query(
    "k10_predictions_of_symbol",
    W(v.TICKS, v.BARS_1H, PREDICTIONS)
    + "SELECT time, time_step, close_predict, screener FROM predictions WHERE symbol = 'S3'",
)
def k10(spark, sf):
    return serving.predictions_of(predictions(spark, sf), "S3")


@query(
    "k11_symbol_sample",
    W(USER_TICKS)
    + "SELECT symbol FROM (SELECT DISTINCT symbol FROM user_ticks) ORDER BY md5('7|' || symbol) LIMIT 18",
)
def k11(spark, sf):
    from tickloom.plans.aggregates import user_ticks

    return serving.sample_symbols(user_ticks(spark, sf), 18, seed=7)
