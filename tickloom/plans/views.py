"""The given tables seen as market data, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tickloom.functions.times import HOUR_US, MINUTE_US
from tickloom.operators import candles
from tickloom.session import stored, wall_clock

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Frame for hourly bars: the given events are sparse, so frames of 20 minutes
# would hold a single bar.
FRAME_US = 20 * HOUR_US


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return wall_clock(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def as_ticks(events: DataFrame) -> DataFrame:
    price = [F.col("value").alias(c) for c in ("open", "high", "low", "close")]
    return events.select(
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"),
        F.col("ts").alias("time"),
        *price,
        F.get_json_object("props", "$.k").try_cast("double").alias("volume"),
        F.col("event_id").alias("seq"),
        "event_type",
    )


def ticks(spark, sf_dir) -> DataFrame:
    return as_ticks(table(spark, sf_dir, "events"))


def minute_bars(spark, sf_dir) -> DataFrame:
    bars = candles.rollup(ticks(spark, sf_dir), MINUTE_US, seq="seq")
    return bars.withColumn("screener", F.lit("1m"))


def hour_bars(spark, sf_dir) -> DataFrame:
    bars = candles.rollup(ticks(spark, sf_dir), HOUR_US, seq="seq")
    return bars.withColumn("screener", F.lit("1H"))


def stored_hour_bars(spark, sf_dir) -> DataFrame:
    """Hour bars as a stored table, for operators that read their input twice."""
    return stored(hour_bars(spark, sf_dir), "hour-bars")


def day_bars(spark, sf_dir) -> DataFrame:
    return candles.daily(ticks(spark, sf_dir), seq="seq")


def as_news(ticks_: DataFrame) -> DataFrame:
    return ticks_.filter(F.col("event_type") == "signup").select(
        "symbol",
        F.col("seq").cast("string").alias("id"),
        F.col("time").alias("event_time"),
        F.concat(F.lit("news "), F.col("seq").cast("string")).alias("title"),
        F.concat(F.lit("/"), F.lower("symbol")).alias("link"),
    )


def news(spark, sf_dir) -> DataFrame:
    return as_news(ticks(spark, sf_dir))


def as_prices(ticks_: DataFrame) -> DataFrame:
    return ticks_.filter(F.col("event_type") != "signup")


def prices(spark, sf_dir) -> DataFrame:
    return as_prices(ticks(spark, sf_dir))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Averages depend on summation order in the last bits."""
    return df.withColumns({c: r(F.col(c), digits) for c in columns})


# Means of prices end in a tie at some decimal again and again, and the last bits
# then decide. Both sides add this odd amount before they round.
OFF_TIES = 3.1830989e-7


def off_ties(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r(F.col(c) + OFF_TIES) for c in columns})


def r(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits) + F.lit(0.0)


# ---- the same views in SQL -------------------------------------------------

TICKS = """ticks AS (
  SELECT 'S' || CAST(user_id % 10 AS VARCHAR) AS symbol, ts AS time,
         value AS open, value AS high, value AS low, value AS close,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         event_id AS seq, event_type
  FROM events)"""


def sql_bars(name: str, screener: str, minutes: int, source: str = "ticks",
             label: str = "window_time") -> str:
    shift = {
        "window_time": f" + INTERVAL {minutes} MINUTE - INTERVAL 1 MILLISECOND",
        "start": "",
        "end": f" + INTERVAL {minutes} MINUTE",
    }[label]
    return f"""{name} AS (
  SELECT '{screener}' AS screener, symbol,
         time_bucket(INTERVAL {minutes} MINUTE, time){shift} AS time,
         arg_min(open, time) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, time) AS close, sum(volume) AS volume
  FROM {source} GROUP BY symbol, time_bucket(INTERVAL {minutes} MINUTE, time))"""


def sql_right_bars(name: str, screener: str, minutes: int) -> str:
    us = minutes * MINUTE_US
    edge = f"make_timestamp(CAST(((epoch_us(time) + {us} - 1) // {us}) * {us} AS BIGINT))"
    return f"""{name} AS (
  SELECT '{screener}' AS screener, symbol, {edge} AS time,
         arg_min(open, time) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, time) AS close, sum(volume) AS volume
  FROM ticks GROUP BY symbol, {edge})"""


BARS_1M = sql_bars("bars_1m", "1m", 1)
BARS_1H = sql_bars("bars_1h", "1H", 60)
DAYS = sql_bars("days", "1D", 24 * 60, label="start")
RUNGS = {"1m": 1, "5m": 5, "15m": 15, "30m": 30, "1H": 60}
LADDER = (
    ",\n".join(sql_bars(f"rung_{n}", n, m) for n, m in RUNGS.items())
    + ",\nladder AS ("
    + " UNION ALL ".join(f"SELECT * FROM rung_{n}" for n in RUNGS)
    + ")"
)
NEWS = """news AS (
  SELECT symbol, CAST(seq AS VARCHAR) AS id, time AS event_time,
         'news ' || CAST(seq AS VARCHAR) AS title, '/' || lower(symbol) AS link
  FROM ticks WHERE event_type = 'signup'),
prices AS (SELECT * FROM ticks WHERE event_type <> 'signup')"""
IMPACT = """impact AS (
  SELECT n.symbol, n.id, n.event_time AS news_time, n.title, n.link,
         arg_min(p.close, p.time) AS price_before, arg_max(p.close, p.time) AS price_after,
         max(p.high) AS max_price, min(p.low) AS min_price, count(*) AS n_candles,
         CASE WHEN arg_min(p.close, p.time) > 0
              THEN (arg_max(p.close, p.time) - arg_min(p.close, p.time))
                   / arg_min(p.close, p.time) * 100 END AS impact_pct
  FROM news n JOIN prices p ON n.symbol = p.symbol
   AND p.time BETWEEN n.event_time AND n.event_time + INTERVAL 15 MINUTE
  GROUP BY n.symbol, n.id, n.event_time, n.title, n.link)"""


def sql_range(source: str, frame: str = "20 HOUR", name: str = "ind") -> str:
    return f"""{name} AS (
  SELECT *, avg(close) OVER w AS sma20, avg(close) OVER w AS bb_mid,
         avg(close) OVER w + 2 * stddev_pop(close) OVER w AS bb_upper,
         avg(close) OVER w - 2 * stddev_pop(close) OVER w AS bb_lower,
         CASE WHEN sum(volume) OVER w > 0
              THEN sum(close * volume) OVER w / sum(volume) OVER w END AS vwap,
         avg(volume) OVER w AS avg_volume
  FROM {source}
  WINDOW w AS (PARTITION BY symbol ORDER BY time
               RANGE BETWEEN INTERVAL {frame} PRECEDING AND CURRENT ROW))"""


def sql_ema(values: str, span: int) -> str:
    a, q = f"(2e0/{span + 1})", f"(1e0-2e0/{span + 1})"
    return f"list_reduce({values}, lambda acc, x: {a} * x + {q} * acc)"


def sql_rsi(values: str, period: int = 14) -> str:
    def wilder(sign: str) -> str:
        step = f"greatest({sign}({values}[i] - {values}[i-1]), 0e0)"
        steps = f"list_transform(range(2, len({values}) + 1), lambda i: {step})"
        seed = f"[list_sum(({steps})[1:{period}]) / {period}e0]"
        return (
            f"list_reduce(list_concat({seed}, ({steps})[{period + 1}:]), "
            f"lambda acc, x: (acc * {period - 1} + x) / {period}e0)"
        )

    up, down = wilder(""), wilder("-")
    return (
        f"CASE WHEN len({values}) <= {period} THEN NULL WHEN {down} = 0 THEN 100e0 "
        f"ELSE 100e0 - 100e0 / (1e0 + {up} / {down}) END"
    )


def sql_recursive(source: str, name: str = "rec") -> str:
    return f"""framed AS (
  SELECT *, list(close) OVER (PARTITION BY symbol ORDER BY time
                              ROWS BETWEEN 299 PRECEDING AND CURRENT ROW) AS l,
         close - lag(close) OVER (PARTITION BY symbol ORDER BY time) AS ret
  FROM {source}),
{name} AS (
  SELECT * EXCLUDE (l), {sql_ema("l", 12)} AS ema12, {sql_ema("l", 26)} AS ema26,
         {sql_ema("l", 12)} - {sql_ema("l", 26)} AS macd, {sql_rsi("l")} AS rsi14
  FROM framed)"""


def sql_trend(source: str, up: bool = True, name: str = "trend", length: int = 3) -> str:
    sign, kind, side, text = (
        (">", "TREND_3UP", "BUY", "close tang 3+ nen lien tiep")
        if up
        else ("<", "TREND_3DOWN", "SELL", "close giam 3+ nen lien tiep")
    )
    return f"""{name}_steps AS (
  SELECT *, CASE WHEN close {sign} lag(close) OVER (PARTITION BY symbol ORDER BY time)
                 THEN 0 ELSE 1 END AS starts FROM {source}),
{name}_runs AS (
  SELECT *, sum(starts) OVER (PARTITION BY symbol ORDER BY time) AS run FROM {name}_steps),
{name}_places AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, run ORDER BY time) AS place
  FROM {name}_runs),
{name} AS (
  SELECT symbol, date_trunc('millisecond', time) AS signal_time, '{kind}' AS signal_type,
         '{side}' AS side, close AS price, '{text}' AS detail
  FROM {name}_places WHERE place % {length} = 0)"""


def sql_half_up(expr: str) -> str:
    """Two decimals, half up on the shortest decimal form of the double."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE)"


SPIKE_DETAIL = (
    f"'volume gap ' || CAST({sql_half_up('volume / nullif(avg_volume, 0)')} AS VARCHAR) || 'x'"
)

SPIKES = """spikes AS (
  SELECT symbol, date_trunc('millisecond', time) AS signal_time,
         'VOLUME_SPIKE' AS signal_type, 'WATCH' AS side, close AS price,
         {detail} AS detail
  FROM ind WHERE avg_volume IS NOT NULL AND volume > 3 * avg_volume)""".format(
    detail=SPIKE_DETAIL
)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def sql_off_ties(columns: str) -> str:
    return ", ".join(f"round({c} + {OFF_TIES}, 6) + 0e0 AS {c}" for c in columns.split())


def sql_rounded(columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) + 0e0 AS {c}" for c in columns.split())


