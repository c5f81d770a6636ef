"""Sources and keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.functions.times import event_time
from tickloom.operators import candles, indicators
from tickloom.plans import views as v
from tickloom.plans.aggregates import BAR, _RIGHT
from tickloom.plans.projections import BOOK_SQL, book_messages
from tickloom.plans.registry import query
from tickloom.schemas import OHLC_RECORD, TABLES
from tickloom.session import fresh_path
from tickloom.sources import records, tables

W = v.with_


def ohlc_messages(spark, sf):
    """Ticks as JSON messages of the price topic."""
    t = v.ticks(spark, sf)
    rows = t.select(
        F.lit("1m").alias("screener"), "symbol", "open", "high", "low", "close", "volume",
        F.col("time").cast("string").alias("time"), "event_type", "seq",
    )
    value = F.to_json(F.struct("screener", "symbol", "open", "high", "low", "close", "volume", "time"))
    return rows.select("seq", "event_type", value.alias("value"))


TICK_COLUMNS = "seq, '1m' AS screener, symbol, open, high, low, close, volume, time"


@query("s1_ohlc_source", W(v.TICKS) + f"SELECT {TICK_COLUMNS} FROM ticks")
def s1(spark, sf):
    return records.ohlc_records(ohlc_messages(spark, sf)).drop("event_type")


@query(
    "s2_news_source",
    """SELECT 'S' || CAST(user_id % 10 AS VARCHAR) AS symbol, CAST(event_id AS VARCHAR) AS id,
  event_type AS news_title, ts AS event_time, value AS close_price
FROM events WHERE event_type <> 'error'""",
)
def s2(spark, sf):
    e = v.table(spark, sf, "events")
    date = F.when(F.col("event_type") == "error", "unknown").otherwise(F.col("ts").cast("string"))
    rows = e.select(
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"),
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("news_title"),
        date.alias("public_date"),
        F.col("value").alias("close_price"),
    )
    return records.news_records(records.encode(rows)).select(
        "symbol", "id", "news_title", "event_time", "close_price"
    )


@query("s3_candle_reread", W(v.TICKS, v.LADDER) + f"SELECT {BAR} FROM ladder")
def s3(spark, sf):
    rungs = candles.candle_ladder(v.ticks(spark, sf), seq="seq")
    rungs = rungs.withColumn("time", F.col("time").cast("string"))
    return records.candle_records(records.encode(rungs, ["screener", "symbol", "time"]).drop("key"))


@query("s4_origin_column", "SELECT 'events.parquet' AS origin, count(*) AS n FROM events")
def s4(spark, sf):
    rows = records.with_origin(v.table(spark, sf, "events"))
    name = F.regexp_extract("topic_partition", r"(events\.parquet)", 1)
    return rows.groupBy(name.alias("origin")).agg(F.count(F.lit(1)).alias("n"))


def logged_ticks(spark, sf):
    """Ticks as a keyed topic of three partitions in the connector's columns; views are
    tombstones."""
    t = v.ticks(spark, sf).withColumn("screener", F.lit("1m")).withColumn("time", F.col("time").cast("string"))
    value = F.to_json(F.struct("screener", "symbol", "open", "high", "low", "close", "volume", "time"))
    return t.select(
        F.to_json(F.struct("screener", "symbol", "time")).cast("binary").alias("key"),
        F.when(F.col("event_type") != "view", value).cast("binary").alias("value"),
        F.lit("ohvcl_data").alias("topic"),
        F.pmod("seq", F.lit(3)).cast("int").alias("partition"),
        F.floor(F.col("seq") / 3).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def log_rows(spark, sf):
    return records.keyed_log(logged_ticks(spark, sf), OHLC_RECORD, ("screener", "symbol", "time"))


@query(
    "s4_log_positions",
    W(v.TICKS) + """SELECT CAST(seq % 3 AS INTEGER) AS topic_partition, seq // 3 AS "offset", symbol, time,
  event_type = 'view' AS deleted, CASE WHEN event_type <> 'view' THEN close END AS close FROM ticks""",
)
def s4_positions(spark, sf):
    """Partition and offset of every record, tombstones among them."""
    rows = log_rows(spark, sf).withColumn("time", event_time("time"))
    return rows.select("topic_partition", "offset", "symbol", "time", "deleted", "close")


@query(
    "s4_log_bars",
    W(v.TICKS,
      """kept AS (SELECT * FROM (SELECT * FROM ticks
  QUALIFY row_number() OVER (PARTITION BY symbol, time ORDER BY seq DESC) = 1) WHERE event_type <> 'view')""",
      v.sql_bars("bars_1h", "1H", 60, "kept"))
    + f"SELECT {BAR} FROM bars_1h",
)
def s4_bars(spark, sf):
    """Hour bars of what the topic leaves: a tombstone takes its record with it, and
    offsets decide the order."""
    rows = tables.current_of_log(log_rows(spark, sf), ("screener", "symbol", "time"))
    bars = candles.rollup(rows.withColumn("time", event_time("time")), times.HOUR_US, seq="seq")
    return bars.withColumn("screener", F.lit("1H"))


@query(
    "s5_malformed_records",
    W(v.TICKS) + f"SELECT {TICK_COLUMNS} FROM ticks WHERE event_type <> 'click'",
)
def s5(spark, sf):
    cut = F.when(F.col("event_type") == "click", F.substring("value", 1, 25)).otherwise(F.col("value"))
    broken = ohlc_messages(spark, sf).withColumn("value", cut)
    return records.ohlc_records(broken).drop("event_type")


@query(
    "s6_order_book_source",
    f"SELECT symbol, handle_time, buy_1, buy_3_volume, sell_2, room_foreign FROM ({BOOK_SQL})",
)
def s6(spark, sf):
    book = records.order_book_records(
        book_messages(spark, sf), ["Buy.Buy_1", "Buy.Buy_3_volume", "Sell.Sell_2", "Room_foreign"]
    )
    return book.select(
        "symbol",
        "handle_time",
        F.col("Buy.Buy_1").alias("buy_1"),
        F.col("Buy.Buy_3_volume").alias("buy_3_volume"),
        F.col("Sell.Sell_2").alias("sell_2"),
        F.col("Room_foreign").alias("room_foreign"),
    )


@query(
    "s7_prediction_source",
    W(v.TICKS)
    + """SELECT symbol, time AS base_time, 10 AS n, close AS first_step, close + 9 AS last_step,
  CAST(5 AS INTEGER) AS "interval" FROM ticks""".replace("10 AS n", "CAST(10 AS BIGINT) AS n"),
)
def s7(spark, sf):
    steps = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.col("close") + i)
    messages = records.encode(
        v.ticks(spark, sf).select(
            "symbol",
            F.col("time").cast("string").alias("base_time"),
            steps.alias("predictions"),
            F.lit("drift").alias("model"),
            F.lit(5).alias("interval"),
        )
    )
    p = records.prediction_records(messages)
    return p.select(
        "symbol",
        "base_time",
        F.size("predictions").cast("long").alias("n"),
        F.element_at("predictions", 1).alias("first_step"),
        F.element_at("predictions", -1).alias("last_step"),
        "interval",
    )


@query("s8_history", W(v.TICKS) + "SELECT symbol, time, open, high, low, close, volume FROM ticks")
def s8(spark, sf):
    raw = v.ticks(spark, sf).select(
        "symbol",
        F.col("time").alias("Datetime"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").cast("long").alias("Volume"),
    )
    return records.normalise_history(raw)


@query(
    "s9_fundamentals",
    """SELECT 'U' || CAST(c_custkey AS VARCHAR) AS symbol, c_custkey AS shares,
  c_custkey * 10 AS charter_capital, c_mktsegment AS sector FROM customer""",
)
def s9(spark, sf):
    facts = F.struct(
        F.array("c_mktsegment", "c_name").alias("Loai_cty"),
        F.col("c_custkey").alias("Tong_co_phieu"),
        (F.col("c_custkey") * 10).alias("Von_dieu_le"),
    )
    symbol = F.concat(F.lit("U"), F.col("c_custkey").cast("string"))
    raw = v.table(spark, sf, "customer").select(F.to_json(F.create_map(symbol, facts)).alias("value"))
    out = records.fundamentals(raw)
    return out.withColumn("sector", F.element_at("sectors", 1)).drop("sectors")


# ---- keyed tables ----------------------------------------------------------


def stored_ladder(spark, sf) -> str:
    root = fresh_path(spark, "tables")
    rungs = candles.candle_ladder(v.ticks(spark, sf), seq="seq")
    tables.write_batch(rungs, root, TABLES["ohlvc"], 0)
    return root


@query(
    "s10_scan_by_key",
    W(v.TICKS, v.LADDER) + f"SELECT {BAR} FROM ladder WHERE screener = '5m' AND symbol = 'S3'",
)
def s10(spark, sf):
    root = stored_ladder(spark, sf)
    return tables.read_key(spark, root, TABLES["ohlvc"], screener="5m", symbol="S3")


@query(
    "s10_scan_by_group",
    W(v.TICKS, v.LADDER) + f"SELECT {BAR} FROM ladder WHERE symbol = 'S3'",
)
def s10_group(spark, sf):
    """All rungs of one symbol, out of a backfill placed by symbol groups and a later
    batch in one group."""
    root = fresh_path(spark, "tables")
    rungs = candles.candle_ladder(v.ticks(spark, sf), seq="seq")
    tables.bulk_write(rungs.withColumn("close", F.lit(0.0)), root, TABLES["ohlvc"])
    tables.write_batch(rungs.filter(F.col("symbol") == "S3"), root, TABLES["ohlvc"], 0, writer="live")
    return tables.read_key(spark, root, TABLES["ohlvc"], symbol="S3")


@query(
    "s13_last_write_wins",
    W(v.TICKS, v.LADDER)
    + """SELECT screener, symbol, time, open, high, low,
  CASE WHEN symbol = 'S3' THEN close + 1 ELSE close END AS close, volume FROM ladder""",
)
def s13(spark, sf):
    root = stored_ladder(spark, sf)
    stored = tables.read_table(spark, root, TABLES["ohlvc"])
    revised = stored.filter(F.col("symbol") == "S3").withColumn("close", F.col("close") + 1)
    # The first attempt of batch 1 is replaced by its retry.
    tables.write_batch(revised.withColumn("close", F.lit(0.0)), root, TABLES["ohlvc"], 1)
    retry = candles.candle_ladder(v.ticks(spark, sf), seq="seq").filter(F.col("symbol") == "S3")
    tables.write_batch(retry.withColumn("close", F.col("close") + 1), root, TABLES["ohlvc"], 1)
    return tables.read_table(spark, root, TABLES["ohlvc"])


_MEASURES = "sma20 ema12 ema26 macd rsi14 bb_mid bb_upper bb_lower vwap ret"


@query(
    "s13_indicator_table",
    W(v.TICKS, v.BARS_1H, v.sql_range("bars_1h"), v.sql_recursive("ind"))
    + f"SELECT screener, symbol, time, close, {v.sql_rounded(_MEASURES, 8)} FROM rec",
)
def s13_indicators(spark, sf):
    """The indicator table, written first without a column and then whole, by two
    writers; every key is read once."""
    root = fresh_path(spark, "tables")
    bars = indicators.indicator_table(v.stored_hour_bars(spark, sf), v.FRAME_US)
    for writer, rows in (("backfill", bars.drop("vwap")), ("live", bars)):
        tables.write_batch(rows, root, TABLES["indicators"], 0, writer=writer)
    stored = tables.read_table(spark, root, TABLES["indicators"])
    return v.rounded(stored, *_MEASURES.split(), digits=8)


@query(
    "s14_tombstones",
    W(v.TICKS) + f"SELECT {TICK_COLUMNS} FROM ticks WHERE event_type <> 'view'",
)
def s14(spark, sf):
    value = F.when(F.col("event_type") != "view", F.col("value"))
    return records.ohlc_records(ohlc_messages(spark, sf).withColumn("value", value)).drop("event_type")


@query(
    "s16_bulk_write",
    W(v.TICKS, _RIGHT)
    + " UNION ALL ".join(f"SELECT {BAR} FROM h_{n}" for n in v.RUNGS),
)
def s16(spark, sf):
    root = fresh_path(spark, "tables")
    tables.bulk_write(candles.history_ladder(v.ticks(spark, sf), seq="seq"), root, TABLES["ohlvc"])
    return tables.read_table(spark, root, TABLES["ohlvc"])
