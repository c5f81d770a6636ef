"""Streaming jobs over the events table, run to the end of the input.

A window that is still open when a bounded stream ends is never emitted, so the
SQL keeps the windows that close by the last watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.operators.candles import OHLCV, arrival_order
from tickloom.plans import views as v
from tickloom.plans.registry import query
from tickloom.schemas import TABLES
from tickloom.session import fresh_path, streaming_session
from tickloom.sources import records, tables
from tickloom.streaming import flows, live, state
from tickloom.streaming.handover import bar_history, handover, open_bars

W = v.with_

# The last watermark: ten seconds behind the newest record, at millisecond grain.
CLOSED = """last AS (
  SELECT date_trunc('millisecond', max(time)) - INTERVAL 10 SECOND AS mark FROM ticks)"""


def tick_stream(s: SparkSession, sf_dir: str) -> DataFrame:
    events = records.table_stream(s, sf_dir, v.EVENTS_SCHEMA, "events.parquet")
    return v.as_ticks(events)


def price_stream(s: SparkSession, sf_dir: str) -> DataFrame:
    return flows.timed(tick_stream(s, sf_dir), "time", flows.PRICE_DELAY)


def run(writer) -> None:
    """Works off all available input, then stops."""
    writer.trigger(availableNow=True).start().awaitTermination()


def halves(rows: DataFrame, twentieths: int = 10) -> list[DataFrame]:
    """The rows before and from the middle of their time span, which lies inside a
    window of any length; or from another part of the span."""
    low, high = rows.agg(F.min("time"), F.max("time")).first()
    if low is None:
        return [rows]
    middle = F.lit(low + (high - low) * twentieths / 20)
    return [rows.filter(F.col("time") < middle), rows.filter(F.col("time") >= middle)]


def appended(
    spark: SparkSession, sf_dir: str, build: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """Runs a stream into an append sink and reads the result."""
    s = streaming_session(spark)
    out = build(s, sf_dir)
    path = fresh_path(s, "stream")
    run(tables.append_query(out, f"{path}/data", f"{path}/checkpoint"))
    return v.wall_clock(spark).read.schema(out.schema).parquet(f"{path}/data")


BAR = "symbol, time, open, high, low, close, volume"
CLOSED_1M = "closed AS (SELECT b.* FROM bars_1m b, last WHERE b.time + INTERVAL 1 MILLISECOND <= mark)"


@query("x1_watermark", W(v.TICKS, CLOSED, v.BARS_1M, CLOSED_1M) + f"SELECT {BAR} FROM closed")
def x1(spark, sf):
    return appended(
        spark, sf, lambda s, d: flows.settle(flows.minute_bars(price_stream(s, d), "seq"))
    )


_RUNG_SQL = " UNION ALL ".join(
    f"SELECT '{m}m' AS screener, symbol, time_bucket(INTERVAL {m} MINUTE, time) AS start, "
    f"arg_min(open, time) AS open, max(high) AS high, min(low) AS low, "
    f"arg_max(close, time) AS close, sum(volume) AS volume FROM ticks GROUP BY ALL"
    for m in (1, 5, 15, 30, 60)
)


@query(
    "x2_tumbling_windows",
    W(v.TICKS, CLOSED, f"rungs AS ({_RUNG_SQL})")
    + """SELECT screener, symbol, start AS time, open, high, low, close, volume FROM rungs, last
WHERE start + CAST(replace(screener, 'm', '') AS INTEGER) * INTERVAL 1 MINUTE <= mark""",
)
def x2(spark, sf):
    def build(s, d):
        prices = price_stream(s, d)
        parts = []
        for m in (1, 5, 15, 30, 60):
            window = F.window("time", f"{m} minutes")
            bars = prices.groupBy("symbol", window.alias("window")).agg(
                *flows.bar_columns(arrival_order("time", "seq"))
            )
            parts.append(
                bars.select(
                    F.lit(f"{m}m").alias("screener"),
                    "symbol",
                    F.col("window.start").cast("timestamp_ntz").alias("time"),
                    *OHLCV,
                )
            )
        return flows.union_all(parts)

    return appended(spark, sf, build)


@query(
    "x3_cascaded_windows",
    W(v.TICKS, CLOSED, v.LADDER)
    + f"SELECT screener, {BAR} FROM ladder, last WHERE time + INTERVAL 1 MILLISECOND <= mark",
)
def x3(spark, sf):
    return appended(spark, sf, lambda s, d: flows.candle_ladder(price_stream(s, d), seq="seq"))


@query(
    "x3_ladder_over_stored_bars",
    W(v.TICKS, CLOSED, v.BARS_1M, CLOSED_1M,
      ", ".join(v.sql_bars(f"r_{n}", n, m, "closed") for n, m in v.RUNGS.items() if m > 1),
      "mark2 AS (SELECT max(time) - INTERVAL 5 SECOND AS mark FROM closed)")
    + " UNION ALL ".join(
        f"SELECT screener, {BAR} FROM r_{n}, mark2 WHERE time + INTERVAL 1 MILLISECOND <= mark2.mark"
        for n, m in v.RUNGS.items() if m > 1
    ),
)
def x3_stored(spark, sf):
    """Two jobs: records to stored minute bars, stored bars to longer rungs."""
    s = streaming_session(spark)
    root = fresh_path(s, "cascade")
    bars = flows.settle(flows.minute_bars(price_stream(s, sf), "seq"))
    run(tables.append_query(bars, f"{root}/bars", f"{root}/checkpoint-bars"))
    stored = flows.timed(records.table_stream(s, f"{root}/bars", bars.schema), "time", flows.CANDLE_DELAY)
    rungs = flows.stored_ladder(stored)
    run(tables.append_query(rungs, f"{root}/rungs", f"{root}/checkpoint-rungs"))
    return v.wall_clock(spark).read.schema(rungs.schema).parquet(f"{root}/rungs")


@query("x4_repeats_dropped", W(v.TICKS) + "SELECT symbol, time, close, seq FROM ticks")
def x4(spark, sf):
    def build(s, d):
        one = tick_stream(s, d)
        twice = flows.timed(one.unionByName(one), "time", flows.PRICE_DELAY)
        kept = flows.without_repeats(twice, "symbol", "seq").select("symbol", "time", "close", "seq")
        return kept.withColumn("time", F.col("time").cast("timestamp_ntz"))

    return appended(spark, sf, build)


# The given events are sparse: a frame of 20 minutes would mostly hold one bar.
FRAME_MINUTES = 1200


def stream_indicators(s, d):
    bars = state.indicators(flows.minute_bars(price_stream(s, d), "seq"), FRAME_MINUTES)
    return flows.settle(bars)


CLOSED_IND = (v.TICKS, CLOSED, v.BARS_1M, CLOSED_1M)


@query(
    "x5_rolling_range",
    W(*CLOSED_IND, v.sql_range("closed"))
    + f"SELECT symbol, time, close, {v.sql_off_ties('sma20 bb_upper bb_lower vwap')} FROM ind",
)
def x5(spark, sf):
    out = appended(spark, sf, stream_indicators)
    columns = ("sma20", "bb_upper", "bb_lower", "vwap")
    return v.off_ties(out.select("symbol", "time", "close", *columns), *columns)


SIGNALS_SQL = W(
    *CLOSED_IND, v.sql_range("closed"), v.SPIKES,
    v.sql_trend("closed", True, "ups"), v.sql_trend("closed", False, "downs"),
) + "SELECT * FROM ups UNION ALL SELECT * FROM downs UNION ALL SELECT * FROM spikes"


@query(
    "x6_patterns",
    SIGNALS_SQL,
)
def x6(spark, sf):
    def build(s, d):
        out = state.signals(flows.minute_bars(price_stream(s, d), "seq"), FRAME_MINUTES)
        return flows.settle(out, time="signal_time")

    return appended(spark, sf, build)


@query(
    "x7_recursive_indicators",
    W(*CLOSED_IND, v.sql_recursive("closed"))
    + f"SELECT symbol, time, {v.sql_rounded('ema12 ema26 macd rsi14 ret')} FROM rec",
)
def x7(spark, sf):
    out = appended(spark, sf, stream_indicators)
    columns = ("ema12", "ema26", "macd", "rsi14", "ret")
    return v.rounded(out.select("symbol", "time", *columns), *columns)


def timed_news(s, d):
    rows = v.as_news(tick_stream(s, d))
    return flows.timed(rows, "event_time", flows.NEWS_DELAY)


X8_SQL = (
    W(v.TICKS, v.NEWS, v.IMPACT)
    + """, mark AS (SELECT least(
  (SELECT date_trunc('millisecond', max(event_time)) - INTERVAL 5 SECOND FROM news),
  (SELECT date_trunc('millisecond', max(time)) - INTERVAL 10 SECOND FROM prices)) AS mark)
SELECT symbol, id, news_time, title, link, price_before, price_after, max_price, min_price,
  n_candles, round(impact_pct, 6) + 0e0 AS impact_pct
FROM impact, mark WHERE news_time + INTERVAL 15 MINUTE <= mark"""
)


@query("x8_news_impact", X8_SQL)
def x8(spark, sf):
    def build(s, d):
        prices = flows.timed(v.as_prices(tick_stream(s, d)), "time", flows.PRICE_DELAY)
        return flows.news_impact(timed_news(s, d), prices, seq="seq")

    return v.rounded(appended(spark, sf, build), "impact_pct")


@query("s11_append_sink", W(v.TICKS) + "SELECT symbol, time, close, volume FROM ticks")
def s11(spark, sf):
    return appended(
        spark, sf, lambda s, d: tick_stream(s, d).select("symbol", "time", "close", "volume")
    )


@query(
    "s12_upsert_sink",
    W(v.TICKS, v.BARS_1H) + f"SELECT screener, {BAR} FROM bars_1h",
)
def s12(spark, sf):
    """Hourly bars as updates, merged by key: the last update of a bar stands."""
    s = streaming_session(spark)
    bars = (
        price_stream(s, sf)
        .groupBy("symbol", F.window("time", "1 hour").alias("window"))
        .agg(*flows.bar_columns(arrival_order("time", "seq")))
        .select(F.lit("1H").alias("screener"), "symbol", F.window_time("window").alias("rt"), *OHLCV)
    )
    root = fresh_path(s, "upsert")
    run(tables.upsert_query(flows.settle(bars), root, "ohlvc", f"{root}/checkpoint", output_mode="update"))
    return tables.read_table(v.wall_clock(spark), root, TABLES["ohlvc"])


@query(
    "s15_fan_out",
    W(v.TICKS)
    + """SELECT 'rows' AS sink, symbol, count(*) AS n FROM ticks GROUP BY symbol
UNION ALL SELECT 'busy', symbol, count(*) FROM ticks WHERE volume > 50 GROUP BY symbol""",
)
def s15(spark, sf):
    """One scan feeds two sinks."""
    s = streaming_session(spark)
    root = fresh_path(s, "fan-out")
    rows = tick_stream(s, sf).select("symbol", "time", "volume", "seq")

    def to(name: str, keep):
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.filter(keep).write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")

        return write

    sinks = [to("rows", F.lit(True)), to("busy", F.col("volume") > 50)]
    run(tables.fan_out_query(rows, sinks, f"{root}/checkpoint"))
    counts = [
        spark.read.parquet(f"{root}/{name}")
        .groupBy(F.lit(name).alias("sink"), "symbol")
        .agg(F.count(F.lit(1)).alias("n"))
        for name in ("rows", "busy")
    ]
    return flows.union_all(counts)


@query(
    "x11_restart_from_checkpoint",
    W(v.TICKS, CLOSED, v.BARS_1M, CLOSED_1M) + f"SELECT {BAR} FROM closed",
)
def x11(spark, sf):
    """A job stopped in the middle of the input and started again on its checkpoint
    goes on with the windows that were open."""
    s = streaming_session(spark)
    path = fresh_path(s, "restart")
    rows = v.ticks(spark, sf)
    for part in halves(rows):
        part.write.mode("append").parquet(f"{path}/in")
        source = records.table_stream(s, f"{path}/in", rows.schema)
        bars = flows.settle(flows.minute_bars(flows.timed(source, "time", flows.PRICE_DELAY), "seq"))
        run(tables.append_query(bars, f"{path}/data", f"{path}/checkpoint"))
    return v.wall_clock(spark).read.schema(bars.schema).parquet(f"{path}/data")


def handed_over(spark, sf, first: Callable, second: Callable) -> DataFrame:
    """A job over the first half of the input, and one with three partitions more that
    goes on with its state over all that it left open."""
    s = streaming_session(spark)
    path = fresh_path(s, "handover")
    rows = v.ticks(spark, sf)
    old, outs = None, []
    for i, part in enumerate(halves(rows)):
        part.write.mode("append").parquet(f"{path}/in")
        source = records.table_stream(s, f"{path}/in", rows.schema)
        if old:
            more = int(s.conf.get("spark.sql.shuffle.partitions")) + 3
            s.conf.set("spark.sql.shuffle.partitions", str(more))
            source = old.still_open(source)
        prices = flows.timed(source, "time", flows.PRICE_DELAY)
        out = second(prices, s, old) if old else first(prices)
        run(tables.append_query(out, f"{path}/data-{i}", f"{path}/checkpoint-{i}"))
        outs.append(v.wall_clock(spark).read.schema(out.schema).parquet(f"{path}/data-{i}"))
        old = handover(s, f"{path}/checkpoint-{i}")
    return flows.union_all(outs)


@query(
    "x11_rescaled_ladder",
    W(v.TICKS, CLOSED, v.LADDER)
    + f"SELECT screener, {BAR} FROM ladder, last WHERE time + INTERVAL 1 MILLISECOND <= mark",
)
def x11_ladder(spark, sf):
    return handed_over(
        spark, sf,
        lambda prices: flows.candle_ladder(prices, seq="seq"),
        lambda prices, s, old: flows.candle_ladder(prices, seq="seq", initial=open_bars(s, old)),
    )


@query(
    "x11_rescaled_indicators",
    W(*CLOSED_IND, v.sql_recursive("closed"))
    + f"SELECT symbol, time, {v.sql_rounded('ema12 ema26 macd rsi14 ret')} FROM rec",
)
def x11_indicators(spark, sf):
    def build(prices, s=None, old=None):
        initial = bar_history(s, old) if old else None
        return flows.settle(state.indicators(flows.minute_bars(prices, "seq"), FRAME_MINUTES, initial))

    columns = ("ema12", "ema26", "macd", "rsi14", "ret")
    return v.rounded(handed_over(spark, sf, build, build).select("symbol", "time", *columns), *columns)


CLOSED_BARS = W(v.TICKS, CLOSED, v.BARS_1M, CLOSED_1M) + f"SELECT {BAR} FROM closed"


@query("x9_late_records", CLOSED_BARS)
def x9(spark, sf):
    """Every record arrives a second time, after its window has closed: the late
    copies change nothing."""
    s = streaming_session(spark)
    path = fresh_path(s, "late")
    rows = v.ticks(spark, sf)
    for _ in range(2):
        rows.write.mode("append").parquet(f"{path}/in")
        source = records.table_stream(s, f"{path}/in", rows.schema)
        bars = flows.settle(flows.minute_bars(flows.timed(source, "time", flows.PRICE_DELAY), "seq"))
        run(tables.append_query(bars, f"{path}/out", f"{path}/checkpoint"))
    return v.wall_clock(spark).read.schema(bars.schema).parquet(f"{path}/out")


@query("x10_idle_source", CLOSED_BARS)
def x10(spark, sf):
    """A second source that never has a record, but sends beats, does not hold
    windows open."""
    s = streaming_session(spark)
    silent = tick_stream(s, sf).filter(F.col("event_type") == "none")
    beats = tick_stream(s, sf).select("time")
    idle = flows.timed_with_beats(silent, "time", flows.NEWS_DELAY, beats)
    both = price_stream(s, sf).unionByName(idle)
    path = fresh_path(s, "idle")
    bars = flows.settle(flows.minute_bars(both, "seq"))
    run(tables.append_query(bars, f"{path}/out", f"{path}/checkpoint"))
    return v.wall_clock(spark).read.schema(bars.schema).parquet(f"{path}/out")


def run_past(writer, mark) -> None:
    """Runs by the clock until a batch has seen the watermark ``mark``, then stops."""
    job = writer.trigger(processingTime="1 second").start()
    want = mark.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z" if mark else ""
    try:
        while not job.awaitTermination(1):
            if any(p["eventTime"].get("watermark", "") >= want for p in job.recentProgress):
                break
    finally:
        job.stop()


@query("x10_silent_source", CLOSED_BARS)
def x10_silent(spark, sf):
    """A second source that sends nothing at all, no beats either, is passed by the
    clock after ten seconds."""
    s = streaming_session(spark)
    path = fresh_path(s, "silent")
    busy = tick_stream(s, sf)
    rows = v.ticks(spark, sf).select(*busy.columns)
    rows.limit(0).write.parquet(f"{path}/in")
    raw = {"busy": busy, "silent": records.table_stream(s, f"{path}/in", rows.schema)}
    delays = {"busy": flows.PRICE_DELAY, "silent": flows.NEWS_DELAY}
    timed = flows.timed_with_idle(raw, dict.fromkeys(raw, "time"), delays)
    bars = flows.settle(flows.minute_bars(timed["busy"].unionByName(timed["silent"]), "seq"))
    last = rows.agg((F.max("time") - F.expr(f"INTERVAL {flows.PRICE_DELAY}")).alias("mark")).first().mark
    run_past(tables.append_query(bars, f"{path}/out", f"{path}/checkpoint"), last)
    return v.wall_clock(spark).read.schema(bars.schema).parquet(f"{path}/out")


@query(
    "x10_slow_source",
    W(v.TICKS, """last AS (
  SELECT date_trunc('millisecond', least(max(time) FILTER (seq % 2 = 0), max(time) FILTER (seq % 2 = 1)))
         - INTERVAL 10 SECOND AS mark FROM ticks)""", v.BARS_1M, CLOSED_1M)
    + f"SELECT {BAR} FROM closed",
)
def x10_slow(spark, sf):
    """Two sources, one of which comes in four parts after the other is complete:
    the job waits for it and loses none of its records. The complete one sends a
    beat each time; a restarted job would else not know how far it had come."""
    s = streaming_session(spark)
    path = fresh_path(s, "slow")
    rows = v.ticks(spark, sf)
    slow = rows.filter(F.col("seq") % 2 == 1)
    first = rows.filter(F.col("seq") % 2 == 0)
    first.write.parquet(f"{path}/quick")
    for part in (quarter for half in halves(slow) for quarter in halves(half)):
        part.write.mode("append").parquet(f"{path}/slow")
        first.agg(F.max("time").alias("time")).write.mode("append").parquet(f"{path}/beats")
        beats = records.table_stream(s, f"{path}/beats", rows.select("time").schema)
        quick = flows.timed_with_beats(
            records.table_stream(s, f"{path}/quick", rows.schema), "time", flows.PRICE_DELAY, beats
        )
        late = flows.timed(records.table_stream(s, f"{path}/slow", rows.schema), "time", flows.PRICE_DELAY)
        bars = flows.settle(flows.minute_bars(quick.unionByName(late), "seq"))
        run(tables.append_query(bars, f"{path}/out", f"{path}/checkpoint"))
    return v.wall_clock(spark).read.schema(bars.schema).parquet(f"{path}/out")


@query(
    "x12_updates_merged",
    W(v.TICKS, v.sql_bars("bars_15m", "15m", 15)) + f"SELECT screener, {BAR} FROM bars_15m",
)
def x12(spark, sf):
    """Bars as a changelog over two batches that meet inside a window: the later
    version of a bar replaces the earlier one."""
    s = streaming_session(spark)
    path = fresh_path(s, "changes")
    rows = v.ticks(spark, sf)
    for part in halves(rows):
        part.write.mode("append").parquet(f"{path}/in")
        source = flows.timed(
            records.table_stream(s, f"{path}/in", rows.schema), "time", flows.PRICE_DELAY
        )
        bars = (
            source.groupBy("symbol", F.window("time", "15 minutes").alias("window"))
            .agg(*flows.bar_columns(arrival_order("time", "seq")))
            .select(F.lit("15m").alias("screener"), "symbol", F.window_time("window").alias("rt"), *OHLCV)
        )
        run(tables.upsert_query(flows.settle(bars), path, "ohlvc", f"{path}/checkpoint", output_mode="update"))
    return tables.read_table(v.wall_clock(spark), path, TABLES["ohlvc"])


def daily_updates(s: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Bars of a day as updates over the stream of a folder."""
    source = flows.timed(records.table_stream(s, path, rows.schema), "time", flows.PRICE_DELAY)
    bars = (
        source.groupBy("symbol", F.window("time", "1 day").alias("window"))
        .agg(*flows.bar_columns(arrival_order("time", "seq")))
        .select(F.lit("1D").alias("screener"), "symbol", F.window_time("window").alias("rt"), *OHLCV)
    )
    return flows.settle(bars)


def changed_bars(spark: SparkSession, sf: str) -> str:
    """Root of a table whose changes were kept over two batches that meet in a window."""
    s = streaming_session(spark)
    path = fresh_path(s, "changelog")
    rows = v.ticks(spark, sf)
    for part in halves(rows, 9):  # not at the edge of a day
        part.write.mode("append").parquet(f"{path}/in")
        run(tables.changelog_query(daily_updates(s, rows, f"{path}/in"), path, "ohlvc", f"{path}/checkpoint"))
    v.wall_clock(spark)
    return path


EARLY = """early AS (SELECT * FROM ticks WHERE time <
  (SELECT make_timestamp(epoch_us(min(time)) + (epoch_us(max(time)) - epoch_us(min(time))) * 9 // 20) FROM ticks))"""
_DIFFERS = "(o.open, o.high, o.low, o.close, o.volume) IS DISTINCT FROM (n.open, n.high, n.low, n.close, n.volume)"
_BARS_OF = {a: "screener, symbol, time, " + ", ".join(f"{a}.{c}" for c in OHLCV) for a in "on"}
_BOTH = "FROM old o JOIN new n USING (screener, symbol, time)"


@query(
    "x12_changelog",
    W(v.TICKS, EARLY, v.sql_bars("old", "1D", 1440, "early"), v.sql_bars("new", "1D", 1440))
    + f"""SELECT '+I' AS op, screener, {BAR} FROM old
UNION ALL SELECT '-U', {_BARS_OF['o']} {_BOTH} WHERE {_DIFFERS}
UNION ALL SELECT '+U', {_BARS_OF['n']} {_BOTH} WHERE {_DIFFERS}
UNION ALL SELECT '+I', screener, {BAR} FROM new n
  WHERE (screener, symbol, time) NOT IN (SELECT (screener, symbol, time) FROM old)""",
)
def x12_changelog(spark, sf):
    """Every insert of a bar and both sides of every update."""
    changes = tables.read_changes(spark, changed_bars(spark, sf), TABLES["ohlvc"])
    return changes.drop(tables.BATCH, tables.WRITER)


@query(
    "x12_changelog_folded",
    W(v.TICKS, v.sql_bars("bars_1d", "1D", 1440)) + f"SELECT screener, {BAR} FROM bars_1d",
)
def x12_folded(spark, sf):
    """The changes, folded, are the final bars."""
    changes = tables.read_changes(spark, changed_bars(spark, sf), TABLES["ohlvc"])
    return tables.fold_changes(changes, TABLES["ohlvc"].keys)


@query("x13_offsets_kept", W(v.TICKS) + "SELECT symbol, time, close, seq FROM ticks")
def x13(spark, sf):
    """A restarted job goes on behind the records it has written."""
    s = streaming_session(spark)
    path = fresh_path(s, "offsets")
    ticks = v.ticks(spark, sf)
    for part in halves(ticks):
        part.write.mode("append").parquet(f"{path}/in")
        source = records.table_stream(s, f"{path}/in", ticks.schema)
        rows = source.select("symbol", "time", "close", "seq")
        run(tables.append_query(rows, f"{path}/out", f"{path}/checkpoint"))
    return v.wall_clock(spark).read.schema(rows.schema).parquet(f"{path}/out")


# ---- the live job: JSON topics in, keyed tables out -------------------------


def live_tables(spark: SparkSession, sf: str) -> str:
    """Runs the live job over both topics as folders of JSON lines; gives its root."""
    s = streaming_session(spark)
    root = fresh_path(s, "live")
    ticks = v.ticks(spark, sf)
    text = F.col("time").cast("string")
    prices = ticks.select(
        F.lit("1m").alias("screener"), "symbol", *OHLCV, text.alias("time"), F.col("seq").alias("offset")
    )
    news = v.as_news(ticks).select(
        "symbol", "id", F.col("title").alias("news_title"), F.col("link").alias("news_source_link"),
        F.col("event_time").cast("string").alias("public_date"),
    )
    for name, rows in (("prices", prices), ("news", news)):
        records.encode(rows).write.text(f"{root}/topics/{name}")

    def price_topic() -> DataFrame:
        raw = records.text_stream(s, f"{root}/topics/prices")
        offset = F.get_json_object("value", "$.offset").cast("long")
        return live.prices_of(raw.withColumn("offset", offset))

    news_topic = live.news_of(records.text_stream(s, f"{root}/topics/news"))
    run(live.price_tables_query(price_topic(), f"{root}/t", f"{root}/cp-prices", "offset", FRAME_MINUTES))
    run(live.impact_query(news_topic, price_topic(), f"{root}/t", f"{root}/cp-news", "offset"))
    v.wall_clock(spark)
    return f"{root}/t"


def live_table(spark, sf, name: str) -> DataFrame:
    return tables.read_table(spark, live_tables(spark, sf), TABLES[name])


@query(
    "x3_live_ladder",
    W(v.TICKS, CLOSED, v.BARS_1M, CLOSED_1M,
      ", ".join(v.sql_bars(f"r_{n}", n, m, "closed") for n, m in v.RUNGS.items()))
    + " UNION ALL ".join(f"SELECT screener, {BAR} FROM r_{n}" for n in v.RUNGS),
)
def x3_live(spark, sf):
    """Table ohlvc: closed minutes, and the longer bars they have made so far."""
    return live_table(spark, sf, "ohlvc")


_LIVE = "sma20 ema12 ema26 macd rsi14 bb_upper bb_lower vwap ret"


@query(
    "x7_live_indicators",
    W(*CLOSED_IND, v.sql_range("closed"), v.sql_recursive("ind"))
    + f"SELECT symbol, time, close, {v.sql_off_ties(_LIVE)} FROM rec",
)
def x7_live(spark, sf):
    out = live_table(spark, sf, "indicators").select("symbol", "time", "close", *_LIVE.split())
    return v.off_ties(out, *_LIVE.split())


@query("x6_live_signals", SIGNALS_SQL)
def x6_live(spark, sf):
    return live_table(spark, sf, "signals")


@query("x8_live_impact", X8_SQL.replace("prices AS (SELECT * FROM ticks WHERE event_type <> 'signup')", "prices AS (SELECT * FROM ticks)"))
def x8_live(spark, sf):
    """Here the price topic holds every tick."""
    return v.rounded(live_table(spark, sf, "news_impact"), "impact_pct")
