"""The live job: price and news topics in, four keyed tables out.

Minute bars are the only windowed state, and one stateful pass adds what needs the
bars before. Each micro-batch then fills ``ohlvc``, ``indicators`` and ``signals``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.times import HOUR_US, bin_start
from tickloom.operators.candles import OHLCV, ladder
from tickloom.schemas import TABLES
from tickloom.sources import records, tables
from tickloom.streaming import flows, state

MINUTE_RUNG = "1m"


def prices_of(raw: DataFrame) -> DataFrame:
    """Timed records of the price topic; further columns, such as the offset, stay."""
    return flows.timed(records.ohlc_records(raw), "time", flows.PRICE_DELAY)


def news_of(raw: DataFrame) -> DataFrame:
    """Timed records of the news topic."""
    rows = records.news_records(raw).withColumnsRenamed(
        {"news_title": "title", "news_source_link": "link"}
    )
    return flows.timed(rows, "event_time", flows.NEWS_DELAY)


def refresh_rungs(minutes: DataFrame, root: str, batch_id: int, writer: str) -> None:
    """Rebuilds the longer rungs of the hours that ``minutes`` touch, from the stored
    minute bars. Other hours are neither read nor written."""
    home = bin_start("time", HOUR_US)
    touched = minutes.select("symbol", home.alias("_home")).distinct()
    low, high = minutes.agg(F.min(home), F.max(home)).first()
    if low is None:
        return
    stored = tables.read_key(minutes.sparkSession, root, TABLES["ohlvc"], screener=MINUTE_RUNG)
    inside = stored.filter(
        (F.col("time") >= F.timestamp_micros(F.lit(low)).cast("timestamp_ntz"))
        & (F.col("time") < F.timestamp_micros(F.lit(high + HOUR_US)).cast("timestamp_ntz"))
    )
    whole = inside.withColumn("_home", home).join(touched, ["symbol", "_home"], "left_semi")
    longer = ladder(whole.drop("_home")).filter(F.col("screener") != MINUTE_RUNG)
    tables.write_batch(longer, root, TABLES["ohlvc"], batch_id, writer=f"{writer}-rungs")
    tables.pack_batches(minutes.sparkSession, root, TABLES["ohlvc"], batch_id, f"{writer}-rungs")


def price_tables_query(
    prices: DataFrame, root: str, checkpoint: str, seq: str | None = None, frame_minutes: int = 20
):
    """Sink of the price topic: bars of all rungs, indicators and signals."""
    writer = tables.writer_of(checkpoint)
    states = state.bar_states(flows.minute_bars(prices, seq), frame_minutes)

    def rows(batch: DataFrame) -> DataFrame:
        return flows.settle(batch).withColumn("screener", F.lit(MINUTE_RUNG))

    def store(df: DataFrame, name: str, batch_id: int) -> None:
        tables.write_batch(df, root, TABLES[name], batch_id, writer=writer)
        tables.pack_batches(df.sparkSession, root, TABLES[name], batch_id, writer)

    def write_bars(batch: DataFrame, batch_id: int) -> None:
        minutes = rows(batch).select("screener", "symbol", "time", *OHLCV)
        store(minutes, "ohlvc", batch_id)
        refresh_rungs(minutes, root, batch_id, writer)

    def write_indicators(batch: DataFrame, batch_id: int) -> None:
        store(rows(batch), "indicators", batch_id)

    def write_signals(batch: DataFrame, batch_id: int) -> None:
        found = flows.settle(state.signals_of(batch), time="signal_time")
        store(found, "signals", batch_id)

    return tables.fan_out_query(states, [write_bars, write_indicators, write_signals], checkpoint)


def impact_query(news: DataFrame, prices: DataFrame, root: str, checkpoint: str, seq: str | None = None):
    """Sink of the news topic: each item's price impact, when its horizon has passed."""
    return tables.upsert_query(
        flows.news_impact(news, prices, seq=seq), root, "news_impact", checkpoint
    )
