"""Streaming forms of the batch operators.

Event time is ``TimestampType`` here (streams reject zoneless event time), in a
UTC session. ``settle`` turns a result back to the zoneless stored form.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.scalars import percent_change
from tickloom.operators.candles import LADDER, OHLCV, arrival_order, bar_columns, union_all
from tickloom.operators.news import NEWS_KEYS
from tickloom.functions.times import MINUTE_US
from tickloom.streaming.idle import MARK, SOURCE, idle_marks
from tickloom.streaming.impact import impact_parts, joined_parts
from tickloom.streaming.state import ladder_states

# How long each input waits for late records.
PRICE_DELAY = "10 seconds"
NEWS_DELAY = "5 seconds"
CANDLE_DELAY = "5 seconds"


def timed(df: DataFrame, time: str, delay: str) -> DataFrame:
    """Event-time column with its watermark."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def timed_with_beats(df: DataFrame, time: str, delay: str, beats: DataFrame) -> DataFrame:
    """As ``timed``, for a source that may fall silent. ``beats`` is a stream with
    the column ``time``: the source has sent all it had up to there. Beats move the
    watermark and leave no row; the job waits for its slowest source, so no record
    is late because another source is quicker."""
    both = df.unionByName(
        beats.select(F.col(time), F.col(time).cast("timestamp").alias("_beat")),
        allowMissingColumns=True,
    )
    # The test names the event time, so it is not moved ahead of the watermark.
    is_beat = F.col("_beat").eqNullSafe(F.col(time))
    return timed(both, time, delay).filter(~is_beat).drop("_beat")


IDLE_MS = 10_000  # fixed value: after so long without a record a source is idle


def timed_with_idle(
    sources: Mapping[str, DataFrame], time: Mapping[str, str], delays: Mapping[str, str], idle_ms: int = IDLE_MS
) -> dict[str, DataFrame]:
    """As ``timed`` for each of the sources, which are used in one job (as a union or a
    join). The job waits for its slowest source, but not for one that has sent nothing
    for ``idle_ms`` by the clock, nor for one that has never sent anything; what such a
    source sends later, behind the watermark, is late. Nothing but records is needed of
    it. With all sources idle the watermark goes to the
    quickest of them.

    Such a job runs by the clock: give it a processing-time trigger; with
    ``availableNow`` it would not end. Each source is scanned once more, for its event
    time only.
    """
    marks = idle_marks(sources, time, delays, idle_ms)

    def passed(name: str) -> DataFrame:
        at = F.timestamp_micros(MARK) + F.expr(f"INTERVAL {delays[name]}")
        kind = sources[name].schema[time[name]].dataType
        return marks.filter(F.col(SOURCE) == name).select(at.cast(kind).alias(time[name]))

    return {
        name: timed_with_beats(rows, time[name], delays[name], passed(name)) for name, rows in sources.items()
    }


def without_repeats(df: DataFrame, *keys: str) -> DataFrame:
    """Drops exact repeats that arrive within the watermark."""
    return df.dropDuplicatesWithinWatermark(list(keys))


def minute_bars(records: DataFrame, seq: str | None = None) -> DataFrame:
    """1-minute bars, each emitted once when its window closes; ``rt`` is the
    row time for further windows."""
    return _bars(
        records.withColumn("_order", arrival_order("time", seq)), "time", 1, "_order"
    )


def _bars(df: DataFrame, time: str, minutes: int, order: str) -> DataFrame:
    window = F.window(time, f"{minutes} minutes")
    return (
        df.groupBy("symbol", window.alias("window"))
        .agg(*bar_columns(F.col(order)))
        .select("symbol", F.window_time("window").alias("rt"), *OHLCV)
    )


def settle(df: DataFrame, rt: str = "rt", time: str = "time") -> DataFrame:
    """Row time (end - 1 us) to the stored label (end - 1 ms), zoneless."""
    label = F.col(rt) + F.expr("INTERVAL '0.000001' SECOND") - F.expr("INTERVAL '0.001' SECOND")
    return df.withColumn(rt, label.cast("timestamp_ntz")).withColumnRenamed(rt, time)


def candle_ladder(
    records: DataFrame, rungs: Mapping[str, int] | None = None, seq: str | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """All rungs as one stream with a ``screener`` column, cascaded in one job over one
    scan of the timed record stream: native minute windows, then one stateful pass in
    which all rungs of a symbol grow out of its minute bars. ``initial`` are the open bars
    of a job that this one goes on with."""
    rungs = dict(rungs or LADDER)
    bars = settle(ladder_states(minute_bars(records, seq), tuple(rungs.values()), initial))
    name = F.element_at(F.create_map(*[F.lit(x) for n, m in rungs.items() for x in (m, n)]), F.col("minutes").cast("int"))
    return bars.select(name.alias("screener"), "symbol", "time", *OHLCV)


def stored_ladder(bars: DataFrame, rungs: Mapping[str, int] | None = None) -> DataFrame:
    """Longer rungs over the stream of stored minute bars (timed on ``time``)."""
    longer = {n: m for n, m in (rungs or LADDER).items() if m > 1}
    return union_all(
        [_labelled(settle(_bars(bars, "time", m, "time")), name) for name, m in longer.items()]
    )


def _labelled(bars: DataFrame, screener: str) -> DataFrame:
    return bars.select(F.lit(screener).alias("screener"), "symbol", "time", *OHLCV)


def news_impact(
    news: DataFrame, prices: DataFrame, horizon_us: int = 15 * MINUTE_US, seq: str | None = None
) -> DataFrame:
    """Each news item once, when its horizon has passed. Both inputs are timed. No record
    is paired with an item: state keeps partial values per item (``streaming.impact``)."""
    parts = impact_parts(news.select(*NEWS_KEYS), prices, horizon_us, seq)
    return joined_parts(parts).select(
        "symbol", "id", F.timestamp_micros("event_us").cast("timestamp_ntz").alias("news_time"), "title", "link",
        "price_before", "price_after", "max_price", "min_price", "n_candles",
        percent_change(F.col("price_before"), F.col("price_after")).alias("impact_pct"),
    )
