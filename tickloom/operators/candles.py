"""OHLCV bars: tumbling roll-up, cascaded and direct ladders, daily bars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.times import DAY_US, MINUTE_US, bin_start, from_micros, micros

# Names and lengths in minutes of the five rungs.
LADDER = {"1m": 1, "5m": 5, "15m": 15, "30m": 30, "1H": 60}

OHLCV = ("open", "high", "low", "close", "volume")

# A packed order key has room for every bigint, and a null below them, in each
# microsecond.
_SEQ_ROOM = Decimal(1 << 65)
_NO_SEQ = Decimal(-(1 << 63) - 1)


def _packed(time_us: Column, seq: str) -> Column:
    """(microseconds, sequence number) as one decimal; a null sequence number
    comes before all others of its time."""
    number = F.coalesce(F.col(seq).cast("decimal(20,0)"), F.lit(_NO_SEQ))
    return time_us.cast("decimal(17,0)") * F.lit(_SEQ_ROOM) + number


def arrival_order(time: str, seq: str | None) -> Column:
    """Sort key of records: time, then sequence number, which may be any bigint.

    A single decimal keeps first/last inside hash aggregation; a struct key would
    force a sort of all raw records.
    """
    return F.col(time) if seq is None else _packed(micros(time), seq)


def recency_order(time: str, seq: str) -> Column:
    """Sort key for the minimum: newest time first, then lowest sequence number."""
    return _packed(-micros(time), seq)


def bar_columns(order: Column) -> list[Column]:
    """First open, highest high, lowest low, last close, total volume."""
    return [
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"),
    ]


def label_of(start_us: Column, width_us: int, label: str, like: str = "timestamp_ntz") -> Column:
    """Bar label: ``window_time`` (end - 1 ms), ``start`` or ``end``."""
    shift = {"window_time": width_us - 1000, "start": 0, "end": width_us}
    if label not in shift:
        raise ValueError(f"label must be one of {sorted(shift)}, not {label!r}")
    return from_micros(start_us + F.lit(shift[label]), like)


def rollup(
    df: DataFrame,
    width_us: int = MINUTE_US,
    label: str = "window_time",
    closed: str = "left",
    seq: str | None = None,
    keys: Sequence[str] = ("symbol",),
    time: str = "time",
) -> DataFrame:
    """One bar per key and epoch-aligned bin of ``width_us``.

    With ``seq``, ties in time are ordered by that column; without it, ``time``
    must be unique per key, as it is for bars.
    """
    if seq is not None and width_us > MINUTE_US and width_us % MINUTE_US == 0:
        # Minutes nest in every longer bin, so the raw records are reduced with
        # the sequence number first and the minute bars are ordered by time alone.
        minutes = rollup(df, MINUTE_US, "start" if closed == "left" else "end",
                         closed, seq, keys, time)
        return rollup(minutes.withColumnRenamed("time", time), width_us, label, closed,
                      None, keys, time)
    return (
        df.withColumn("_bin", bin_start(time, width_us, closed))
        .withColumn("_order", arrival_order(time, seq))
        .groupBy(*keys, "_bin")
        .agg(*bar_columns(F.col("_order")))
        .select(*keys, label_of(F.col("_bin"), width_us, label).alias("time"), *OHLCV)
    )


def drop_incomplete(bars: DataFrame) -> DataFrame:
    """Keeps bars whose five values are all present."""
    return bars.dropna(subset=list(OHLCV))


def _minutes(rungs: Mapping[str, int] | None) -> dict[str, int]:
    return dict(rungs or LADDER)


def _rung(bars: DataFrame, screener: str) -> DataFrame:
    return bars.select(F.lit(screener).alias("screener"), "symbol", "time", *OHLCV)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def ladder(
    bars_1m: DataFrame,
    rungs: Mapping[str, int] | None = None,
    label: str = "window_time",
    closed: str = "left",
) -> DataFrame:
    """All rungs, each built from the 1-minute bars and not from raw records.

    The minute bars are placed once by (symbol, coarsest bin). Every rung's
    bins nest in that bin, so all rungs aggregate where the bars already lie:
    one scan and a single shuffle of minute bars for the whole ladder, and a
    busy symbol is spread over its hours.
    """
    rungs = _minutes(rungs)
    longest = max(rungs.values())
    if any(longest % m for m in rungs.values()):
        raise ValueError("every rung must divide the longest one")
    placed = bars_1m.withColumn("_home", bin_start("time", longest * MINUTE_US, closed)).repartition(
        "symbol", "_home"
    )
    bins = [
        F.struct(
            F.lit(name).alias("screener"),
            label_of(bin_start("time", m * MINUTE_US, closed), m * MINUTE_US, label).alias("label"),
        )
        for name, m in rungs.items()
    ]
    return (
        placed.withColumn("_rung", F.explode(F.array(*bins)))
        .groupBy("symbol", "_home", F.col("_rung.screener").alias("screener"), F.col("_rung.label").alias("_label"))
        .agg(*bar_columns(F.col("time")))
        .select("screener", "symbol", F.col("_label").alias("time"), *OHLCV)
    )


def candle_ladder(
    records: DataFrame, seq: str | None = None, label: str = "window_time"
) -> DataFrame:
    """Raw records to the five-rung candle table."""
    return ladder(rollup(records, MINUTE_US, label, "left", seq), label=label)


def direct_ladder(
    records: DataFrame,
    rungs: Mapping[str, int] | None = None,
    seq: str | None = None,
    label: str = "start",
    closed: str = "left",
) -> DataFrame:
    """Each rung straight from the raw records."""
    return union_all(
        [
            _rung(rollup(records, m * MINUTE_US, label, closed, seq), screener)
            for screener, m in _minutes(rungs).items()
        ]
    )


def history_ladder(
    history: DataFrame, rungs: Mapping[str, int] | None = None, seq: str | None = None
) -> DataFrame:
    """Backfill ladder: right-closed bins labelled by their right edge."""
    rungs = _minutes(rungs)
    minute = drop_incomplete(rollup(history, MINUTE_US, "end", "right", seq))
    return drop_incomplete(ladder(minute, rungs, "end", "right"))


def daily(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    time: str = "time",
    seq: str | None = None,
) -> DataFrame:
    """One bar per key and calendar day, labelled by the day's start."""
    return drop_incomplete(rollup(df, DAY_US, "start", "left", seq, keys, time))
