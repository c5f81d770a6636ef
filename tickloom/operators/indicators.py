"""Technical indicators over bars.

Every function keeps all rows and adds columns. Bars must be unique per
(keys, time). Frames run inside segments (see ``segments``), so a busy symbol
is worked on by many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions import folds
from tickloom.functions.scalars import guarded_ratio, ratio
from tickloom.functions.times import MINUTE_US, micros
from tickloom.operators import segments as sg

KEYS = ("screener", "symbol")
BLOCK = 2048


def range_indicators(
    bars: DataFrame,
    frame_us: int = 20 * MINUTE_US,
    keys: Sequence[str] = KEYS,
    deviations: float = 2.0,
) -> DataFrame:
    """SMA, Bollinger bands, rolling VWAP and average volume.

    One RANGE frame, inclusive at both ends, shared by all aggregates.
    """
    return range_by_segment(bars, frame_us, keys, deviations).drop(sg.SEGMENT)


def range_by_segment(
    bars: DataFrame, frame_us: int, keys: Sequence[str], deviations: float = 2.0
) -> DataFrame:
    """``range_indicators`` with the time segment of every row, for a further
    step that works in the same segments."""
    w = sg.segment_window(keys, "_us").rangeBetween(-frame_us, Window.currentRow)
    framed = sg.time_segments(bars.withColumn("_us", micros("time")), "time", frame_us).select(
        "*",
        F.avg("close").over(w).alias("_mean"),
        F.stddev_pop("close").over(w).alias("_dev"),
        F.sum("volume").over(w).alias("_traded"),
        F.sum(F.col("close") * F.col("volume")).over(w).alias("_value"),
        F.avg("volume").over(w).alias("avg_volume"),
    )
    mean, band = F.col("_mean"), deviations * F.col("_dev")
    return framed.filter(F.col(sg.OWN)).select(
        *bars.columns,
        sg.SEGMENT,
        mean.alias("sma20"),
        mean.alias("bb_mid"),
        (mean + band).alias("bb_upper"),
        (mean - band).alias("bb_lower"),
        guarded_ratio(F.col("_value"), F.col("_traded")).alias("vwap"),
        "avg_volume",
    )


def row_sma(
    bars: DataFrame,
    sizes: Sequence[int] = (20, 50),
    keys: Sequence[str] = KEYS,
    block: int = BLOCK,
) -> DataFrame:
    """Simple means over exactly the last ``n`` rows, as ``sma_<n>``."""
    numbered = sg.number_rows(bars, keys, "time")
    w = sg.segment_window(keys, sg.ROW)
    means = [F.avg("close").over(w.rowsBetween(1 - n, 0)).alias(f"sma_{n}") for n in sizes]
    reach = max(sizes) - 1
    return sg.owned(
        sg.row_segments(numbered, before=reach, block=max(block, reach)).select("*", *means)
    )


def _block_for(decay: float, history: int, block: int) -> int:
    """Rows per block, so that ``decay ** -rows`` stays far below overflow."""
    return min(block, int(600 / -math.log(decay)) - history)


def recursive_indicators(
    bars: DataFrame,
    fast: int = 12,
    slow: int = 26,
    period: int = 14,
    history: int = 300,
    keys: Sequence[str] = KEYS,
    block: int = BLOCK,
    chunk: str | None = None,
) -> DataFrame:
    """``ema<fast>``, ``ema<slow>``, ``macd``, ``rsi<period>`` and ``ret``.

    Each value depends on at most ``history`` closes and is seeded afresh from
    the oldest of them. A fold over that frame costs ``history`` steps per row;
    here it is two running sums and a lag, so every row costs the same however
    long the history is:

        ema(t) = a * sum_{i in frame} q^(t-i) x_i + (1-a) q^(t-o) x_o

    with q = 1-a and o the oldest row. ``sum_i q^-i x_i`` is a running sum, and
    the part ahead of the frame is that sum ``history`` rows earlier. Exponents
    count from the start of the block, which keeps them in range.

    A null close gets null values and does not enter the history. While a NaN or
    an infinite close is in the history the values are NaN; the sums leave it out,
    so that they are right again once it has gone. ``chunk`` is passed on to ``segments.number_rows`` and dropped.
    """
    ema_names = {fast: f"ema{fast}", slow: f"ema{slow}"}
    added = [*ema_names.values(), "macd", f"rsi{period}", "ret"]
    decays = [1 - 2.0 / (n + 1.0) for n in (fast, slow)] + [1 - 1.0 / period]
    size = min(_block_for(q, history, block) for q in decays)
    reach = history - 1
    if size < reach or period + 1 >= history:
        plain = bars.drop(chunk) if chunk else bars
        return _recursive_by_fold(plain, fast, slow, period, history, keys, added, block)

    numbered, keys = _numbered_history(bars, keys, chunk)
    bars = bars.drop(chunk) if chunk else bars
    seg = sg.row_segments(numbered, before=reach, block=size)

    order = sg.segment_window(keys, sg.ROW)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def before(c: Column | str, n: int) -> Column:
        return F.coalesce(F.lag(c, n).over(order), F.lit(0.0))

    # Place in the block; the first block starts at row 0, later ones at their halo.
    start = F.greatest(F.col(sg.SEGMENT) * size - reach, F.lit(0))
    place = (F.col(sg.ROW) - start).cast("double")
    change = F.col("_close") - F.lag("_close").over(order)
    finite = F.abs(F.col("close")) < float("inf")  # NaN is above all numbers
    base = (
        seg.withColumn("_r", place)
        .withColumn("_close", F.when(finite, F.col("close")).otherwise(0.0))
        .withColumn("_d", change)
    )
    gain = F.coalesce(F.greatest(F.col("_d"), F.lit(0.0)), F.lit(0.0))
    loss = F.coalesce(F.greatest(-F.col("_d"), F.lit(0.0)), F.lit(0.0))
    base = base.withColumn("_g", gain).withColumn("_l", loss)

    def grow(q: float) -> Column:
        return F.pow(F.lit(1.0 / q), F.col("_r"))

    u = 1 - 1.0 / period
    settled = F.col(sg.ROW) > period  # rows past the seed of a fresh series
    in_seed = F.col(sg.ROW).between(1, period)
    far = order.rowsBetween(-(history - 2), -(history - 1 - period))

    def seed(c: str) -> Column:
        young = F.sum(F.when(in_seed, F.col(c)).otherwise(0.0)).over(running)
        return F.when(F.col(sg.ROW) < history - 1, young).otherwise(F.sum(c).over(far))

    sums = base.select(
        "*",
        *[
            F.sum(F.col("_close") * grow(q)).over(running).alias(f"_s{n}")
            for n, q in zip((fast, slow), decays)
        ],
        *[
            F.sum(F.when(settled, F.col(c) * grow(u)).otherwise(0.0)).over(running).alias(f"_w{c}")
            for c in ("_g", "_l")
        ],
        seed("_g").alias("_seed_g"),
        seed("_l").alias("_seed_l"),
        F.sum((F.col("_l") > 0).cast("long")).over(running).alias("_losses"),
        F.coalesce(F.lag("_close", reach).over(order), F.first("_close").over(running)).alias("_x0"),
        (F.max((~finite).cast("int")).over(order.rowsBetween(-reach, 0)) == 1).alias("_spoilt"),
        (F.col("close") - F.lag("close").over(order)).alias("_ret"),
    )

    def ema(n: int, q: float) -> Column:
        recent = F.col(f"_s{n}") - before(f"_s{n}", history)
        oldest = F.pow(F.lit(q), F.least(F.col("_r"), F.lit(float(reach))))
        return (1 - q) * recent * F.pow(F.lit(q), F.col("_r")) + q * oldest * F.col("_x0")

    steps = F.least(F.col(sg.ROW), F.lit(reach)) - period

    def wilder(c: str) -> Column:
        recent = F.col(f"_w{c}") - before(f"_w{c}", reach - period)
        return (
            F.pow(F.lit(u), steps.cast("double")) * F.col(f"_seed{c}") / period
            + recent * F.pow(F.lit(u), F.col("_r")) / period
        )

    lossless = (
        F.col("_losses") - F.coalesce(F.lag("_losses", reach).over(order), F.lit(0))
    ) == 0
    rsi = F.when(lossless, 100.0).otherwise(100.0 - 100.0 / (1.0 + wilder("_g") / wilder("_l")))

    values = sg.owned(
        sums.select(
            *bars.columns,
            sg.SEGMENT,
            sg.OWN,
            _nan_if("_spoilt", ema(fast, decays[0])).alias(ema_names[fast]),
            _nan_if("_spoilt", ema(slow, decays[1])).alias(ema_names[slow]),
            F.when(F.col(sg.ROW) >= period, _nan_if("_spoilt", rsi)).alias(f"rsi{period}"),
            F.col("_ret").alias("ret"),
        )
    )
    values = values.withColumn("macd", F.col(ema_names[fast]) - F.col(ema_names[slow]))
    return _null_without_close(bars, values, added)


def _nan_if(spoilt: str, value: Column) -> Column:
    return F.when(F.col(spoilt), F.lit(float("nan"))).otherwise(value)


def _numbered_history(
    bars: DataFrame, keys: Sequence[str], chunk: str | None = None
) -> tuple[DataFrame, list[str]]:
    """Row numbers among the bars that have a close; the others, if any, form a
    series of their own and so stay out of every frame."""
    marked = bars.withColumn("_priced", F.col("close").isNotNull())
    numbered = sg.number_rows(marked, keys, "time", chunk=chunk, counted=F.col("_priced"))
    return numbered, [*keys, "_priced"]


def _null_without_close(bars: DataFrame, values: DataFrame, added: Sequence[str]) -> DataFrame:
    priced = F.col("close").isNotNull()
    return values.select(*bars.columns, *[F.when(priced, F.col(c)).alias(c) for c in added])


def _recursive_by_fold(bars, fast, slow, period, history, keys, added, block) -> DataFrame:
    """Array fold per row, for spans too short for the running-sum form."""
    numbered, keys = _numbered_history(bars, keys)
    size = max(block, history)
    seg = sg.row_segments(numbered, before=history - 1, block=size)
    w = sg.segment_window(keys, sg.ROW)
    past = F.collect_list("close").over(w.rowsBetween(1 - history, 0))
    framed = sg.owned(
        seg.withColumn("_past", past).withColumn("ret", F.col("close") - F.lag("close").over(w))
    ).withColumn("_spoilt", F.exists("_past", lambda x: F.abs(x) >= float("inf")))
    rsi = folds.rsi(F.col("_past"), period)
    values = framed.select(
        *bars.columns,
        _nan_if("_spoilt", folds.ema(F.col("_past"), fast)).alias(f"ema{fast}"),
        _nan_if("_spoilt", folds.ema(F.col("_past"), slow)).alias(f"ema{slow}"),
        _nan_if("_spoilt", folds.macd(F.col("_past"), fast, slow)).alias("macd"),
        F.when(rsi.isNotNull(), _nan_if("_spoilt", rsi)).alias(f"rsi{period}"),
        "ret",
    )
    return _null_without_close(bars, values, added)


# Columns of the stored indicator table, in order.
INDICATOR_COLUMNS = (
    "screener", "symbol", "time", "close", "sma20", "ema12", "ema26", "macd",
    "rsi14", "bb_mid", "bb_upper", "bb_lower", "vwap", "ret",
)


def indicator_table(bars: DataFrame, frame_us: int = 20 * MINUTE_US) -> DataFrame:
    """All columns of the ``indicators`` table for any set of rungs."""
    ranged = range_by_segment(bars, frame_us, KEYS)
    return recursive_indicators(ranged, chunk=sg.SEGMENT).select(*INDICATOR_COLUMNS)


def price_change(bars: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Change and change in percent versus the bar before.

    The first bar is compared with itself.
    """
    before = F.coalesce(F.col("_before"), F.col("close"))
    change = F.col("close") - before
    return (
        sg.with_previous(bars, keys, "time", {"_before": "close"})
        .withColumn("price_change", change)
        .withColumn("price_change_pct", ratio(change, before) * 100)
        .drop("_before")
    )


def returns(bars: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``ret``: close minus the close before; null on the first bar."""
    return (
        sg.with_previous(bars, keys, "time", {"_before": "close"})
        .withColumn("ret", F.col("close") - F.col("_before"))
        .drop("_before")
    )


def look_ahead(
    bars: DataFrame, rows: int = 10, keys: Sequence[str] = KEYS, block: int = BLOCK
) -> DataFrame:
    """``close_ahead``: the close ``rows`` bars later, null at the end."""
    numbered = sg.number_rows(bars, keys, "time")
    seg = sg.row_segments(numbered, after=rows, block=max(block, rows))
    ahead = F.lead("close", rows).over(sg.segment_window(keys, sg.ROW))
    return sg.owned(seg.withColumn("close_ahead", ahead))
