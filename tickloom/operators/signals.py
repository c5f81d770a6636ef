"""Pattern signals: runs of rising or falling closes, and volume spikes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.times import DAY_US, MINUTE_US, chunk_of, to_ms
from tickloom.operators import segments as sg
from tickloom.operators.indicators import range_by_segment, range_indicators

# Signal names, sides and texts of the signal table.
RISING = ("TREND_3UP", "BUY", "close tang 3+ nen lien tiep")
FALLING = ("TREND_3DOWN", "SELL", "close giam 3+ nen lien tiep")
SPIKE = ("VOLUME_SPIKE", "WATCH")

SIGNAL_COLUMNS = ("symbol", "signal_time", "signal_type", "side", "price", "detail")


# Name of a direction -> does the close go on in it?
DIRECTIONS = {"up": lambda now, before: now > before, "down": lambda now, before: now < before}


def run_positions(
    bars: DataFrame, key: str = "symbol", chunk_us: int = DAY_US, chunk: str | None = None
) -> DataFrame:
    """``up_position`` and ``down_position``: 1-based place of the bar in its run
    of strictly rising or falling closes. An equal or null close starts a new
    run at 1.

    A run may cross any number of chunks, so each chunk is summed up (rows,
    edge closes, last break), the summaries are scanned per key, and each chunk
    gets back the row number of the break that was in force before it. ``chunk``
    names a column that already holds chunk numbers; it is dropped.
    """

    def goes_on(name: str, now: Column, before: Column) -> Column:
        return F.coalesce(DIRECTIONS[name](now, before), F.lit(False))

    if chunk:
        chunked = bars.withColumnRenamed(chunk, sg.CHUNK)
        bars = bars.drop(chunk)
    else:
        chunked = bars.withColumn(sg.CHUNK, chunk_of("time", chunk_us))
    inside = Window.partitionBy(key, sg.CHUNK).orderBy("time")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = chunked.withColumn("_i", F.row_number().over(inside) - 1).withColumn(
        "_prev", F.lag("close").over(inside)
    )
    # Row of a break inside the chunk; the first row is judged by the chunk ahead.
    local = local.withColumns(
        {
            f"_{d}_break": F.when(
                (F.col("_i") > 0) & ~goes_on(d, F.col("close"), F.col("_prev")), F.col("_i")
            )
            for d in DIRECTIONS
        }
    )

    along = Window.partitionBy(key).orderBy(sg.CHUNK)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        local.groupBy(key, sg.CHUNK)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min_by("close", "time").alias("_first_close"),
            F.max_by("close", "time").alias("_last_close"),
            *[F.max(f"_{d}_break").alias(f"_{d}_last") for d in DIRECTIONS],
        )
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_close_before", F.lag("_last_close").over(along))
    )
    for d in DIRECTIONS:
        joined = goes_on(d, F.col("_first_close"), F.col("_close_before"))
        at = F.coalesce(
            F.col("_before") + F.col(f"_{d}_last"), F.when(~joined, F.col("_before"))
        )
        edge = edge.withColumn(f"_{d}_at", at).withColumn(
            f"_{d}_entry",
            F.when(joined, F.last(f"_{d}_at", ignorenulls=True).over(earlier)).otherwise(
                F.col("_before")
            ),
        )
    edge = edge.select(key, sg.CHUNK, "_before", *[f"_{d}_entry" for d in DIRECTIONS])

    placed = local.withColumns(
        {f"_{d}_local": F.max(f"_{d}_break").over(running) for d in DIRECTIONS}
    ).join(sg.per_chunk(edge), [key, sg.CHUNK])
    row = F.col("_before") + F.col("_i")

    def position(d: str) -> Column:
        in_force = F.coalesce(F.col("_before") + F.col(f"_{d}_local"), F.col(f"_{d}_entry"))
        return (row - in_force + 1).alias(f"{d}_position")

    return placed.select(*bars.columns, *[position(d) for d in DIRECTIONS])


def run_matches(
    bars: DataFrame, length: int = 3, rising: bool = True, key: str = "symbol"
) -> DataFrame:
    """Last bar of every non-overlapping run of ``length`` closes.

    Matching is greedy and goes on after the last bar of a match, so within a
    run every ``length``-th bar ends one.
    """
    position = F.col("up_position" if rising else "down_position")
    return run_positions(bars, key).filter(position % length == 0).select(*bars.columns)


def _signal(df: DataFrame, name: str, side: str, detail: Column) -> DataFrame:
    return df.select(
        "symbol",
        to_ms("time").alias("signal_time"),
        F.lit(name).alias("signal_type"),
        F.lit(side).alias("side"),
        F.col("close").alias("price"),
        detail.alias("detail"),
    )


def trend_signals(bars: DataFrame, rising: bool = True, length: int = 3) -> DataFrame:
    name, side, text = RISING if rising else FALLING
    return _signal(run_matches(bars, length, rising), name, side, F.lit(text))


def spike_detail(volume: Column, average: Column) -> Column:
    """``volume gap <ratio>x`` with the ratio at two decimals."""
    ratio = F.round(volume / F.nullif(average, F.lit(0.0)), 2)
    return F.concat(F.lit("volume gap "), ratio.cast("string"), F.lit("x"))


def volume_spikes(
    bars: DataFrame, frame_us: int = 20 * MINUTE_US, factor: float = 3.0
) -> DataFrame:
    """Bars whose volume exceeds ``factor`` times the rolling average, which
    includes the bar itself."""
    average = F.col("avg_volume")
    spikes = range_indicators(bars, frame_us, ("symbol",)).filter(
        average.isNotNull() & (F.col("volume") > factor * average)
    )
    return _signal(spikes, *SPIKE, spike_detail(F.col("volume"), average))


def triggered(
    up: Column, down: Column, volume: Column, average: Column, length: int = 3, factor: float = 3.0
) -> Column:
    """Array of the signals (type, side, detail) that one bar triggers."""

    def hit(when: Column, name: str, side: str, detail: Column) -> Column:
        signal = F.struct(
            F.lit(name).alias("signal_type"), F.lit(side).alias("side"), detail.alias("detail")
        )
        return F.when(when, signal)

    return F.array_compact(
        F.array(
            hit(up % length == 0, *RISING[:2], F.lit(RISING[2])),
            hit(down % length == 0, *FALLING[:2], F.lit(FALLING[2])),
            hit(volume > factor * average, *SPIKE, spike_detail(volume, average)),
        )
    )


def signal_table(bars: DataFrame, frame_us: int = 20 * MINUTE_US) -> DataFrame:
    """All signals of one rung: rising runs, falling runs and volume spikes.

    The three share one pass: the runs are scanned in the time segments where
    the rolling volume already placed the bars.
    """
    placed = run_positions(range_by_segment(bars, frame_us, ("symbol",)), chunk=sg.SEGMENT)
    names = ("up_position", "down_position", "volume", "avg_volume")
    hits = triggered(*[F.col(c) for c in names])
    return placed.select(
        "symbol",
        to_ms("time").alias("signal_time"),
        F.col("close").alias("price"),
        F.explode(hits).alias("_hit"),
    ).select("symbol", "signal_time", "_hit.signal_type", "_hit.side", "price", "_hit.detail")
