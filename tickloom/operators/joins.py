"""Temporal and range joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.functions.times import DAY_US, MICROS, MINUTE_US, chunk_of
from tickloom.session import stored as stored_table


def within_after(
    events: DataFrame,
    records: DataFrame,
    horizon_us: int = 15 * MINUTE_US,
    key: str = "symbol",
    event_time: str = "event_time",
    time: str = "time",
) -> DataFrame:
    """Inner join of events to records in ``[event, event + horizon]``.

    Equality on the symbol alone would pair whole symbols before the time test,
    and a busy symbol would fill one task. A time bucket of the horizon's width
    is added to the equality: an event belongs to two buckets, a record to one.
    Every pair meets exactly once, in the record's bucket. Record columns that
    clash with event columns other than the key must be renamed by the caller.
    """
    first = chunk_of(event_time, horizon_us)
    spread = events.withColumn("_bucket", F.explode(F.array(first, first + 1)))
    placed = records.withColumn("_at", chunk_of(time, horizon_us)).withColumnRenamed(key, "_key")
    # Plain timestamp comparisons: streams derive from them when to drop state.
    horizon = F.expr(f"INTERVAL '{horizon_us / MICROS:f}' SECOND")
    start, at = F.col(event_time), F.col(time)
    matches = (
        (F.col(key) == F.col("_key"))
        & (F.col("_bucket") == F.col("_at"))
        & (at >= start)
        & (at <= start + horizon)
    )
    return spread.join(placed, matches).drop("_bucket", "_at", "_key")


def gap_bounds(incoming: DataFrame, stored: DataFrame, key: str = "symbol") -> DataFrame:
    """Per key, the first stored time at or after the incoming minimum date and
    the last stored time at or before the incoming maximum date (its midnight).

    The stored table is reduced to one row per key and day before it meets the
    incoming range.
    """
    asked = incoming.groupBy(key).agg(
        F.date_trunc("day", F.min("time")).cast("timestamp_ntz").alias("_from"),
        F.date_trunc("day", F.max("time")).cast("timestamp_ntz").alias("_to"),
    )
    days = stored.groupBy(key, chunk_of("time", DAY_US).alias("_day")).agg(
        F.min("time").alias("_lo"), F.max("time").alias("_hi")
    )
    at_most = F.when(F.col("_hi") <= F.col("_to"), F.col("_hi")).when(
        F.col("_lo") <= F.col("_to"), F.col("_lo")
    )
    return (
        days.join(asked, key)
        .groupBy(key)
        .agg(
            F.min(F.when(F.col("_lo") >= F.col("_from"), F.col("_lo"))).alias("stored_start"),
            F.max(at_most).alias("stored_end"),
        )
    )


def outside_stored(incoming: DataFrame, stored: DataFrame, key: str = "symbol") -> DataFrame:
    """Backfill filter: rows before the stored start or after the stored end.

    Keys without both bounds keep all rows. The bounds, one row per key, are stored
    first: below the broadcast threshold no incoming row is shuffled.
    """
    bounds = stored_table(gap_bounds(incoming, stored, key), "gap-bounds")
    start, end = F.col("stored_start"), F.col("stored_end")
    keep = start.isNull() | end.isNull() | (F.col("time") < start) | (F.col("time") > end)
    return (
        incoming.join(bounds, key, "left")
        .filter(keep)
        .select(*incoming.columns)
    )
