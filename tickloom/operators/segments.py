"""Window functions over long series, split so that no key lands in one task.

``PARTITION BY symbol`` sends a whole symbol to one task, and one symbol may
hold a third of all rows. The helpers here cut each series into segments and
give every segment the few neighbouring rows its frames reach into (its halo),
so ``PARTITION BY symbol, segment`` gives the same values:

* ``time_segments``: frames bounded in time; one shuffle.
* ``number_rows``: exact row numbers from chunk counts.
* ``row_segments``: frames bounded in rows, on numbered rows.
* ``with_previous``: previous-row values, carried over chunk edges.

What crosses a chunk edge is one summary row per (key, chunk): that table grows
with the length of the calendar, not with the number of records. Keys and times
must not be null; the decoders drop such records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.functions.times import DAY_US, chunk_of, micros

SEGMENT = "_segment"
OWN = "_own"
ROW = "_row"
CHUNK = "_chunk"


def time_segments(
    df: DataFrame, time: str, before_us: int, width_us: int | None = None
) -> DataFrame:
    """Adds ``_segment`` and ``_own``; rows in the last ``before_us`` of a segment
    are repeated, not owned, in the next one."""
    width = max(width_us or 16 * before_us, before_us)
    index = chunk_of(time, width)
    reaches_next = F.pmod(micros(time), F.lit(width)) >= F.lit(width - before_us)
    targets = F.when(reaches_next, F.array(index, index + 1)).otherwise(F.array(index))
    return df.withColumn(SEGMENT, F.explode(targets)).withColumn(
        OWN, F.col(SEGMENT) == index
    )


def owned(df: DataFrame) -> DataFrame:
    """Drops the halo rows and the helper columns."""
    helpers = [c for c in (SEGMENT, OWN, ROW, CHUNK) if c in df.columns]
    return df.filter(F.col(OWN)).drop(*helpers)


def _earlier(keys: Sequence[str]):
    return (
        Window.partitionBy(*keys)
        .orderBy(CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def per_chunk(summary: DataFrame) -> DataFrame:
    """Marks a chunk summary as the hashed side of its join.

    The rows already lie by (key, chunk) from their window, so they are neither
    moved nor sorted again; each task hashes only the chunks it holds.
    """
    return summary.hint("shuffle_hash")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie_breakers: Sequence[str] = (),
    chunk_us: int = DAY_US,
    name: str = ROW,
    chunk: str | None = None,
    counted: Column | None = None,
) -> DataFrame:
    """0-based running row number per key in (time, tie breakers) order.

    ``chunk`` names a column that already holds chunk numbers, so that rows
    which lie by (key, chunk) are numbered where they are. With ``counted``,
    only rows that meet it are numbered; another row gets the number of the
    last one that did, or 0.
    """
    keys = list(keys)
    if chunk:
        chunked = df.withColumnRenamed(chunk, CHUNK)
    else:
        chunked = df.withColumn(CHUNK, chunk_of(time, chunk_us))
    one = F.lit(1) if counted is None else F.when(counted, 1)
    before = (
        chunked.groupBy(*keys, CHUNK)
        .agg(F.count(one).alias("_n"))
        .select(
            *keys, CHUNK, F.coalesce(F.sum("_n").over(_earlier(keys)), F.lit(0)).alias("_before")
        )
    )
    inside = Window.partitionBy(*keys, CHUNK).orderBy(time, *tie_breakers)
    if counted is None:
        place = F.row_number().over(inside)
    else:
        place = F.count(one).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        chunked.withColumn("_i", place - 1)
        .join(per_chunk(before), [*keys, CHUNK])
        .withColumn(name, F.greatest(F.col("_before") + F.col("_i"), F.lit(0)))
        .drop("_i", "_before", CHUNK)
    )


def row_segments(
    numbered: DataFrame, before: int = 0, after: int = 0, block: int = 2048
) -> DataFrame:
    """Adds ``_segment`` and ``_own`` to numbered rows; each block also gets the
    last ``before`` rows of the block ahead and the first ``after`` of the next."""
    if max(before, after) > block:
        raise ValueError("the frame must fit into one block")
    size = F.lit(block)
    index = F.floor(F.col(ROW) / size).cast("long")
    place = F.pmod(F.col(ROW), size)
    targets = F.array(
        index,
        F.when(place >= block - before, index + 1) if before else F.lit(None).cast("long"),
        F.when((place < after) & (index > 0), index - 1) if after else F.lit(None).cast("long"),
    )
    return numbered.withColumn(SEGMENT, F.explode(F.array_compact(targets))).withColumn(
        OWN, F.col(SEGMENT) == index
    )


def segment_window(keys: Sequence[str], *order: str | Column):
    return Window.partitionBy(*keys, SEGMENT).orderBy(*order)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    values: dict[str, str],
    chunk_us: int = DAY_US,
) -> DataFrame:
    """Adds previous-row values: ``values`` maps new name to column.

    ``time`` must be unique per key (bars are).
    """
    keys = list(keys)
    chunked = df.withColumn(CHUNK, chunk_of(time, chunk_us))
    # One value each: a struct of them would turn the aggregation into a sort.
    last = chunked.groupBy(*keys, CHUNK).agg(
        *[F.max_by(c, time).alias(f"_last_{n}") for n, c in values.items()]
    )
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = last.select(
        *keys, CHUNK, *[F.lag(f"_last_{n}").over(along).alias(f"_carried_{n}") for n in values]
    )
    inside = Window.partitionBy(*keys, CHUNK).orderBy(time)
    local = chunked.withColumn("_first", F.row_number().over(inside) == 1)
    for new, column in values.items():
        local = local.withColumn(new, F.lag(column).over(inside))
    out = local.join(per_chunk(carried), [*keys, CHUNK])
    for new in values:
        out = out.withColumn(
            new, F.when(F.col("_first"), F.col(f"_carried_{new}")).otherwise(F.col(new))
        )
    return out.drop("_first", *[f"_carried_{n}" for n in values], CHUNK)
