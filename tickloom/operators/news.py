"""Price impact after news, and event extraction from history text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.scalars import percent_change
from tickloom.functions.times import MINUTE_US, chunk_of, micros
from tickloom.operators.candles import arrival_order

NEWS_KEYS = ("symbol", "id", "event_time", "title", "link")


def impact_columns(order: Column) -> list[Column]:
    return [
        F.min_by("close", order).alias("price_before"),
        F.max_by("close", order).alias("price_after"),
        F.max("high").alias("max_price"),
        F.min("low").alias("min_price"),
        F.count(F.lit(1)).alias("n_candles"),
    ]


def _minute_of(us: Column) -> Column:
    return ((us - F.pmod(us, F.lit(MINUTE_US))) / MINUTE_US).cast("long")


def _whole_minutes(news: DataFrame, minutes: DataFrame, horizon_us: int) -> DataFrame:
    """News with the minutes that lie in its horizon from first to last microsecond."""
    first = chunk_of("event_time", horizon_us)
    spread = news.withColumn("_bucket", F.explode(F.array(first, first + 1)))
    at = (F.col("_minute") * MINUTE_US - F.pmod(F.col("_minute") * MINUTE_US, F.lit(horizon_us))) / horizon_us
    placed = minutes.withColumn("_at", at.cast("long")).withColumnRenamed("symbol", "_key")
    return spread.join(
        placed,
        (F.col("symbol") == F.col("_key"))
        & (F.col("_bucket") == F.col("_at"))
        & F.col("_minute").between(F.col("_from"), F.col("_to")),
    )


def _edge_records(news: DataFrame, records: DataFrame, horizon_us: int) -> DataFrame:
    """News with its records in the minutes that its horizon cuts, two at most."""
    edges = F.filter(
        F.array_distinct(F.array(chunk_of("event_time", MINUTE_US), _minute_of(F.col("_end")))),
        lambda m: (m < F.col("_from")) | (m > F.col("_to")),
    )
    spread = news.withColumn("_edge", F.explode(edges))
    placed = records.withColumnRenamed("symbol", "_key")
    return spread.join(
        placed,
        (F.col("symbol") == F.col("_key"))
        & (F.col("_edge") == F.col("_minute"))
        & F.col("_us").between(micros("event_time"), F.col("_end")),
    )


def news_impact(
    news: DataFrame,
    prices: DataFrame,
    horizon_us: int = 15 * MINUTE_US,
    seq: str | None = None,
) -> DataFrame:
    """Prices in the ``horizon`` after each news item, per item.

    ``prices`` are raw records, or bars. ``seq`` orders records with equal time.
    News without a price in its horizon has no row.

    Records are reduced to minutes first. An item meets the minutes within its
    horizon as one row each, and single records only in the minutes at its edges,
    so a busy symbol adds no pairs for the minutes between.
    """
    order = F.col("_order")
    records = prices.select(
        "symbol",
        "close",
        "high",
        "low",
        micros("time").alias("_us"),
        chunk_of("time", MINUTE_US).alias("_minute"),
        arrival_order("time", seq).alias("_order"),
    )
    minutes = records.groupBy("symbol", "_minute").agg(
        F.min("_order").alias("_first_at"),
        F.min_by("close", order).alias("_first"),
        F.max("_order").alias("_last_at"),
        F.max_by("close", order).alias("_last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.count(F.lit(1)).alias("_n"),
    )
    singles = records.select(
        "symbol", "_minute", "_us", "high", "low",
        order.alias("_first_at"), F.col("close").alias("_first"),
        order.alias("_last_at"), F.col("close").alias("_last"),
        F.lit(1).cast("long").alias("_n"),
    )
    end = micros("event_time") + horizon_us
    items = news.select(
        *NEWS_KEYS,
        end.alias("_end"),
        _minute_of(micros("event_time") + (MINUTE_US - 1)).alias("_from"),
        (_minute_of(end + 1) - 1).alias("_to"),
    )
    values = ["_first_at", "_first", "_last_at", "_last", "high", "low", "_n"]
    met = _whole_minutes(items, minutes, horizon_us).select(*NEWS_KEYS, *values).unionByName(
        _edge_records(items, singles, horizon_us).select(*NEWS_KEYS, *values)
    )
    return (
        met.groupBy(*NEWS_KEYS)
        .agg(
            F.min_by("_first", "_first_at").alias("price_before"),
            F.max_by("_last", "_last_at").alias("price_after"),
            F.max("high").alias("max_price"),
            F.min("low").alias("min_price"),
            F.sum("_n").alias("n_candles"),
        )
        .withColumn("impact_pct", percent_change(F.col("price_before"), F.col("price_after")))
        .withColumnRenamed("event_time", "news_time")
    )


# Fixed value: the shape of one entry of a company history text.
HISTORY_ENTRY = r"-\s*(Ngày\s\d{2}/\d{2}/\d{4}|Năm\s\d{4}):\s*(.*?);"


# What may hold in a text and not in the match alone, or the other way round.
_LOOKS_BEYOND = re.compile(r"\$|\\[bBzZG]|\(\?[=!<]")


def extract_entries(
    df: DataFrame, text: str, pattern: str = HISTORY_ENTRY, names=("date", "detail")
) -> DataFrame:
    """One row per match of a two-group pattern over the whole text.

    The pattern runs over the text once; the groups come out of each match alone, unless
    the pattern looks beyond it (end of text, word bounds, look-around).
    """
    rest = [c for c in df.columns if c != text]

    def every(group: int) -> Column:
        return F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))

    if _LOOKS_BEYOND.search(pattern):
        found = F.arrays_zip(*[every(i).alias(n) for i, n in enumerate(names, 1)])
        groups = [F.col("_m").getField(n).alias(n) for n in names]
    else:
        found = every(0)
        groups = [F.regexp_extract("_m", pattern, i).alias(n) for i, n in enumerate(names, 1)]
    # An outer explode: for an inner one Spark would search the text again, as a filter.
    return df.select(*rest, F.explode_outer(found).alias("_m")).filter("_m IS NOT NULL").select(*rest, *groups)
